"""Small hard inputs: nulls in every column, empty and long texts, repeats, and extra columns with names the operators use."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, key string, fp long, size string, start int, score string"


def prose(seed, words):
    draw = random.Random(seed)
    vocabulary = ["the", "Of", "and", "in", *("".join(draw.choice(["an", "er", "th", "ou", "ti", "ñe", "ß"]) for _ in range(3)) for _ in range(300))]
    return " ".join(draw.choice(vocabulary) for _ in range(words))


def texts():
    shared = prose(1, 130)
    return [
        None, "", " \t\n\x0b", "one", "two words", "three words here", shared, shared, shared.upper(), shared + " tail",
        "head " + shared, prose(2, 40) + "\n" + shared + "\n" + prose(3, 40), shared[:500] + " x " + shared[500:], "abcde " * 400,
        "abcde " * 390, prose(4, 20_000), prose(5, 300) + "  é  " + prose(5, 300), "é" * 150, "é" * 150 + "é", "a" * 199, "b" * 200,
        "c" * 401, prose(6, 60), prose(6, 60)[:-3], prose(6, 60) + " " + prose(6, 60),
    ]


def rows():
    out = []
    for i, text in enumerate(texts()):
        source = [None, "b", "a", "ä", ""][i % 5]
        out.append((i + 10, text, None if i % 3 else "en", source, len(text or ""), i, "k", None, "s", None, "x"))
    out += [out[6], out[6], out[3]]  # repeated rows
    out.append((10, prose(7, 80), "en", "a", None, 0, None, 1, None, 1, None))  # a repeated id
    out.append((None, prose(8, 80), None, None, None, None, None, None, None, None, None))
    out.append((None, texts()[6], None, None, None, None, None, None, None, None, None))
    return out


def messy(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)

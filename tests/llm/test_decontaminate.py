import hashlib
import random
import re

from giftledger.llm import decontaminate
from tests.llm.samples import empty, messy, prose, rows

ITEMS = [(1, prose(1, 30)), (2, "three WORDS here"), (10, prose(1, 130)[:300]), (3, "!!"), (4, None), (5, "Zebra"), (None, prose(2, 20)), (1, prose(3, 15))]


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        windows += [(item, w[i:i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        listed = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((str(doc), len(w), len(hit), hashlib.sha256(listed.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def report(docs, benchmark):
    found = decontaminate.contamination(docs, benchmark)
    return found.selectExpr("CAST(doc_id AS string) AS d", "n_words", "n_hit", "sha2(array_join(coalesce(items, array()), ','), 256) AS h", "contaminated")


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, key string, h int")


def test_messy_rows(spark):
    draw = random.Random(1)
    docs = [(r[0], r[1]) for r in rows() if len(r[1] or "") < 50_000]
    docs += [(99, " ".join(draw.choice(["zebra", "and", "x"]) for _ in range(60))), (98, prose(2, 20) + " ZEBRA")]
    frame = spark.createDataFrame([(d, t, "k", 1) for d, t in docs], "doc_id long, text string, key string, h int")
    got = sorted((str(r.d) if r.d else "None", r.n_words, r.n_hit, r.h, r.contaminated) for r in report(frame, items_of(spark, ITEMS)).collect())
    assert got == brute(docs, ITEMS)
    assert any(r[4] for r in got)


def test_a_large_benchmark_joins_by_shuffle(spark, monkeypatch):
    docs, items = messy(spark).where("length(text) < 50000 OR text IS NULL"), items_of(spark, ITEMS)
    expected = sorted(map(str, report(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    assert sorted(map(str, report(docs, items).collect())) == expected
    assert decontaminate.decontaminated(docs, items).count() == sum(not eval(r.split("contaminated=")[1][:-1]) for r in expected)


def test_removal(spark):
    docs = messy(spark).where("length(text) < 50000 OR text IS NULL")
    items = items_of(spark, ITEMS)
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == report(docs, items).where("NOT contaminated").count()
    cut = decontaminate.decontaminated(docs, items, remove="spans")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert report(cut, items).where("n_hit > 0 AND n_words > 0").count() == 0
    assert cut.where("text = ''").count() >= 1


def test_a_window_of_many_items_is_one_small_row(spark):
    """Items share a window and some share their whole set; none is carried by the windows that are broadcast."""
    shared, other = prose(5, 13), prose(6, 13)
    items = [(i, f"{shared} {prose(100 + i, 12)}") for i in range(40)] + [(i, other) for i in range(100, 104)] + [(None, other), (None, prose(9, 13))]
    docs = [(1, shared), (2, f"{shared} x {other}"), (3, other), (4, prose(9, 13)), (5, items[7][1]), (6, f"{other} y {shared}"), (7, "none")]
    windows = decontaminate.item_windows(items_of(spark, items))
    grams = decontaminate.distinct_windows(windows)
    assert "item_id" not in grams.columns and "items" not in grams.columns
    sets = {}
    for r in windows.join(grams, ["h", "len", "words"]).collect():
        sets.setdefault(r.set_key, {}).setdefault(tuple(r.words), set()).update([r.item_id] * (r.item_id is not None))
    found = [s for of_window in sets.values() for s in map(frozenset, of_window.values())]
    assert all(len(set(map(frozenset, w.values()))) == 1 for w in sets.values()) and len(set(found)) == len(sets)
    frame = spark.createDataFrame([(d, t, "k", 1) for d, t in docs], "doc_id long, text string, key string, h int")
    assert sorted(tuple(r) for r in report(frame, items_of(spark, items)).collect()) == brute(docs, items)
    digest = decontaminate.contamination(frame, items_of(spark, items), items="digest").where("n_hit > 0")
    assert sorted((str(r.doc_id), r.n_items) for r in digest.collect() if r.n_items) == [("1", 40), ("2", 44), ("3", 4), ("5", 40), ("6", 44)]


def test_empty(spark):
    assert decontaminate.contamination(empty(spark), items_of(spark, ITEMS)).collect() == []
    assert decontaminate.decontaminated(empty(spark), items_of(spark, ITEMS)).collect() == []
    none = report(messy(spark), items_of(spark, []))
    assert none.count() == len(rows()) and none.where("contaminated OR n_hit > 0").count() == 0

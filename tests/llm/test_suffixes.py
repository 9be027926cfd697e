import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from giftledger.llm import anchors, suffixes
from tests.llm.samples import DOCS, empty, messy, prose, rows


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, from a count of every string of 200 bytes."""
    raws = [(t or "").encode() for t in texts]
    each = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if each[raw[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(df, pairs):
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())
    wanted = sorted((str(d), *b) for (d, _), b in zip(pairs, brute([t for _, t in pairs])))
    assert found == wanted


def frame(spark, pairs):
    return spark.createDataFrame([(d, t, *[None] * 9) for d, t in pairs], DOCS).repartition(3)


@pytest.mark.parametrize("most", [suffixes.MOST, 1])
def test_messy_rows(spark, most):
    compare(suffixes.dedup(messy(spark), most), [(r[0], r[1]) for r in rows()])


@pytest.mark.parametrize("most", [suffixes.MOST, 2])
def test_passages_that_begin_and_end_anywhere(spark, most):
    draw, passages = random.Random(5), [prose(50 + i, 120) for i in range(5)]
    pairs = []
    for i in range(80):
        parts = [prose(1000 + i, draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            a = draw.randint(0, len(p) - 180)
            parts += [p[a:a + draw.randint(150, len(p))], prose(draw.randint(10**4, 10**6), draw.randint(0, 30))]
        pairs.append((i, "".join(parts)))
    pairs += [(90, "ab" * 300), (91, "ab" * 101 + "c"), (92, "x" * 200), (93, "x" * 201), (94, "x" * 200 + "y")]
    compare(suffixes.dedup(frame(spark, pairs), most), pairs)


@pytest.mark.parametrize("alphabet, size", [("ab", 900), ("a", 700), ("abcd", 3000)])
def test_refined_buckets_are_those_of_equal_strings(alphabet, size):
    """Pointers of 4 bytes refined to 25, in pieces that no string crosses, against a count of strings."""
    draw = random.Random(size)
    block = "".join(draw.choice(alphabet) for _ in range(60))
    text = "".join(draw.choice([block, block[:40], draw.choice(alphabet)]) for _ in range(size // 20))
    cuts = sorted({0, len(text), *(draw.randrange(len(text)) for _ in range(12))})
    ends = np.concatenate([np.full(b - a, b) for a, b in zip(cuts, cuts[1:])])
    grams = [text[i:i + 4] for i in range(len(text) - 3)]
    pointers = np.unique(grams, return_inverse=True)[1]
    found = suffixes.refined_buckets(pointers, ends[:len(grams)], 4, 25)
    whole = {i: text[i:i + 25] for i in range(len(grams)) if i + 25 <= ends[i]}
    each = Counter(whole.values())
    assert sorted(found.tolist()) == [i for i, w in whole.items() if each[w] > 1]
    by_pointer = {}
    for i in found.tolist():
        by_pointer.setdefault(int(pointers[i]), set()).add(whole[i])
    assert all(len(w) == 1 for w in by_pointer.values()) and len(by_pointer) == sum(n > 1 for n in each.values())


def test_a_text_longer_than_a_segment(spark):
    """A repeat that lies across the end of a segment of anchors, in one document of more than `SEGMENT` bytes."""
    draw = np.random.default_rng(3)
    text = draw.integers(97, 123, anchors.SEGMENT + 5000, dtype=np.uint8).tobytes().decode()
    passage = text[anchors.SEGMENT - 300:anchors.SEGMENT + 300]
    (one, two) = sorted(suffixes.dedup(frame(spark, [(1, text), (2, f"x{passage}y")])).collect(), key=lambda r: r.doc_id)
    assert (one.n_bytes, one.n_removed, one.n_spans) == (len(text), 600, 1) and bytes(one.kept).decode() == text.replace(passage, "")
    assert (two.n_removed, two.n_spans, bytes(two.kept)) == (600, 1, b"xy")


def test_kept_bytes_are_returned(spark):
    shared = prose(2, 100)
    pairs = [(1, "a" + shared + "b"), (2, "c" + shared + "d"), (3, None)]
    got = {r.doc_id: (bytes(r.kept), r.n_spans) for r in suffixes.dedup(frame(spark, pairs)).collect()}
    assert got == {1: (b"ab", 1), 2: (b"cd", 1), 3: (b"", 0)}


def test_empty(spark):
    assert suffixes.dedup(empty(spark)).collect() == []

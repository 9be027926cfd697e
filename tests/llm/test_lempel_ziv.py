import hashlib
import random

import pytest
from giftledger.llm import lempel_ziv
from tests.llm.samples import empty, messy, prose, rows
from tests.llm.test_suffixes import frame


def brute(pairs):
    """(n_words, n_removed, kept_sha256) of each (id, text), from the smallest id of every window of 50 words."""
    words = [(t or "").encode().split() for _, t in pairs]
    ids = [2**63 if d is None else d for d, _ in pairs]
    first = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - 49):
            window = tuple(w[i:i + 50])
            first[window] = min(first.get(window, d), d)
    out = []
    for d, w in zip(ids, words):
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def compare(df, pairs):
    found = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())
    assert found == sorted((str(d), *b) for (d, _), b in zip(pairs, brute(pairs)))


@pytest.mark.parametrize("most", [lempel_ziv.MOST, 1])
def test_messy_rows(spark, most):
    compare(lempel_ziv.dedup(messy(spark), most), [(r[0], r[1]) for r in rows()])


@pytest.mark.parametrize("most", [lempel_ziv.MOST, 2])
def test_passages_that_begin_and_end_anywhere(spark, most):
    draw, passages = random.Random(6), [prose(70 + i, 200).split() for i in range(5)]
    pairs = []
    for i in range(80):
        parts = prose(2000 + i, draw.randint(0, 60)).split()
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            a = draw.randint(0, len(p) - 45)
            parts += p[a:a + draw.randint(40, 160)] + prose(draw.randint(10**4, 10**6), draw.randint(0, 30)).split()
        pairs.append((draw.randint(0, 60), "\n ".join(parts)))  # some ids repeat
    pairs += [(70, "a b " * 40), (71, "a b " * 25), (72, "b a " * 24 + "b"), (73, "a " * 50), (74, "a " * 300)]
    compare(lempel_ziv.dedup(frame(spark, pairs), most), pairs)


def test_kept_words_are_returned(spark):
    shared = prose(2, 60)
    pairs = [(1, f"a {shared} b"), (2, f"c\t{shared}  d"), (3, None)]
    got = {r.doc_id: r.kept for r in lempel_ziv.dedup(frame(spark, pairs)).collect()}
    assert got == {1: f"a {shared} b", 2: "c d", 3: ""}


def test_empty(spark):
    assert lempel_ziv.dedup(empty(spark)).collect() == []

import hashlib
import zlib
from collections import defaultdict

import pytest
from giftledger.llm import manifest

from .samples import DOCS, empty, messy, rows


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, at):
    """Runs a node takes part in, with its place in each."""
    out = []
    for nodes in tree[:-1]:
        run = nodes[at // 16 * 16:at // 16 * 16 + 16]
        out.append((run, at % 16))
        at //= 16
    return out


def brute(documents):
    """documents: (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in documents:
        lower = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        leaf = leaf_of((doc_id, source, lang, n_chars, text))
        groups[source].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, leaf_of((doc_id, source, lang, n_chars, lower)) if tampered else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([row[2] for row in sorted(groups[s])]) for s in order}
    crown = levels([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for at, (_, doc_id, leaf, claimed) in enumerate(sorted(groups[source])):
            steps = path(trees[source], at) + path(crown, place)
            node = claimed
            for run, own in steps:
                node = h(*run[:own], node, *run[own + 1:])
            proof = h(*[d for run, own in steps for i, d in enumerate(run) if i != own])
            out.append((doc_id, leaf, trees[source][-1][0], crown[-1][0], proof, node, node == crown[-1][0]))
    return sorted(out, key=str)


def found(spark, monkeypatch, df):
    monkeypatch.setattr(manifest, "read", lambda *_: df)
    result = manifest.op11_merkle_manifest(spark, "")
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, result.collect()), key=str)


def test_messy_rows(spark, monkeypatch):
    assert found(spark, monkeypatch, messy(spark)) == brute([r[:5] for r in rows()])


def test_empty_and_lone(spark, monkeypatch):
    assert found(spark, monkeypatch, empty(spark)) == []
    for lone in ([(5, "A", "en", "s", 1)], [(None, None, None, None, None)]):
        df = spark.createDataFrame(lone, "doc_id long, text string, lang string, source string, n_chars long")
        assert found(spark, monkeypatch, df) == brute(lone)


def test_deep_trees_sparse_and_negative_ids(spark, monkeypatch):
    ids = [*range(600), *range(-(2**63), -(2**63) + 40), *range(2**63 - 70, 2**63), *[i * 2**40 + 7 for i in range(-150, 150)], *range(2**16 - 9, 2**16 + 9)]
    documents = [(i, f"Text {i}", "en", "hot" if n % 3 else f"s{n % 40:02d}", 6) for n, i in enumerate(dict.fromkeys(ids))]
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert found(spark, monkeypatch, df) == brute(documents)


@pytest.mark.parametrize("chunk", [1_000_000, 7])
def test_a_third_of_all_rows_share_an_id(spark, monkeypatch, chunk):
    monkeypatch.setattr(manifest, "EXPANDED", chunk)
    documents = [(i, "T", "en", "s", 1) for i in range(200)]
    documents += [(77, f"Different {i}", "en", "s", 1) for i in range(150)] + [(80, "Copy", "en", "s", 1)] * 100 + [(None, f"n{i % 30}", None, "s", 1) for i in range(90)]
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert found(spark, monkeypatch, df) == brute(documents)


def test_more_sources_than_one_run(spark, monkeypatch):
    documents = [(i, f"Source {i}", None, None if i % 301 == 0 else chr(0x41 + i % 300) * (1 + i % 2), i) for i in range(900)]
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert found(spark, monkeypatch, df) == brute(documents)


def test_proof_steps_lead_to_the_root(spark):
    made = manifest.manifest(spark.createDataFrame([r for r in rows() if r[0] is not None], DOCS))
    for row in made.leaves.collect():
        node = row.leaf
        for level in row.path:
            node = h(level.left, node, level.right)
        assert node == made.root and row.claimed is None

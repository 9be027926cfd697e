"""Substring dedup by relative Lempel-Ziv parsing against the blocks of earlier documents.

A word goes when a window of `WINDOW` words that covers it also starts in a document with a smaller id. The reference of
a document is all documents with smaller ids. It is indexed by blocks: the anchor of each window (see `anchors`) is a
q-gram of q = 8 words, and what the windows of one anchor cover is a block. The index holds, for each distinct block, the
smallest id that has it.

Parsing a document greedily, a factor goes on from anchor to anchor while the next block is in the reference, from
whichever document: blocks overlap by a window less one word, so their windows are consecutive. A factor can only begin or
end inside a block that is not in the reference although its anchor is. Those boundary blocks are checked window by
window against all blocks with the same anchor. Factors of at least a window are the duplicate spans.

An anchor shared by more than `MOST` different blocks is not checked in one task: its windows meet in a partial
aggregate (the smallest id of each), which gives the same result. Copies meet in aggregates only.

Identifiers have 64 bits and are compared under one anchor (another 64 bits), so blocks are told apart by 128.

Defined results: a null text has no words; shorter texts than a window lose nothing; rows that repeat an id are not
earlier than each other and each lose the same words; rows without an id come after all ids and are no reference; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import anchored, by_group, doubled, joined, merged, mix, numbered, positions, runs, span_keys, word_ids
from .common import Steps, read

WINDOW, Q, MOST = 50, 8, 20_000
LAST = 2**63 - 1


def _blocks(batches):
    for batch in batches:
        out = [[np.empty(0, np.int64)] for _ in range(6)]
        for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = text.as_py().encode("utf-8", "surrogatepass").split()
            if len(words) < WINDOW:
                continue
            ids = word_ids(words)
            grams, raw = doubled(ids, 1, Q), ids.tobytes()
            for at, starts, ends in anchored(grams, WINDOW - Q + 1):
                spans = span_keys(raw, 8, starts, ends, WINDOW)
                values = (np.full(len(at), row), np.full(len(at), doc), grams[at].view(np.int64), spans.view(np.int64), starts, ends - starts)
                for column, value in zip(out, values):
                    column.append(value)
        columns = [pa.array(np.concatenate(c)) for c in out]
        columns[4:] = [c.cast(pa.int32()) for c in columns[4:]]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc", "anchor", "block", "start", "n"])


def _window_ids(batches):
    """Each boundary block with the identifiers of its windows."""
    names = ["anchor", "block", "doc", "ids"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for text, items in zip(batch.column(0), batch.column(1).to_pylist()):
            ids = doubled(word_ids(text.as_py().encode("utf-8", "surrogatepass").split()), 1, 32)
            whole = joined(ids, WINDOW - 32)
            for i in items:
                values = (i["anchor"], i["block"], i["doc"], whole[i["start"]:i["start"] + i["n"]].tobytes())
                for column, value in zip(out, values):
                    column.append(value)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def _windows(table: pa.Table):
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.uint64)
    sizes = np.array([len(b) // 8 for b in table.column("ids").to_pylist()], np.int64)
    return ids, sizes, np.repeat(np.arange(len(sizes)), sizes)


def _check(table: pa.Table):
    """Runs of windows, inside the blocks of whole anchors, that an earlier document has."""
    ids, sizes, item = _windows(table)
    doc = table.column("doc").to_numpy()[item]
    key = mix(table.column("anchor").to_numpy().view(np.uint64)[item]) ^ ids
    order = np.lexsort((doc, key))
    first = np.concatenate([[True], np.diff(key[order]) != 0])[: len(order)]
    least = doc[order][first][np.cumsum(first) - 1] if len(order) else doc
    marks = np.zeros(len(ids), bool)
    marks[order] = least < doc[order]
    piece, start, n = runs(marks, sizes)
    columns = [table.column(c).to_numpy()[piece] for c in ("anchor", "block", "doc")]
    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                                     ["anchor", "block", "doc", "at", "m"])


def _spread(batches):
    for batch in batches:
        table = pa.Table.from_batches([batch])
        ids, sizes, item = _windows(table)
        columns = [table.column(c).to_numpy()[item] for c in ("anchor", "block", "doc")]
        at = positions(sizes, np.zeros(len(sizes), np.int64)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(ids.view(np.int64)), pa.array(at)], ["anchor", "block", "doc", "id", "at"])


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _cut(with_kept: bool):
    def of(batches):
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][:4 + with_kept]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text, parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                factors = merged([(p["start"], p["start"] + p["n"] + WINDOW - 1) for p in parts or ()])
                ends = [0, *(b for _, b in factors)]
                kept = [w for a, b in zip(ends, [*(a for a, _ in factors), len(words)]) for w in words[a:b]]
                rest = b" ".join(kept)
                for column, value in zip(out, (doc_id, len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "surrogatepass"))):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return of


def factor_parts(texts: DataFrame, steps: Steps, most: int = MOST) -> DataFrame:
    """row, start and n: runs of window starts that are in the reference, for stored `numbered` documents."""
    docs = texts.select("row", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
    blocks = docs.mapInArrow(_blocks, "row long, doc long, anchor long, block long, start int, n int")
    blocks = steps.keep(blocks, "blocks")
    shared = blocks.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("anchor")
    shared = steps.keep(shared, "shared")
    open_ = steps.keep(blocks.join(shared, "anchor", "left_semi"), "open")
    steps.drop("blocks", "shared")
    first = F.min(F.struct("doc", "row", "start", "n")).alias("first")
    index = steps.keep(open_.groupBy("anchor", "block").agg(first, F.max("doc").alias("last")), "index")
    earlier = index.where("first.doc < last").select("anchor", "block", F.col("first.doc").alias("lo"))
    inside = open_.join(earlier, ["anchor", "block"]).where("doc > lo").select("row", "start", "n")
    inside = steps.keep(inside, "inside")
    mixed = steps.keep(index.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"), "mixed")
    items = index.join(mixed, "anchor").select(
        F.col("first.row").alias("row"), F.struct("anchor", "block", "first.doc", "first.start", "first.n").alias("i"), (F.col("m") > most).alias("large"))
    items = steps.keep(items.groupBy("row", "large").agg(F.collect_list("i").alias("items")), "items")  # as many as a text has anchors
    found = docs.select("row", "text").join(items, "row")
    windows = lambda large: found.where(F.col("large") == large).select("text", "items").mapInArrow(
        _window_ids, "anchor long, block long, doc long, ids binary")
    sorted_ = windows(False).repartition("anchor").sortWithinPartitions("anchor")
    schema = "anchor long, block long, doc long, at int, m int"
    checked = steps.keep(sorted_.mapInArrow(by_group(2 * MOST, _check), schema), "checked")
    if not items.where("large").isEmpty():
        each = windows(True).mapInArrow(_spread, "anchor long, block long, doc long, id long, at int")
        each = steps.keep(each, "each")
        least = steps.keep(each.groupBy("anchor", "id").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi"), "least")
        more = each.join(least, ["anchor", "id"]).where("doc > lo").select("anchor", "block", "doc", "at", F.lit(1).alias("m"))
        checked = checked.unionAll(more)
    boundary = open_.join(checked, ["anchor", "block", "doc"]).select("row", (F.col("start") + F.col("at")).alias("start"), F.col("m").alias("n"))
    return inside.unionAll(boundary)


def dedup(docs: DataFrame, most: int = MOST, with_kept: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if wanted, kept (the remaining words) of each row."""
    steps = Steps(docs.sparkSession, "lempel-ziv")
    texts = steps.keep(numbered(docs), "texts")
    parts = factor_parts(texts, steps, most).groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("parts"))
    parts = steps.keep(parts, "parts")
    steps.drop("open", "index", "inside", "mixed", "items", "checked")
    parsed = texts.join(parts, "row", "left").select("doc_id", "text", "parts")
    return parsed.mapInArrow(_cut(with_kept), REPORT + ", kept string" * with_kept)


def op7_lempel_ziv_dedup(spark, sf_dir):
    return dedup(read(spark, sf_dir, "documents"), with_kept=False)

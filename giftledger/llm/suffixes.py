"""Substring dedup on suffix buckets: bucket-pointer refinement over anchored positions.

A byte goes when a string of `WINDOW` bytes that covers it also starts anywhere else. Suffixes are put into initial
buckets by their first q = 32 bytes. Only the anchor of each window (see `anchors`) is bucketed over the cluster; a
bucket of one is settled, its windows occur once. What the windows of one anchor cover together is its span; a span
that occurs twice settles all its windows as repeated. What remains are buckets with different spans, where a
repeat begins or ends. They are refined in tasks: every position has a pointer to its bucket of equal 32 bytes. Positions of
shared buckets are sorted by their own pointer and the pointer at a later offset, which splits the buckets at 64, 128
and at last 200 bytes; the new pointers take the place of the old and serve the next pass at its later offsets.
Positions left alone in a bucket keep it and are sorted no more. A window in a shared bucket of 200 bytes is a repeat.

A bucket with more than `MOST` different spans is not refined in one task: its windows are counted by identifier in a
partial aggregate, which gives the same result. Copies meet in counts only and are never listed or paired.

Identifiers of spans, counted windows and initial strings have 64 bits; the first two are compared inside one initial bucket
only, and refined buckets differ as soon as one of their parts of 32 bytes does.

Defined results: a null text is an empty one; texts below 200 bytes lose nothing; rows that repeat an id or a text
are documents of their own, so an exact copy of 200 bytes or more loses all its bytes, in every copy; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import anchored, by_group, byte_ids, joined, merged, numbered, positions, runs, span_keys
from .common import Steps, read

WINDOW, Q, MOST = 200, 32, 20_000


def _anchors(batches):
    for batch in batches:
        out = [[np.empty(0, np.int64)] for _ in range(5)]
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            if len(raw) < WINDOW:
                continue
            grams = byte_ids(np.frombuffer(raw, np.uint8), Q)
            for at, starts, ends in anchored(grams, WINDOW - Q + 1):
                spans = span_keys(raw, 1, starts, ends, WINDOW)
                for column, values in zip(out, (np.full(len(at), row), grams[at].view(np.int64), spans.view(np.int64), starts, ends - starts)):
                    column.append(values)
        columns = [pa.array(np.concatenate(c)) for c in out]
        columns[3:] = [c.cast(pa.int32()) for c in columns[3:]]
        yield pa.RecordBatch.from_arrays(columns, ["row", "seed", "span", "start", "n"])


def _contexts(batches):
    """Each item with the bytes that its windows cover."""
    names = ["seed", "row", "start", "n", "copies", "bytes"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for row, text, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            for i in items:
                values = (i["seed"], row, i["start"], i["n"], i["copies"], raw[i["start"]:i["start"] + i["n"] + WINDOW - 1])
                for column, value in zip(out, values):
                    column.append(value)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


CONTEXT = "seed long, row long, start int, n int, copies long, bytes binary"


def _windows(table: pa.Table):
    """Bytes of all contexts in one array, the position of each window in it, and its context."""
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    sizes = table.column("n").to_numpy().astype(np.int64)
    covered = sizes + WINDOW - 1
    at = positions(sizes, np.cumsum(covered) - covered)
    return data, sizes, at, np.repeat(np.arange(len(sizes)), sizes)


def refined_buckets(pointers: np.ndarray, ends: np.ndarray, length: int, wanted: int) -> np.ndarray:
    """Positions that share a bucket of ``wanted`` units, by bucket-pointer refinement; ``pointers`` is changed.

    ``pointers`` names the bucket of equal strings of ``length`` at each position, by whole numbers below its size;
    strings do not go beyond ``ends``. A pass refines the positions whose longer string fits. The pointer at the later
    offset is then of the pass before or of a bucket of one, so equal pointers stand for equal strings.
    """
    fresh = len(pointers)
    sizes = np.bincount(pointers, minlength=1)
    alive = np.flatnonzero((sizes[pointers] > 1) & (np.arange(len(pointers)) + length <= ends))
    while length < wanted and len(alive):
        step = min(length, wanted - length)
        length += step
        alive = alive[alive + length <= ends[alive]]
        own, later = pointers[alive], pointers[alive + step]
        order = np.lexsort((later, own))
        own, later, alive = own[order], later[order], alive[order]
        new = np.ones(len(alive), bool)
        new[1:] = (np.diff(own) != 0) | (np.diff(later) != 0)
        bucket = np.cumsum(new) - 1
        pointers[alive] = fresh + bucket
        fresh += int(new.sum())
        alive = alive[np.bincount(bucket, minlength=1)[bucket] > 1]
    return alive


def _refine(table: pa.Table):
    """Runs of repeated windows in the contexts of whole buckets that are not settled."""
    data, sizes, at, item = _windows(table)
    if not len(at):
        return
    covered = sizes + WINDOW - 1
    ends = np.repeat(np.cumsum(covered), covered)[:len(data) - Q + 1]
    pointers = np.unique(byte_ids(data, Q), return_inverse=True)[1]
    repeats = np.zeros(len(data), bool)
    repeats[refined_buckets(pointers, ends, Q, WINDOW)] = True  # only positions of windows have 200 bytes before the end
    marks = repeats[at] & (table.column("copies").to_numpy() == 1)[item]
    piece, start, n = runs(marks, sizes)
    rows, starts = table.column("row").to_numpy()[piece], table.column("start").to_numpy()[piece] + start
    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(starts.astype(np.int32)), pa.array(n.astype(np.int32))], ["row", "start", "n"])


def _spread(batches):
    """Every window of a context by its identifier, for buckets too large to refine in one task."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        data, sizes, at, item = _windows(table)
        if not len(at):
            continue
        ids, length = byte_ids(data, Q), Q
        while length < WINDOW:
            step = min(length, WINDOW - length)
            ids, length = joined(ids, step), length + step
        starts = table.column("start").to_numpy()[item] + at - np.repeat(at[np.cumsum(sizes) - sizes], sizes)
        columns = [table.column("seed").to_numpy()[item], ids[at].view(np.int64), table.column("row").to_numpy()[item]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(starts.astype(np.int32))], ["seed", "id", "row", "start"])


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(with_kept: bool):
    def of(batches):
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_kept]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text, cuts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                gone = merged([(c["start"], c["start"] + c["n"] + WINDOW - 1) for c in cuts or ()])
                ends = [0, *(b for _, b in gone)]
                kept = b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(raw)]))
                for column, value in zip(out, (doc_id, len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return of


def repeated(texts: DataFrame, steps: Steps, most: int = MOST) -> DataFrame:
    """row, start and n: runs of window starts that are repeated, for stored `numbered` documents."""
    anchors = steps.keep(texts.select("row", "text").mapInArrow(_anchors, "row long, seed long, span long, start int, n int"), "anchors")
    buckets = steps.keep(anchors.groupBy("seed").count().where("count > 1").select("seed"), "buckets")
    open_ = steps.keep(anchors.join(buckets, "seed", "left_semi"), "open")
    steps.drop("anchors", "buckets")
    first = F.min(F.struct("row", "start", "n")).alias("first")
    spans = steps.keep(open_.groupBy("seed", "span").agg(F.count("*").alias("copies"), first), "spans")
    settled = steps.keep(open_.join(spans.where("copies > 1").select("seed", "span"), ["seed", "span"]).select("row", "start", "n"), "settled")
    steps.drop("open")
    mixed = steps.keep(spans.groupBy("seed").agg(F.count("*").alias("m")).where("m > 1"), "mixed")
    items = spans.join(mixed, "seed").select(
        F.col("first.row").alias("row"), F.struct("seed", "first.start", "first.n", "copies").alias("i"), (F.col("m") > most).alias("large"))
    items = steps.keep(items.groupBy("row", "large").agg(F.collect_list("i").alias("items")), "items")  # as many as a text has anchors
    found = texts.select("row", "text").join(items, "row").select("row", "text", "items", "large")
    contexts = lambda large: found.where(F.col("large") == large).select("row", "text", "items").mapInArrow(_contexts, CONTEXT)
    sorted_ = contexts(False).repartition("seed").sortWithinPartitions("seed")
    refined = steps.keep(sorted_.mapInArrow(by_group(4 * MOST // 10, _refine), "row long, start int, n int"), "refined")
    out = settled.unionAll(refined)
    if not items.where("large").isEmpty():
        windows = steps.keep(contexts(True).mapInArrow(_spread, "seed long, id long, row long, start int"), "windows")
        twice = steps.keep(windows.groupBy("seed", "id").count().where("count > 1").select("seed", "id"), "twice")
        out = out.unionAll(windows.join(twice, ["seed", "id"]).select("row", "start", F.lit(1).alias("n")))
    return out


def dedup(docs: DataFrame, most: int = MOST, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept (the remaining bytes) of each row."""
    steps = Steps(docs.sparkSession, "suffixes")
    texts = steps.keep(numbered(docs), "texts")
    cuts = repeated(texts, steps, most).groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("cuts"))
    cuts = steps.keep(cuts, "cuts")
    steps.drop("spans", "settled", "mixed", "items", "refined")
    joined_ = texts.join(cuts, "row", "left").select("doc_id", "text", "cuts")
    return joined_.mapInArrow(_cut(with_kept), REPORT + ", kept binary" * with_kept)


def op4_suffix_dedup(spark, sf_dir):
    return dedup(read(spark, sf_dir, "documents"), with_kept=False)

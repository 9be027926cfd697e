"""SimHash near-duplicates through an inverted index on the positional bytes of the fingerprints.

A fingerprint of 64 bits is eight bytes at eight positions. Three flipped bits spoil at most three bytes, so two linked
fingerprints share at least `SHARED` = 5 bytes at their positions. One byte alone has posting lists of a 256th of all
fingerprints; the index therefore holds triples: of the positions 0-3, or of the positions 4-7, five shared bytes
always include three, so the eight triples inside these halves find every link. Within a posting list the shared
bytes of a pair are tallied, pairs below five are dropped and the rest is verified on the bits.

The index holds distinct fingerprints, so copies add nothing. A posting list is searched from fingerprint to
fingerprint, and only a spanning forest of its links leaves the task, never all pairs. Lists longer than `LONG` are
counted first and split before the shuffle by two more of their bytes, which any link inside them shares, so no task
gets such a list whole.

Defined results: a null, empty or blank text has fingerprint zero and links like any other; rows that repeat are each
returned; null ids take part and are never the smallest id, so a component of null ids alone has a null id; an
empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, Steps, read, text_key
from .graph import components

SEED, BITS, SHARED, WORDS = 42, 3, 5, 3
TRIPLES = (*combinations(range(4), 3), *combinations(range(4, 8), 3))
#: Of the other five positions, two that any link inside a triple's list shares as well.
PAIRS = [list(combinations([p for p in range(8) if p not in t], SHARED - 3)) for t in TRIPLES]
#: Lists up to SMALL are compared pair by pair, lists above LONG are split by two more bytes first.
SMALL, LONG = 6, 4096


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII spaces count
    if not words:
        return 0
    if len(words) < WORDS:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hash_of = xxhash.xxh64_intdigest
        hashes = [hash_of(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:])]
    ones = np.unpackbits(np.array(hashes, dtype="<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
    bits = 2 * ones.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def row_key() -> Column:
    """The key of a row's id and text."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_key(F.col("text"))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, key (of id and text) and fp (the 64 bits as a long) of each row."""

    def of(batches):
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(of, "doc_id long, key string, fp long")


def _near(one: np.uint64, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` share enough positional bytes with ``one`` and hold on verification."""
    differing = others ^ one
    hits = np.flatnonzero((differing.view("u1").reshape(-1, 8) == 0).sum(axis=1) >= SHARED)
    return hits[np.bitwise_count(differing[hits]) <= BITS]


def _forest(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among ``fps``, reached from one to the next."""
    rest, links = fps, []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            hits = _near(one, rest)
            if len(hits):
                found = rest[hits]
                links.append((np.full(len(found), one), found))
                front.extend(found)
                rest = np.delete(rest, hits)
    return links


def _search(batches):
    """Links inside the posting lists of a partition that is sorted by key; a list may go on in the next batch."""

    def found(keys, fps):
        ends = np.flatnonzero(np.diff(keys)) + 1
        sizes = np.diff(np.concatenate([[0], ends, [len(keys)]]))
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        a, b = [], []
        for lag in range(1, SMALL):
            here = np.flatnonzero(small[:-lag] & (keys[:-lag] == keys[lag:]))
            x, y = fps[here], fps[here + lag]
            differing = x ^ y
            near = (differing.view("u1").reshape(-1, 8) == 0).sum(axis=1) >= SHARED
            near &= np.bitwise_count(differing) <= BITS
            a.append(x[near])
            b.append(y[near])
        starts = np.concatenate([[0], ends])
        for k in np.flatnonzero(sizes > SMALL):
            for x, y in _forest(fps[starts[k]:starts[k] + sizes[k]]):
                a.append(x)
                b.append(y)
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []  # the list that goes on, in pieces

    def whole():
        return found(*(np.concatenate(column) for column in zip(*held)))

    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if held and (last or keys[0] != held[-1][0][-1]):
            held.append((keys[:last], fps[:last]))
            yield whole()
            held = []
        elif last:
            yield found(keys[:last], fps[:last])
        held.append((keys[last:], fps[last:]))
    if held:
        yield whole()


def links(fps: DataFrame, steps: Steps) -> DataFrame:
    """Links (a, b) that connect all distinct values of ``fp`` with at most `BITS` differing bits."""

    def octets(positions: tuple[int, ...], high: int):
        """The number ``high`` followed by the bytes at the positions."""
        value = F.lit(high).cast("long")
        for p in positions:
            value = F.shiftleft(value, 8) + F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)
        return value

    def finer(slot: int):  # numbered behind the slots, so keys of split lists differ from all others
        return F.array(*[octets(TRIPLES[slot] + pair, len(TRIPLES) + slot * len(PAIRS[slot]) + i) for i, pair in enumerate(PAIRS[slot])])

    keys = F.array(*[octets(t, s) for s, t in enumerate(TRIPLES)])
    postings = fps.select(F.posexplode(keys).alias("slot", "key"), "fp")
    long_ = steps.keep(postings.groupBy("key").count().where(F.col("count") > LONG).select("key"), "long-lists")
    n = long_.count()
    if n:
        marks = long_.withColumn("split", F.lit(True))
        marked = postings.join(F.broadcast(marks) if n <= BROADCAST_KEYS else marks, "key", "left")
        split = F.element_at(F.array(*[finer(s) for s in range(len(TRIPLES))]), F.col("slot") + 1)
        postings = marked.select(F.explode(F.when(F.col("split"), split).otherwise(F.array("key"))).alias("key"), "fp")
    return postings.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_search, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, key, fp and component_id (the smallest id that links reach) of each row."""
    steps = Steps(docs.sparkSession, "simhash")
    fps = steps.keep(fingerprints(docs), "fps")
    classes = steps.keep(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(steps, links(classes.select("fp"), steps))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = steps.keep(rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    smallest = steps.keep(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    named = steps.keep(rooted.join(smallest, "root").select("fp", "root", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component with all its columns: the smallest id (null last), then the smallest key of id and text.

    What goes is a list of keys, broadcast up to `BROADCAST_KEYS` of them and joined by shuffle beyond. Rows that repeat
    id and text share a key; only those are looked at again to keep one of them.
    """
    steps = Steps(docs.sparkSession, "one-of-each")
    found = steps.keep(near_duplicates(docs).select("root", "key", F.struct(F.col("doc_id").isNull(), "doc_id", "key").alias("rank")), "found")
    first = steps.keep(found.groupBy("root").agg(F.min("rank").alias("first")), "first")
    rest = found.join(first, "root").where(F.col("rank") != F.col("first")).select("key").distinct()
    twice = found.groupBy("key").count().where("count > 1").select("key")
    marks = rest.select("key", F.lit(1).alias("mark")).unionAll(twice.select("key", F.lit(2).alias("mark")))
    marks = steps.keep(marks.groupBy("key").agg(F.min("mark").alias("mark")), "marks")
    count = marks.count()
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("key"))
    marked = rows.join(F.broadcast(marks) if count <= BROADCAST_KEYS else marks, "key", "left")
    kept = marked.where("mark IS NULL").select("row.*")
    if marks.where("mark = 2").isEmpty():
        return kept
    return kept.unionAll(marked.where("mark = 2").groupBy("key").agg(F.first("row").alias("row")).select("row.*"))


def op5_simhash_near_duplicates(spark, sf_dir):
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Content-defined anchors: every window of a sequence names one of its q-grams, by content alone.

Among the q-grams of a window the one with the smallest identifier (the first of equals) is the window's anchor. Equal
windows therefore have their anchors at the same place, and neighbouring windows mostly share one, so a text needs a
row for each anchor (about two in every w = window - q + 1 positions) instead of one for each position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Positions fit into the low bits of a key, next to the high bits of an identifier.
POSITION_BITS = 24
SEGMENT = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def joined(ids: np.ndarray, later: int, length: int | None = None) -> np.ndarray:
    """Identifiers of longer strings from the identifiers at each position and at ``later`` positions on."""
    n = len(ids) - later if length is None else length
    return mix(ids[:n] * np.uint64(0xD6E8FEB86659FD93) + ids[later:later + n])


def byte_ids(data: np.ndarray, q: int) -> np.ndarray:
    """Identifiers of the q-byte strings (q a power of two from 8) at each position."""
    ids = mix(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel())
    return doubled(ids, 8, q)


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def doubled(ids: np.ndarray, length: int, wanted: int) -> np.ndarray:
    while length < wanted:
        ids, length = joined(ids, length), 2 * length
    return ids


def anchored(grams: np.ndarray, w: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor position, first window and end of the windows of each anchor, in segments of bounded size."""
    for base in range(0, len(grams) - w + 1, SEGMENT):
        part = grams[base:base + SEGMENT + w - 1]
        low = np.uint64((1 << POSITION_BITS) - 1)
        keys = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while 2 * span <= w:
            keys, span = np.minimum(keys[:-span], keys[span:]), 2 * span
        if span < w:
            keys = np.minimum(keys[:len(keys) - (w - span)], keys[w - span:])
        at = (keys & low).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        ends = np.append(starts[1:], len(at))
        yield at[starts] + base, starts + base, ends + base


def span_keys(raw: bytes, unit: int, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Keys of all that the windows of each anchor cover; ``unit`` bytes are one position."""
    key, more = xxhash.xxh3_64_intdigest, window - 1
    return np.fromiter((key(raw[a * unit:(b + more) * unit]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def positions(sizes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """offsets[i], offsets[i] + 1, ... (sizes[i] of them), one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(offsets, sizes)


def runs(marks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True inside consecutive pieces of the given sizes: piece, start inside it, and length."""
    if not len(marks):
        return (np.empty(0, np.int64),) * 3
    piece = np.repeat(np.arange(len(sizes)), sizes)
    change = np.flatnonzero(np.diff(marks) | (np.diff(piece) > 0)) + 1
    starts = np.concatenate([[0], change])
    lengths = np.diff(np.append(starts, len(marks)))
    kept = marks[starts]
    starts, lengths = starts[kept], lengths[kept]
    return piece[starts], starts - (np.cumsum(sizes) - sizes)[piece[starts]], lengths


def merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Union of (start, end) ranges as maximal runs; ranges that touch are one run."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def numbered(docs: DataFrame) -> DataFrame:
    """row, doc_id and text; to be stored at once, which fixes the numbers."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def by_group(least: int, work):
    """A partition sorted by its first column, in pieces of whole groups with at least ``least`` rows."""

    def of(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < least:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column(0).to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole:
                yield from work(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return of

"""Insert-or-replace by key on versioned Parquet tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOAD_DATE
from ..sources import versions as V
from ..sources.keys import HASHES, MOST, append, build, content_hashes, empty, latest
from ..sources.tables import read_dates, write_version
from ..sources.workspace import materialized

RECORD_KEY = ("sub_id",)
FALLBACK_KEY = ("donor_name_normalized", "contribution_date", "contribution_amount")


class KeyViolation(ValueError):
    """The batch has null or repeated keys, so 'the row with this key' has no single meaning."""


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    """Target rows whose key is not in ``source``, and all of ``source``.

    The same as update-all-columns-or-insert, as every other column is replaced. A null key matches nothing.
    """
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(source)


def _some_null(keys: Sequence[str]) -> Column:
    return reduce(lambda found, key: found | F.col(key).isNull(), keys, F.lit(False))


def one_row_per_key(df: DataFrame, keys: Sequence[str], keep: str = "sub_id") -> DataFrame:
    """The row with the smallest ``keep`` value for each complete key; rows with a null in the key all stay.

    A null ``keep`` comes after all values, and ties go to the smallest of the other columns. Aggregates rather than
    ranking, so repeats of a hot key are combined before they are shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(F.col(keep).isNull(), F.col(keep).alias("rank"), F.struct(*rest).alias("rest"))
    best = F.min(ranked)["rest"].alias("best")
    columns = [F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in df.columns]
    single = df.where(~_some_null(keys)).groupBy(*keys).agg(best).select(*columns)
    return single.unionByName(df.where(_some_null(keys)))


def merge_on_fallback_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str] = FALLBACK_KEY, keep: str = "sub_id"
) -> DataFrame:
    """Upsert by name, date and amount for sources without a record id.

    Gifts that agree in all three are taken to be one (the accepted limit of this key): the source is first brought
    down to one row per key. A key with a null part matches nothing and is inserted.
    """
    return merge_rows(target, one_row_per_key(source, keys, keep), keys)


def key_violations(df: DataFrame, keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    """One row: how many rows have a null in the key, and how many keys occur more than once."""
    some_null = _some_null(keys)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum(F.when(some_null, F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(~some_null & (F.col("n") > 1)).alias("repeated_keys"),
        )
    )


def require_unique_keys(df: DataFrame, keys: Sequence[str] = RECORD_KEY) -> None:
    found = key_violations(df, keys).first()
    if found["null_keys"] or found["repeated_keys"]:
        raise KeyViolation(f"{found['null_keys']} rows with a null key, {found['repeated_keys']} repeated keys")


def changes(
    batch: DataFrame, held: DataFrame, buckets: int, keys: Sequence[str] = RECORD_KEY, day: date | None = None
) -> DataFrame:
    """What a batch does to each key of a table: keys, `new_date`, `old_date`, `rows` of the batch, and `change`.

    ``held``: keys, load date and content hashes of the table, as its key index has them. A full outer comparison:
    `insert`, `update` (other content or another load date), `same`, `keep` (not in the batch), and, where the batch
    is all there is of ``day``, `delete` for keys of that day which the batch does not have. The batch is dealt into the
    index's ``buckets``; the history is not shuffled.
    """
    sent = batch.repartition(buckets, *keys).groupBy(*keys).agg(
        F.count("*").alias("rows"), F.max(LOAD_DATE).alias("new_date"), *[F.max(h).alias(f"new_{h}") for h in HASHES]
    )
    both = held.withColumnRenamed(LOAD_DATE, "old_date").join(sent, list(keys), "full")
    same = (F.col("new_date") == F.col("old_date")) & reduce(lambda a, b: a & b, [F.col(h) == F.col(f"new_{h}") for h in HASHES])
    withdrawn = F.lit(False) if day is None else F.col("old_date") == F.lit(day)
    change = (
        F.when(F.col("rows").isNull(), F.when(withdrawn, "delete").otherwise("keep"))
        .when(F.col("old_date").isNull(), "insert")
        .when(same, "same")
        .otherwise("update")
    )
    return both.select(*keys, "new_date", "old_date", "rows", change.alias("change"))


@dataclass(frozen=True)
class UpsertResult:
    """Rows of the batch, rows written, the partitions concerned, those left empty, and keys by kind of change."""

    rows_in: int
    rows_written: int
    load_dates: tuple[date, ...] = ()
    emptied: tuple[date, ...] = ()
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    unchanged: int = 0


#: A part that only gains rows gets a version more, up to this many; then it is written as one again.
MOST_VERSIONS = 8


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str] = RECORD_KEY,
    day: date | None = None,
) -> UpsertResult:
    """Upsert ``source`` into the versioned table at ``path``, rewriting only the partitions it concerns.

    Those are the partitions the batch has rows for and those that hold a row the batch replaces, which may lie
    under another load date. One comparison of the batch with the table's key index finds them all, without reading
    the table. A partition whose rows are all replaced is not read either, one that only gains rows gets them as a
    further version, and only the others are joined; a batch that changes nothing writes nothing. Rows and index are
    published by one manifest. What comes to the driver is a count for each pair of load dates.

    With ``day`` the batch is all there is of that load date: records it no longer has are withdrawn.
    """
    columns = schema.fieldNames()
    # The hashes go with the rows, so that comparison and index read four narrow columns and not whole rows again.
    with materialized(source.select(*columns).select(*columns, *content_hashes(schema, keys)), "upsert-batch") as batch:
        base = V.current(spark, path) or V.Manifest()
        seq, version = base.number + 1, V.new_version()
        rows, hashed = batch.select(*columns), batch.select(*keys, LOAD_DATE, *HASHES)
        index = base.index
        if index is None or index.keys != tuple(keys):
            index = empty(spark, keys)
            if base.parts:
                table = read_dates(spark, path, schema, base.parts, base)
                index = build(spark, path, schema, index, table.select(*keys, LOAD_DATE, *content_hashes(schema, keys)), base.number)
        compared = changes(hashed, latest(spark, path, schema, index), index.buckets, keys, day)
        counted = compared.groupBy("new_date", "old_date", "change").agg(
            F.count("*").alias("keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.count_if((F.col("rows") > 1) & ~_some_null(keys)).alias("repeated"),
            F.coalesce(F.sum(F.when(_some_null(keys), F.col("rows"))), F.lit(0)).alias("null_keys"),
        )
        counts = counted.collect()  # one row for each pair of load dates and kind of change
        total = lambda n, *kinds: sum(r[n] for r in counts if not kinds or r["change"] in kinds)
        rows_in = total("rows")
        if any(r["rows"] and r["new_date"] is None for r in counts):
            raise KeyViolation("a row without a load date belongs to no partition")
        if total("null_keys") or total("repeated"):
            raise KeyViolation(f"{total('null_keys')} rows with a null key, {total('repeated')} repeated keys")
        if rows_in == 0 and not total("keys", "delete"):
            return UpsertResult(0, 0)

        incoming, gone, rest = Counter(), Counter(), Counter()
        for r in counts:
            incoming[r["new_date"]] += r["rows"]
            (rest if r["change"] == "keep" else gone)[r["old_date"]] += r["keys"]
        concerned = sorted(d for d in {*incoming, *gone} if d and (incoming[d] or gone[d]))
        kinds = {n: total("keys", k) for n, k in (("inserted", "insert"), ("updated", "update"), ("deleted", "delete"), ("unchanged", "same"))}
        if not (kinds["inserted"] or kinds["updated"] or kinds["deleted"]):
            if index != base.index:
                V.commit(spark, path, base, base.parts, index, base.columns)
            return UpsertResult(rows_in, 0, tuple(concerned), (), **kinds)

        partly = [d for d in concerned if gone[d] and rest[d]]
        grows = [d for d in concerned if not gone[d] and d in base.parts]
        full = [d for d in grows if len(base.parts[d]) >= MOST_VERSIONS]
        merged = rows
        if partly:
            # Of these dates exactly the batch's keys go: a record is withdrawn from ``day`` alone, which keeps no others.
            kept = read_dates(spark, path, schema, partly, base).join(rows.select(*keys), list(keys), "left_anti")
            merged = merged.unionByName(kept.select(*columns))
        if full:
            merged = merged.unionByName(read_dates(spark, path, schema, full, base))
        written, dates = write_version(merged, path, version, len(concerned), keys[0])

        delta = hashed
        if kinds["deleted"]:
            none = [F.lit(None).cast("date").alias(LOAD_DATE), *[F.lit(None).cast("bigint").alias(h) for h in HASHES]]
            delta = delta.unionByName(compared.where("change = 'delete'").select(*keys, *none))
        index = append(spark, path, schema, index, delta, seq, version)
        if len(index.versions) > MOST:
            index = build(spark, path, schema, empty(spark, keys, index.buckets), latest(spark, path, schema, index), seq)
        parts = {d: v for d, v in base.parts.items() if d not in concerned}
        for d in dates:
            parts[d] = (*base.parts[d], version) if d in grows and d not in full else (version,)
        V.commit(spark, path, base if base.number else None, parts, index, base.columns)
        emptied = tuple(d for d in concerned if d in base.parts and d not in parts)
        return UpsertResult(rows_in, written, tuple(concerned), emptied, **kinds)

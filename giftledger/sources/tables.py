"""Versioned Parquet tables partitioned by load date, snapshot tables, and plain folders of rows.

A write makes a version folder of its own in one job and is published by one manifest (`sources.versions`), so a
crash at any step leaves the table as it was. Row counts are observed in the writing job, so nothing is scanned twice to learn them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOAD_DATE, UNKNOWN_COLUMNS
from . import versions as V
from .workspace import list_names


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty partitioned table unless there is one; tells whether it was created."""
    if LOAD_DATE not in schema.fieldNames():
        raise ValueError(f"a partitioned table needs the column {LOAD_DATE}")
    if V.current(spark, path) is not None:
        return False
    try:
        V.commit(spark, path, None, {})
    except V.ConcurrentWrite:
        return False
    return True


def _read(spark: SparkSession, path: str, schema: T.StructType, parts: Mapping[date | None, Sequence[str]]) -> DataFrame:
    folders = [part_path(path, version, day) for day, held in sorted(parts.items()) for version in held]
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{path.rstrip('/')}/versions"
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.fieldNames())


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as its newest manifest has it; later writes do not change what this DataFrame reads."""
    manifest = V.current(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no table at {path}")
    return _read(spark, path, schema, manifest.parts)


def read_partition(spark: SparkSession, path: str, schema: T.StructType, load_date: date) -> DataFrame:
    """Rows of one load date: only its folders are listed and read."""
    manifest = V.current(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no table at {path}")
    held = {load_date: manifest.parts[load_date]} if load_date in manifest.parts else {}
    return _read(spark, path, schema, held).where(F.col(LOAD_DATE) == F.lit(load_date))


def read_dates(spark: SparkSession, path: str, schema: T.StructType, dates: Iterable[date], manifest: V.Manifest) -> DataFrame:
    """Rows of some load dates, in the state of a given manifest."""
    return _read(spark, path, schema, {d: manifest.parts[d] for d in dates if d in manifest.parts})


def load_dates(spark: SparkSession, path: str) -> list[date]:
    """Load dates that have rows, from the manifest alone."""
    manifest = V.current(spark, path)
    return sorted(d for d in manifest.parts if d) if manifest else []


def partition_row_count(df: DataFrame, load_date: date | None = None) -> DataFrame:
    """Row count per load date, or of one load date (a row with 0 when there is none)."""
    if load_date is None:
        return df.groupBy(F.col(LOAD_DATE).alias("load_date")).agg(F.count("*").alias("row_count"))
    counted = df.where(F.col(LOAD_DATE) == F.lit(load_date)).agg(F.count("*").alias("row_count"))
    return counted.select(F.lit(load_date).alias("load_date"), "row_count")


def part_path(path: str, version: str, load_date: date | None = None) -> str:
    folder = V.version_path(path, version)
    return folder if load_date is None else f"{folder}/{LOAD_DATE}={load_date.isoformat()}"


SHARE = "_share"


def gathered(df: DataFrame, dates: int | None = None, by: str | None = None) -> DataFrame:
    """Rows dealt for writing: each load date is gathered; adaptive execution cuts a large one and joins small ones.

    Where the number of load dates is known, a date is dealt by the column ``by`` as well, so that few dates still keep all
    cores busy, here and where the files are read. Parts below the smallest size that adaptive execution
    makes are joined again, so small tables keep one file for each date and a large one has about two for each core.
    """
    if not (dates and by):
        return df.hint("rebalance", F.col(LOAD_DATE))
    shares = -(-2 * df.sparkSession.sparkContext.defaultParallelism // dates)
    dealt = df.withColumn(SHARE, F.pmod(F.xxhash64(by), F.lit(shares)))
    return dealt.hint("rebalance", F.col(LOAD_DATE), F.col(SHARE)).drop(SHARE)


def write_version(
    df: DataFrame, path: str, version: str, dates: int | None = None, by: str | None = None
) -> tuple[int, list[date]]:
    """Write rows of any number of load dates as one version, which nothing names yet; rows and load dates written.

    The rows are `gathered` first, so a table has files in proportion to its size and not one for each task and date.
    """
    seen, folder = Observation(), V.version_path(path, version)
    counted = gathered(df, dates, by).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(LOAD_DATE).parquet(folder)
    names = [n.split("=", 1)[1] for n in list_names(df.sparkSession, folder) if n.startswith(f"{LOAD_DATE}=")]
    return seen.get["rows"], [date.fromisoformat(n) for n in names]


def replace_partitions(
    df: DataFrame,
    path: str,
    emptied: Iterable[date] | None = (),
    columns: Mapping[date, Mapping[str, str]] | None = None,
    dates: int | None = None,
    by: str | None = None,
) -> int:
    """Replace the partitions that ``df`` has rows for, drop those in ``emptied`` (None: all others), and return the
    rows written. ``columns``: unknown source columns of load dates, for the table's record. ``dates``, ``by``: see `gathered`.

    All of it becomes visible at once. A key index beside the table ends with this; the next upsert builds it anew.
    """
    spark, version = df.sparkSession, V.new_version()
    base = V.current(spark, path)
    rows, written = write_version(df, path, version, dates, by)
    parts = dict(base.parts) if base and emptied is not None else {}
    for day in emptied or ():
        parts.pop(day, None)
    parts.update({day: (version,) for day in written})
    known = {**(base.columns if base else {}), **{d: {} for d in written}, **(columns or {})}
    V.commit(spark, path, base, parts, columns=known)
    return rows


def overwrite_partition(
    df: DataFrame, path: str, load_date: date, columns: Mapping[str, str] | None = None, by: str | None = None
) -> int:
    """Make ``df`` the whole content of one partition, also when it is empty; other partitions stay as they are."""
    rows = df.withColumn(LOAD_DATE, F.lit(load_date))
    return replace_partitions(rows, path, [load_date], {load_date: columns or {}}, dates=1, by=by)


def unknown_columns(spark: SparkSession, path: str) -> DataFrame:
    """The table's record of unknown source columns: load date, column name and type, as the manifest has them."""
    manifest = V.current(spark, path)
    found = manifest.columns if manifest else {}
    rows = [(day, name, kind) for day, held in sorted(found.items()) for name, kind in sorted(held.items())]
    return spark.createDataFrame(rows, UNKNOWN_COLUMNS)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a plain folder."""
    df.write.mode("append").parquet(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a plain folder."""
    return spark.read.schema(schema).parquet(path)


def snapshot_path(path: str, version: str) -> str:
    return V.version_path(path, version)


def write_snapshot(df: DataFrame, path: str, version: str) -> str:
    """Write a full rebuild beside the published one; readers do not see it until `publish_snapshot`."""
    target = snapshot_path(path, version)
    df.write.mode("overwrite").parquet(target)
    return target


def publish_snapshot(spark: SparkSession, path: str, version: str) -> None:
    """Make a finished snapshot the whole table."""
    V.commit(spark, path, V.current(spark, path), {None: (version,)})


def current_version(spark: SparkSession, path: str) -> str | None:
    manifest = V.current(spark, path)
    return manifest.parts[None][0] if manifest and None in manifest.parts else None


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no published snapshot under {path}")
    return spark.read.schema(schema).parquet(snapshot_path(path, version))

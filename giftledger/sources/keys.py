"""Key index of a table: which load date holds a key, bucketed by the key.

A row says that from a version on a key lies in a load date (null: withdrawn), with 128 bits of hashes of the row's other
columns. The rows are a bucketed Parquet table, so Spark joins and groups them by key without shuffling the history; only
the batch is dealt into the buckets. Every upsert adds the rows of its batch; rows count once the manifest names
their version, so those of a failed write are passed over. After `MOST` versions the index is written anew with one
row for each key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOAD_DATE
from .versions import KeyIndex, keys_path, new_version

MOST = 8
HASHES = ("hash_1", "hash_2")


def content_hashes(schema: T.StructType, keys: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row's content beside key and load date."""
    rest = [c for c in schema.fieldNames() if c not in keys and c != LOAD_DATE]
    parts = [part for c in rest for part in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(HASHES)]


def _catalog_table(spark: SparkSession, path: str, index: KeyIndex, key_types: Sequence[str]) -> str:
    """The index as a table of the session, which is where Spark keeps the number of buckets."""
    name, location = f"keys_{index.generation}", keys_path(path, index.generation).replace("'", "\\'")
    columns = [*[f"`{k}` {t}" for k, t in zip(index.keys, key_types)], f"`{LOAD_DATE}` date", "hash_1 bigint", "hash_2 bigint", "seq bigint", "version string"]
    by = ", ".join(f"`{k}`" for k in index.keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet CLUSTERED BY ({by}) INTO {index.buckets} BUCKETS LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return name


def _types(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    return [schema[k].dataType.simpleString() for k in keys]


def append(spark: SparkSession, path: str, schema: T.StructType, index: KeyIndex, rows: DataFrame, seq: int, version: str) -> KeyIndex:
    """Add rows (keys, load date, hashes) under a version; they count once a manifest has the returned index."""
    table = _catalog_table(spark, path, index, _types(schema, index.keys))
    rows = rows.select(*index.keys, LOAD_DATE, *HASHES, F.lit(seq).cast("bigint").alias("seq"), F.lit(version).alias("version"))
    rows.repartition(index.buckets, *index.keys).write.mode("append").insertInto(table)
    return KeyIndex(index.keys, index.buckets, index.generation, (*index.versions, version))


def latest(spark: SparkSession, path: str, schema: T.StructType, index: KeyIndex) -> DataFrame:
    """Keys, load date and hashes of all keys the table holds."""
    rows = spark.table(_catalog_table(spark, path, index, _types(schema, index.keys)))
    rows = rows.where(F.col("version").isin(*index.versions))
    if len(index.versions) > 1:
        newest = F.max_by(F.struct(LOAD_DATE, *HASHES), "seq").alias("newest")
        rows = rows.groupBy(*index.keys).agg(newest).select(*index.keys, "newest.*")
    return rows.where(F.col(LOAD_DATE).isNotNull()).select(*index.keys, LOAD_DATE, *HASHES)


def empty(spark: SparkSession, keys: Sequence[str], buckets: int | None = None) -> KeyIndex:
    """A new index without rows, with as many buckets as the session has shuffle partitions."""
    return KeyIndex(tuple(keys), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), new_version(), ())


def build(spark: SparkSession, path: str, schema: T.StructType, index: KeyIndex, rows: DataFrame, seq: int) -> KeyIndex:
    """``rows`` (keys, load date, hashes) as the only rows of a new, empty index."""
    return append(spark, path, schema, index, rows, seq, index.generation)

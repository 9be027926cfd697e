"""Profile of a delimited source: blanks per column, key population, repeated keys, totals, a sample.

Inputs may carry the ``_corrupt_record`` column of the readers. Malformed rows count towards the total but not
towards any column figure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import is_blank, percent, strip_whitespace
from ..schemas import LOAD_DATE
from ..sources.delimited import MALFORMED, good_rows
from ..sources.workspace import scratch_path

GIFT_KEY = ("NAME", "TRANSACTION_DT", "TRANSACTION_AMT")
# Shares of populated keys above which a key counts as reliable, or at least preferred.
RELIABLE_ABOVE = 95
PREFERRED_ABOVE = 50


def _is_good(df: DataFrame) -> Column:
    return F.col(MALFORMED).isNull() if MALFORMED in df.columns else F.lit(True)


def _only_good(df: DataFrame) -> DataFrame:
    return good_rows(df) if MALFORMED in df.columns else df


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (MALFORMED, LOAD_DATE)]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _total_metrics(df: DataFrame) -> list[Column]:
    good = _is_good(df)
    return [F.count(F.lit(1)).alias("total"), F.count_if(~good).alias("skipped")]


def _blank_metrics(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    good = _is_good(df)
    return [F.count_if(good & is_blank(_text(c))).alias(f"blank_{i}") for i, c in enumerate(columns)]


def _populated_metric(df: DataFrame, key: str) -> Column:
    return F.count_if(_is_good(df) & ~is_blank(_text(key))).alias("populated")


def _totals(metrics: DataFrame, sample_rows: int) -> DataFrame:
    return metrics.select(
        F.col("total").alias("total_rows"),
        F.col("skipped").alias("skipped_rows"),
        F.least(F.col("total") - F.col("skipped"), F.lit(sample_rows).cast("bigint")).alias("sampled_rows"),
    )


def _null_rows(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    by_column = [F.struct(F.lit(c).alias("column_name"), F.col(f"blank_{i}").alias("null_count")) for i, c in enumerate(columns)]
    return metrics.select("total", F.posexplode(F.array(*by_column)).alias("position", "entry")).select(
        "position",
        "entry.column_name",
        "entry.null_count",
        percent("entry.null_count", "total").alias("null_pct"),
    )


def _most_blank(profile: DataFrame, n: int) -> DataFrame:
    return profile.where("null_count > 0").orderBy(F.desc("null_count"), "position").limit(n)


def _population(metrics: DataFrame) -> DataFrame:
    share = F.coalesce(F.col("populated") * 100 / F.when(F.col("total") != 0, F.col("total")), F.lit(0.0))
    verdict = F.when(share > RELIABLE_ABOVE, "reliable").when(share > PREFERRED_ABOVE, "preferred").otherwise("fallback")
    return metrics.select("populated", "total", percent("populated", "total").alias("pct"), verdict.alias("verdict"))


def totals(df: DataFrame, sample_rows: int) -> DataFrame:
    """All rows, malformed rows, and the rows a sample of ``sample_rows`` will have."""
    return _totals(df.agg(*_total_metrics(df)), sample_rows)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Blank values per column and their share of all rows; one scan, one row per task, then turned on its side."""
    columns = list(columns or _data_columns(df))
    return _null_rows(df.agg(*_total_metrics(df), *_blank_metrics(df, columns)), columns)


def top_null_columns(df: DataFrame, n: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` columns with most blanks; ties in column order; columns without blanks are left out."""
    return _most_blank(null_profile(df, columns), n)


def key_population(df: DataFrame, key: str = "SUB_ID") -> DataFrame:
    """How many rows have the key, and whether that makes it fit to merge on."""
    return _population(df.agg(*_total_metrics(df), _populated_metric(df, key)))


def _key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    stripped = [strip_whitespace(F.coalesce(_text(c), F.lit(""))).alias(c) for c in key]
    return _only_good(df).select(*stripped).groupBy(*key).agg(F.count("*").alias("n"))


def _duplicate_metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("unique_keys"), F.count_if(F.col("n") > 1).alias("repeated_keys")]


def _most_repeated(counts: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    return counts.where("n > 1").orderBy(F.desc("n"), *key).limit(n)


def duplicate_profile(df: DataFrame, key: Sequence[str] = GIFT_KEY) -> DataFrame:
    """Distinct key combinations and how many of them occur more than once."""
    return _key_counts(df, key).agg(*_duplicate_metrics())


def duplicate_examples(df: DataFrame, n: int = 5, key: Sequence[str] = GIFT_KEY) -> DataFrame:
    """The ``n`` most repeated keys."""
    return _most_repeated(_key_counts(df, key), n, key)


def _smallest(rows: DataFrame, by: Column, n: int, groups: Sequence[int]) -> DataFrame:
    """Rows among which the ``n`` smallest are, a bounded number: partitions are put into groups, each group keeps
    its ``n`` smallest (cut down once more on the map side, by Spark's group limit), then groups of groups do."""
    rows = rows.withColumn("sample_group", F.spark_partition_id())
    for width in groups:
        rows = rows.withColumn("sample_group", F.pmod("sample_group", F.lit(width)))
        rank = F.row_number().over(Window.partitionBy("sample_group").orderBy(by))
        rows = rows.withColumn("sample_rank", rank).where(F.col("sample_rank") <= n).drop("sample_rank")
    return rows.drop("sample_group")


def first_rows(df: DataFrame, n: int = 50_000, key: str = "SUB_ID", groups: Sequence[int] = (1024, 32)) -> DataFrame:
    """The ``n`` rows with the smallest key, null first; ties are taken by a hash of the whole row.

    A plain sort-and-limit sends up to ``n`` whole rows of every input partition to one task. Here the n-th smallest
    key is found first, on the key alone. The rows up to that key are then read with an ordinary filter: ``n``, and
    those that tie with the last. Only they are hashed, and cut down in groups again, so that a repeated key does not
    gather its rows in one task; only rows that are the same in every column stay tied.
    """
    rows = _only_good(df)
    keys = rows.select(F.struct(F.col(key).alias("key")).alias("place"))  # in a struct, null is the smallest
    last = _smallest(keys, F.col("place"), n, groups).orderBy("place").limit(n).agg(F.max("place"))
    near = rows.where(F.struct(F.col(key).alias("key")) <= last.scalar())
    tie = F.xxhash64(*[part for c in rows.columns for part in (F.col(c).isNull(), F.col(c))])
    placed = near.withColumn("sample_place", F.struct(F.col(key).alias("key"), tie.alias("tie")))
    return _smallest(placed, F.col("sample_place"), n, groups).orderBy("sample_place").limit(n).drop("sample_place")


def blank_zip_rate(staged: DataFrame) -> DataFrame:
    """Records without a normalized ZIP, per load date."""
    return (
        staged.groupBy(F.col(LOAD_DATE).alias("load_date"))
        .agg(F.count_if(F.col("zip_normalized") == "").alias("blank"), F.count("*").alias("total"))
        .withColumn("pct", percent("blank", "total"))
    )


def _one_row(spark: SparkSession, found: Observation) -> DataFrame:
    values = found.get
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{name} bigint" for name in values))


def profile_report(df: DataFrame, sample_rows: int = 50_000, key: str = "SUB_ID", gift: Sequence[str] = GIFT_KEY) -> dict[str, DataFrame]:
    """All profile results by name, and the sample; the source is read once.

    The text is parsed into a columnar scratch table, and what a single pass can count is observed on the way. The
    repeated keys come from one grouping of three columns of that table, which counts the keys while the most repeated
    are picked; the sample reads the key column and then the rows it needs.
    """
    spark, columns = df.sparkSession, _data_columns(df)
    seen, grouped, path = Observation(), Observation(), scratch_path(df.sparkSession, "profile")
    df.observe(seen, *_total_metrics(df), _populated_metric(df, key), *_blank_metrics(df, columns)).write.parquet(path)
    stored, metrics = spark.read.schema(df.schema).parquet(path), _one_row(spark, seen)
    counts = _key_counts(stored, gift).observe(grouped, *_duplicate_metrics())
    examples = _most_repeated(counts, 5, gift)
    examples = spark.createDataFrame(examples.collect(), examples.schema)  # five rows
    return {
        "totals": _totals(metrics, sample_rows),
        "key_population": _population(metrics),
        "top_null_columns": _most_blank(_null_rows(metrics, columns), 10),
        "duplicates": _one_row(spark, grouped),
        "duplicate_examples": examples,
        "sample": first_rows(stored, sample_rows, key),
    }

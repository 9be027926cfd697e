"""What the corpus operators share: the columns they take, text keys, and tables of intermediate results.

A text is identified by the MD5 of its bytes. Decisions that depend on a text alone are made once for each text and
joined back by that key, so repeated rows, repeated ids and null ids all keep their own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import delete_path, scratch_path

#: Separates words everywhere but in decontamination: space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Lists of text keys (32 bytes each) are broadcast up to this many, and joined by shuffle beyond.
BROADCAST_KEYS = 1_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_key(text: Column) -> Column:
    """The key of a text; a null text has the key of the empty text."""
    return F.md5(F.encode(F.coalesce(text.cast("string"), F.lit("")), "UTF-8"))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: CRC-32 of the id's decimal text leaves 1 modulo 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def label_of(labels: DataFrame, name: str) -> DataFrame:
    """One 0/1 label for each id: the majority of its rows that have one, ties to 1; other rows are left out."""
    given = labels.select(F.col("doc_id"), F.col(name).cast("double").alias("y"))
    given = given.where("doc_id IS NOT NULL AND y IS NOT NULL")
    return given.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))


class Steps:
    """Intermediate tables of one run of an operator, in the folder the cluster shares.

    Each step is computed once and read back by column, so a lost executor costs a task and never the steps before.
    Spark drops the shuffle files of finished steps at its own time, `spark.cleaner.periodicGC.interval`.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder = spark, scratch_path(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            delete_path(self.spark, f"{self.folder}/{name}")

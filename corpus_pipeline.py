"""From documents to a training mix, in five stages; each works on all rows that the stage before has kept.

A stage takes (spark, docs, folder of tables) and returns a DataFrame. All but the last return the columns of
documents; so does the last, with a row for each time a document is taken. The quality stage drops documents that score below one half; near duplicates keep the row with the smallest
id; contaminated documents go; secrets are masked inside the text (and n_chars counts the masked text); the mix emits each document as often as its source's target
asks for.

Defined results: null texts are judged as empty ones; rows without an id stay unless their text goes; without labels of
training rows the quality stage keeps all; an empty benchmark or empty documents change nothing and give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftledger.llm import decontaminate, mixing, quality, secrets, simhash
from giftledger.llm.common import Steps, read


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more."""
    return quality.good_documents(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    masked = secrets.masked_documents(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: The quality classifier is trained, so SQL cannot express the rows of `run`; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is stored and read again by the next."""
    steps, docs = Steps(spark, "pipeline"), read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = steps.keep(stage(spark, docs, sf_dir), f"stage-{place}")
    return docs

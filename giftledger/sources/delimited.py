"""Delimited text: readers that keep malformed rows apart, and the writer.

Every column is read as a string and cast later, because a typed read turns a bad value into a silent null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOAD_DATE, source_schema

MALFORMED = "_corrupt_record"
PIPE = "|"


def _reader(spark: SparkSession, columns: list[str], encoding: str, multi_line: bool, sep: str = PIPE):
    schema = source_schema(columns).add(T.StructField(MALFORMED, T.StringType()))
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')  # a doubled quote inside a quoted field
        .option("multiLine", multi_line)  # quoted line breaks; makes a file unsplittable, so off by default
        .option("columnPruning", False)  # else a query of few columns would miss rows with a wrong field count
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
    )


def _no_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """An empty field stays an empty string (Spark reads it as null)."""
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in columns}
    # Spark refuses a plan that needs nothing but the malformed lines, so they are tied to a data column.
    malformed = F.when(F.length(texts[columns[0]]) >= 0, F.col(MALFORMED)).alias(MALFORMED)
    return df.select(*[text.alias(c) for c, text in texts.items()], malformed)


def header_names(spark: SparkSession, header_path: str, sep: str = ",") -> list[str]:
    """Column names from the first line of a separate header file."""
    return [name.strip() for name in spark.read.option("header", True).option("sep", sep).csv(header_path).columns]


def read_headerless(
    spark: SparkSession,
    path: str,
    header_path: str | None = None,
    columns: list[str] | None = None,
    encoding: str = "ISO-8859-1",
    multi_line: bool = False,
) -> DataFrame:
    """Pipe-delimited text without a header line; names come from ``columns`` or from a header file.

    The result has one extra column, ``_corrupt_record``: the source line of a row whose field count is wrong, else
    null. `good_rows` and `malformed_rows` split the two. Lines are parsed in full whichever columns a query uses,
    so a wrong field count is always seen.
    """
    if columns is None:
        if header_path is None:
            raise ValueError("give columns or header_path")
        columns = header_names(spark, header_path)
    return _no_nulls(_reader(spark, columns, encoding, multi_line).csv(path), columns)


def read_with_header(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False, sep: str = PIPE
) -> DataFrame:
    """Delimited text with a header line, every column a string; a file with another header is an error."""
    columns = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(path).columns
    reader = _reader(spark, columns, encoding, multi_line, sep).option("header", True).option("enforceSchema", False)
    return _no_nulls(reader.csv(path), columns)


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed_rows(df: DataFrame) -> DataFrame:
    """The quarantine: source lines with a wrong field count."""
    return df.where(F.col(MALFORMED).isNotNull()).select(MALFORMED)


def require_well_formed(df: DataFrame) -> DataFrame:
    """Stop the job at the first malformed row (checked inside the plan, row by row)."""
    message = F.concat(F.lit("malformed row: "), F.col(MALFORMED))
    return df.where(F.when(F.col(MALFORMED).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))).drop(
        MALFORMED
    )


def write_delimited(
    df: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8", mode: str = "error", sep: str = PIPE
) -> None:
    """Delimited text; nulls and empty strings both become an empty field, and blanks are kept as they are."""
    (
        df.write.mode(mode)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_identity_fixture(spark: SparkSession, path: str, execution_date) -> DataFrame:
    """Comma-delimited scenario file as a staging-shaped slice for identity resolution."""
    rows = require_well_formed(read_with_header(spark, path, sep=","))
    return rows.select(
        F.col("record_id").alias("sub_id"),
        "donor_name_normalized",
        "donor_address_normalized",
        "zip_normalized",
        F.lit(execution_date).cast("date").alias(LOAD_DATE),
    )

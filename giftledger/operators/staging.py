"""Raw records to staging rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    address_source,
    normalize_address,
    normalize_name,
    normalize_zip,
    parse_amount,
    parse_contribution_date,
    strict_cast,
)
from ..schemas import AMOUNT, LOAD_DATE, RAW, SOURCE_COLUMNS, UNKNOWN

INDIVIDUAL = "IND"


def add_load_date(df: DataFrame, execution_date: date) -> DataFrame:
    """Give every row of one load the same date; it decides which partition the load replaces."""
    return df.withColumn(LOAD_DATE, F.lit(execution_date).cast("date"))


def enforce_raw_schema(df: DataFrame) -> DataFrame:
    """Exactly the raw columns with their types: unknown columns go, a missing one or a bad value is an error."""
    return df.select(
        *[
            F.col(f.name) if isinstance(f.dataType, T.StringType) else strict_cast(f.name, f.dataType).alias(f.name)
            for f in RAW.fields
        ]
    )


def unknown_columns(df: DataFrame) -> dict[str, str]:
    """Columns of a source that the raw schema does not have, with their types."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in RAW.fieldNames()}


def keep_unknown_columns(df: DataFrame) -> DataFrame:
    """The raw columns with their types and one map of all other columns as text, so a source that grows loses nothing.

    The map is null where the source has no other columns; values of other types than text are written as Spark casts
    them, nested ones as JSON. A missing raw column or a bad value is still an error.
    """
    entries = []
    for f in df.schema.fields:
        if f.name not in RAW.fieldNames():
            value = F.col(f"`{f.name}`")
            nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
            entries += [F.lit(f.name), F.to_json(value) if nested else value.cast("string")]
    kept = F.create_map(*entries) if entries else F.lit(None)
    known = [
        F.col(f.name) if isinstance(f.dataType, T.StringType) else strict_cast(f.name, f.dataType).alias(f.name)
        for f in RAW.fields
    ]
    return df.select(*known, kept.cast("map<string,string>").alias(UNKNOWN))


def unknown_values(raw: DataFrame) -> DataFrame:
    """One row for each record and unknown column: SUB_ID, load date, column name and value (null stays null)."""
    return raw.select("SUB_ID", LOAD_DATE, F.explode(UNKNOWN).alias("column_name", "value"))


def select_source_columns(df: DataFrame) -> DataFrame:
    """The 21 source columns by name, whatever else is there and in whatever order."""
    return df.select(*SOURCE_COLUMNS)


def filter_individuals(df: DataFrame) -> DataFrame:
    return df.where(F.col("ENTITY_TP") == INDIVIDUAL)


def individual_counts(df: DataFrame) -> DataFrame:
    """Rows before the individuals filter, after it, and removed by it, in one pass."""
    kept = F.count_if(F.col("ENTITY_TP") == INDIVIDUAL)
    return df.agg(
        F.count("*").alias("rows_before"), kept.alias("rows_after"), (F.count("*") - kept).alias("rows_removed")
    )


def normalized_columns() -> dict[str, Column]:
    return {
        "donor_name_normalized": normalize_name("NAME"),
        "donor_address_normalized": normalize_address(address_source("CITY", "STATE")),
        "zip_normalized": normalize_zip("ZIP_CODE"),
    }


def apply_normalization(df: DataFrame) -> DataFrame:
    """Append the normalized name, address and ZIP."""
    return df.withColumns(normalized_columns())


def build_staging(
    raw: DataFrame, lenient_dates: bool = False, amount_type: T.DecimalType = AMOUNT
) -> DataFrame:
    """Individuals only, cleaned; the raw values stay beside the normalized ones. One narrow stage, no shuffle."""
    return (
        apply_normalization(filter_individuals(raw))
        .select(
            F.col("SUB_ID").alias("sub_id"),
            F.col("CMTE_ID").alias("cmte_id"),
            F.col("TRAN_ID").alias("tran_id"),
            F.col("NAME").alias("name_raw"),
            F.col("CITY").alias("city_raw"),
            F.col("STATE").alias("state"),
            F.col("ZIP_CODE").alias("zip_raw"),
            "donor_name_normalized",
            "donor_address_normalized",
            "zip_normalized",
            parse_amount("TRANSACTION_AMT", amount_type).alias("contribution_amount"),
            parse_contribution_date("TRANSACTION_DT", lenient_dates).alias("contribution_date"),
            F.col("ENTITY_TP").alias("entity_type"),
            LOAD_DATE,
        )
    )


def unparseable_dates(staged: DataFrame) -> DataFrame:
    return staged.agg(F.count_if(F.col("contribution_date").isNull()).alias("unparseable_dates"))

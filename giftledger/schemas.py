"""Fixed table schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

LOAD_DATE = "_load_date"
AMOUNT = T.DecimalType(38, 9)
SCORE = T.DecimalType(4, 2)

# The 21 source columns in file order.
SOURCE_COLUMNS = (
    "CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM", "TRANSACTION_TP", "ENTITY_TP",
    "NAME", "CITY", "STATE", "ZIP_CODE", "EMPLOYER", "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT",
    "OTHER_ID", "TRAN_ID", "FILE_NUM", "MEMO_CD", "MEMO_TEXT", "SUB_ID",
)

RECORD_ID = "SUB_ID"


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


def _strings(*names: str) -> dict[str, T.DataType]:
    return {name: T.StringType() for name in names}


def source_schema(columns=SOURCE_COLUMNS) -> T.StructType:
    """Delimited text before any cast: every column is a string."""
    return _table(**_strings(*columns))


# Fixed values below: column names, order and types of the tables.
RAW = T.StructType(
    [T.StructField(c, AMOUNT if c == "TRANSACTION_AMT" else T.StringType()) for c in SOURCE_COLUMNS]
    + [T.StructField(LOAD_DATE, T.DateType(), nullable=False)]
)

#: What the raw table stores beside the fixed columns: values of columns the source has and we do not know, by name.
UNKNOWN = "unknown_columns"
RAW_STORED = T.StructType([*RAW.fields, T.StructField(UNKNOWN, T.MapType(T.StringType(), T.StringType()))])

UNKNOWN_COLUMNS = _table(load_date=T.DateType(), column_name=T.StringType(), column_type=T.StringType())

STAGING = _table(
    **_strings("sub_id", "cmte_id", "tran_id", "name_raw", "city_raw", "state", "zip_raw"),
    **_strings("donor_name_normalized", "donor_address_normalized", "zip_normalized"),
    contribution_amount=AMOUNT,
    contribution_date=T.DateType(),
    entity_type=T.StringType(),
    _load_date=T.DateType(),
)

DIM_DONORS = T.StructType(
    [T.StructField("donor_id", T.StringType(), nullable=False)]
    + _table(
        **_strings("sub_id", "donor_name_normalized", "donor_address_normalized", "zip_normalized", "match_rule"),
        identity_conflict=T.BooleanType(),
        _load_date=T.DateType(),
    ).fields
)

UNRESOLVED = _table(
    **_strings("donor_id", "sub_id", "donor_name_normalized", "donor_address_normalized"),
    **_strings("zip_normalized", "conflict_reason"),
    _load_date=T.DateType(),
)

MART = _table(
    donor_id=T.StringType(),
    contribution_count=T.LongType(),
    total_amount=AMOUNT,
    first_contribution_date=T.DateType(),
    last_contribution_date=T.DateType(),
    days_since_last=T.IntegerType(),
    recency_score=T.IntegerType(),
    frequency_score=T.IntegerType(),
    monetary_score=T.IntegerType(),
    engagement_score=SCORE,
)

RUN_LOG = _table(
    run_id=T.StringType(),
    execution_date=T.DateType(),
    task_name=T.StringType(),
    row_count_input=T.LongType(),
    row_count_output=T.LongType(),
    status=T.StringType(),
    timestamp=T.TimestampType(),
)

# The column types a table may use.
ALLOWED_TYPES = (
    T.StringType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.BooleanType,
)

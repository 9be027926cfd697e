"""The registered queries: each takes (spark, folder of test tables) and returns a DataFrame.

Every one reads the whole test tables through the contribution-record view. Those that exercise writers write to
the shared scratch folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    address_source,
    normalize_address,
    normalize_name,
    normalize_zip,
    parse_amount,
    parse_contribution_date,
    parse_iso_date,
)
from ..operators import identity as I
from ..operators import mart as M
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import staging as S
from ..operators import upsert as U
from ..schemas import AMOUNT, DIM_DONORS, LOAD_DATE, MART, RAW, RAW_STORED, RECORD_ID, SOURCE_COLUMNS, STAGING
from ..sources import delimited as D
from ..sources import tables as tb
from ..sources.testdata import contribution_records
from ..sources.workspace import scratch_path
from . import daily_run as R
from .runlog import log_task, read_run_log

Query = Callable[[SparkSession, str], DataFrame]

MONEY = T.DecimalType(18, 2)
DAYS = (date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3))
RESEND_DAY = date(2025, 1, 4)
AS_OF = date(2001, 8, 2)
SAMPLE_ROWS = 10_000
LOOKUP_ID = "1230"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contribution_records(spark, sf_dir)


def _staging(raw: DataFrame, **options) -> DataFrame:
    """Records of the view, staged, with the view's expressions and those of staging in generated methods of their own.

    Together they exceed the 8000 bytes of bytecode that the JVM compiles, and are interpreted at half the speed. A count
    observed between them ends the first method; the jobs read stored records and do not need it.
    """
    individuals = S.filter_individuals(raw).observe(f"records-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    return S.build_staging(individuals, **options)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staging(_raw(spark, sf_dir), amount_type=MONEY)


def _stored(df: DataFrame, label: str, partitioned: bool = True) -> DataFrame:
    """``df`` as a scratch table, the way the jobs see their inputs: computed once, then scanned by column.

    Identity, mart and gates each pass over their input several times; without this every pass would repeat the
    joins and the normalization behind it.
    """
    path = scratch_path(df.sparkSession, label)
    writer = tb.gathered(df, len(DAYS), RECORD_ID).write.partitionBy(LOAD_DATE) if partitioned else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _staging_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(_staging(_raw(spark, sf_dir)), "staging")


def _public(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(LOAD_DATE, "load_date")


def _amended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amended filings sent again on a later day with a corrected amount."""
    amended = _raw(spark, sf_dir).where("AMNDT_IND = 'A'")
    return amended.withColumns(
        {"TRANSACTION_AMT": F.col("TRANSACTION_AMT") + 100, LOAD_DATE: F.lit(RESEND_DAY)}
    )


# --- sources, filters, staging ---------------------------------------------------------------------------------


@query
def filter_individuals(spark, sf_dir):
    return S.individual_counts(_raw(spark, sf_dir))


@query
def raw_partition_counts(spark, sf_dir):
    return tb.partition_row_count(_raw(spark, sf_dir))


def _write_raw(spark, sf_dir) -> tuple[DataFrame, str]:
    """The records as a raw table; returns them and the path."""
    raw, path = _raw(spark, sf_dir), scratch_path(spark, "raw")
    tb.ensure_table(spark, path, RAW)
    tb.replace_partitions(S.enforce_raw_schema(raw), path)
    return raw, path


@query
def raw_reconcile(spark, sf_dir):
    raw, path = _write_raw(spark, sf_dir)
    sent = tb.partition_row_count(raw).withColumnRenamed("row_count", "rows_in")
    stored = tb.partition_row_count(tb.read_table(spark, path, RAW)).withColumnRenamed("row_count", "rows_out")
    both = sent.join(stored, "load_date", "full").select(
        "load_date",
        F.coalesce("rows_in", F.lit(0)).alias("rows_in"),
        F.coalesce("rows_out", F.lit(0)).alias("rows_out"),
    )
    return both.withColumn("status", F.when(F.col("rows_in") == F.col("rows_out"), "PASS").otherwise("FAIL"))


@query
def partition_overwrite(spark, sf_dir):
    """Load every day, then the first day twice more; other days and row counts must not change."""
    raw, path = _write_raw(spark, sf_dir)
    for _ in range(2):
        day = S.select_source_columns(raw.where(F.col(LOAD_DATE) == F.lit(DAYS[0])))
        R.ingest_raw(spark, day, DAYS[0], path)
    return tb.partition_row_count(tb.read_table(spark, path, RAW))


@query
def raw_partition_read(spark, sf_dir):
    """One load date of the stored raw table, all columns."""
    _, path = _write_raw(spark, sf_dir)
    day = tb.read_partition(spark, path, RAW, DAYS[1])
    return _public(day.withColumn("TRANSACTION_AMT", F.col("TRANSACTION_AMT").cast(MONEY)))


@query
def raw_unknown_columns(spark, sf_dir):
    """Days loaded from sources with other columns each: none unknown, one, and two; their values as stored."""
    raw, path = _raw(spark, sf_dir), scratch_path(spark, "raw")
    origin = F.concat(F.lit("origin "), F.col("FILE_NUM"))
    more = [{}, {"ORIGIN": origin}, {"ORIGIN": origin, "AMOUNT_IN_CENTS": (F.col("TRANSACTION_AMT") * 100).cast("bigint")}]
    for day, columns in zip(DAYS, more):
        R.ingest_raw(spark, raw.where(F.col(LOAD_DATE) == F.lit(day)).drop(LOAD_DATE).withColumns(columns), day, path)
    values = S.unknown_values(tb.read_table(spark, path, RAW_STORED))
    named = tb.unknown_columns(spark, path).withColumnRenamed("load_date", LOAD_DATE)
    return _public(values.join(F.broadcast(named), [LOAD_DATE, "column_name"]))  # one row for each day and unknown column


@query
def csv_roundtrip(spark, sf_dir):
    """Records written as delimited text, read back as strings, cast to the raw types."""
    path = scratch_path(spark, "text")
    D.write_delimited(S.select_source_columns(_raw(spark, sf_dir)), path)
    rows = S.add_load_date(D.require_well_formed(D.read_with_header(spark, path)), DAYS[0])
    typed = S.enforce_raw_schema(rows).drop(LOAD_DATE)
    return typed.withColumn("TRANSACTION_AMT", F.col("TRANSACTION_AMT").cast(MONEY))


def _broken_text(spark, sf_dir) -> DataFrame:
    """Records as headerless text in the source's encoding, where memo records have lost a field or grown one."""
    path = scratch_path(spark, "broken")
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SOURCE_COLUMNS])
    short = F.regexp_replace(line, r"\|[^|]*$", "")
    lines = _raw(spark, sf_dir).select(
        F.when(F.col("MEMO_CD").isNull(), line)
        .when(F.col("AMNDT_IND") == "A", short)
        .otherwise(F.concat(line, F.lit("|extra")))
    )
    lines.write.text(path)
    return D.read_headerless(spark, path, columns=list(SOURCE_COLUMNS))


@query
def malformed_rows(spark, sf_dir):
    return P.totals(_broken_text(spark, sf_dir), SAMPLE_ROWS)


@query
def malformed_null_profile(spark, sf_dir):
    """Malformed rows count towards the total but not towards the blanks."""
    return P.null_profile(_broken_text(spark, sf_dir)).drop("position")


@query
def schema_select(spark, sf_dir):
    """A source with an unknown column in front: known columns are taken by name."""
    grown = _raw(spark, sf_dir).select(F.lit("new").alias("UNKNOWN"), "*")
    return S.select_source_columns(grown).select("SUB_ID", "NAME", "ZIP_CODE", "TRANSACTION_DT", "TRANSACTION_AMT")


@query
def sample_first_n(spark, sf_dir):
    return P.first_rows(S.select_source_columns(_raw(spark, sf_dir)), SAMPLE_ROWS)


@query
def normalize_names(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        F.col("SUB_ID").alias("sub_id"), F.col("NAME").alias("raw"), normalize_name("NAME").alias("normalized")
    )


@query
def normalize_addresses(spark, sf_dir):
    source = address_source("CITY", "STATE")
    return _raw(spark, sf_dir).select(
        F.col("SUB_ID").alias("sub_id"), source.alias("raw"), normalize_address(source).alias("normalized")
    )


@query
def normalize_zips(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        F.col("SUB_ID").alias("sub_id"), F.col("ZIP_CODE").alias("raw"), normalize_zip("ZIP_CODE").alias("normalized")
    )


@query
def parse_contribution_dates(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        F.col("SUB_ID").alias("sub_id"), parse_contribution_date("TRANSACTION_DT").alias("contribution_date")
    )


@query
def parse_dates_lenient(spark, sf_dir):
    """Dates written without leading zeros, read leniently, beside the strict reading."""
    text = F.regexp_replace("TRANSACTION_DT", "^0", "")
    return _raw(spark, sf_dir).select(
        F.col("SUB_ID").alias("sub_id"),
        parse_contribution_date(text, lenient=True).alias("lenient"),
        parse_contribution_date(text).alias("strict"),
    )


@query
def unparseable_dates(spark, sf_dir):
    return S.unparseable_dates(_staged(spark, sf_dir))


@query
def safe_cast_amount(spark, sf_dir):
    """Amounts as text, with 'None' where the filing is amended; what is not a number becomes null."""
    text = F.when(F.col("AMNDT_IND") == "A", "None").otherwise(F.col("TRANSACTION_AMT").cast("string"))
    return _raw(spark, sf_dir).select(
        F.col("SUB_ID").alias("sub_id"), parse_amount(text, MONEY).alias("contribution_amount")
    )


@query
def parse_iso_dates(spark, sf_dir):
    """Load dates through text and back; a text that is not a date becomes null."""
    text = F.when(F.col("AMNDT_IND") == "A", "None").otherwise(F.date_format(LOAD_DATE, "yyyy-MM-dd"))
    return _raw(spark, sf_dir).select(F.col("SUB_ID").alias("sub_id"), parse_iso_date(text).alias("load_date"))


@query
def staging_rows(spark, sf_dir):
    return _public(_staged(spark, sf_dir))


@query
def staging_upsert(spark, sf_dir):
    """Staged records, then amended filings sent again on a later day: old rows are replaced, not repeated."""
    resent = _staging(_amended(spark, sf_dir), amount_type=MONEY)
    return _public(U.merge_rows(_staged(spark, sf_dir), resent))


@query
def staging_upsert_table(spark, sf_dir):
    """The same through a stored table: days one and two, then day three with the amended filings of all days."""
    path = scratch_path(spark, "staging")
    tb.ensure_table(spark, path, STAGING)
    raw = _raw(spark, sf_dir)
    first = raw.where(F.col(LOAD_DATE) < F.lit(DAYS[2]))
    U.upsert_table(spark, path, STAGING, _staging(first))
    rest = raw.where((F.col(LOAD_DATE) == F.lit(DAYS[2])) & (F.col("AMNDT_IND") != "A"))
    batch = _staging(rest.unionByName(_amended(spark, sf_dir)))
    U.upsert_table(spark, path, STAGING, batch)
    stored = tb.read_table(spark, path, STAGING)
    return _public(stored.withColumn("contribution_amount", F.col("contribution_amount").cast(MONEY)))


@query
def upsert_fallback_key(spark, sf_dir):
    """Upsert on name + date + amount: the first two days are the target, the third day the source."""
    columns = [*U.FALLBACK_KEY, "sub_id", LOAD_DATE]
    staged = _staged(spark, sf_dir).select(*columns)
    target = staged.where(F.col(LOAD_DATE) < F.lit(DAYS[2]))
    source = staged.where(F.col(LOAD_DATE) == F.lit(DAYS[2]))
    return _public(U.merge_on_fallback_key(target, source))


# --- identity --------------------------------------------------------------------------------------------------


@query
def rule1_keys(spark, sf_dir):
    return I.rule1_keys(_staged(spark, sf_dir)).select("sub_id", "canonical_key")


@query
def rule2_keys(spark, sf_dir):
    return I.rule2_keys(_staging_table(spark, sf_dir)).select("sub_id", "canonical_key", "match_rule")


@query
def identity_resolution(spark, sf_dir):
    return _public(I.resolve_identity(_staging_table(spark, sf_dir)))


@query
def identity_all_dates(spark, sf_dir):
    """Rule-2 candidates looked up over all load dates at once."""
    return _public(I.resolve_identity(_staging_table(spark, sf_dir), scope="all"))


@query
def identity_route_conflicts(spark, sf_dir):
    dim = I.resolve_identity(_staging_table(spark, sf_dir), mode="route")
    return I.unresolved_rows(dim).select("sub_id", "donor_id", "conflict_reason")


@query
def identity_zero_zip_null(spark, sf_dir):
    dim = I.resolve_identity(_staging_table(spark, sf_dir), zero_zip_is_null=True)
    return dim.select("sub_id", "donor_id", "match_rule")


@query
def dim_upsert(spark, sf_dir):
    """Donor dimension, then the amended filings resolved as a batch of their own and upserted."""
    dim = I.resolve_identity(_staging_table(spark, sf_dir))
    resent = I.resolve_identity(_stored(_staging(_amended(spark, sf_dir)), "resent"))
    return _public(U.merge_rows(dim, resent))


@query
def identity_tables(spark, sf_dir):
    """Route mode through stored tables: rows of the dimension, conflicts, and rows of the review table, by day."""
    root = scratch_path(spark, "identity")
    dim_path, review_path = f"{root}/dim_donors", f"{root}/unresolved"
    R.run_identity(spark, _staging_table(spark, sf_dir), dim_path, review_path, mode="route")
    dim = tb.read_table(spark, dim_path, DIM_DONORS)
    review = tb.read_table(spark, review_path, R.UNRESOLVED)
    flags = dim.select(LOAD_DATE, F.col("identity_conflict").cast("bigint").alias("flag"), F.lit(1).alias("row"))
    reviewed = review.select(LOAD_DATE, F.lit(0).cast("bigint").alias("flag"), F.lit(0).alias("row"))
    tagged = flags.withColumn("review", F.lit(0)).unionByName(reviewed.withColumn("review", F.lit(1)))
    return _public(
        tagged.groupBy(LOAD_DATE).agg(
            F.sum("row").alias("dim_rows"), F.sum("flag").alias("conflicts"), F.sum("review").alias("review_rows")
        )
    )


@query
def identity_rebuild(spark, sf_dir):
    """Dimension filled day by day, then rebuilt over all dates at once, and published as one new state."""
    root = scratch_path(spark, "rebuild")
    tables = (f"{root}/dim_donors", f"{root}/unresolved")
    staged = _staging_table(spark, sf_dir)
    R.run_identity(spark, staged, *tables, mode="route")
    R.rebuild_identity(spark, staged, *tables, scope="all")
    return _public(tb.read_table(spark, tables[0], DIM_DONORS))


@query
def day_resent(spark, sf_dir):
    """All days staged and resolved, then the second day sent again without its amended filings: those are withdrawn."""
    raw, path = _write_raw(spark, sf_dir)
    w = R.Warehouse(scratch_path(spark, "resent"))
    tb.ensure_table(spark, w.staging, STAGING)
    U.upsert_table(spark, w.staging, STAGING, S.build_staging(tb.read_table(spark, path, RAW)))
    R.run_identity(spark, tb.read_table(spark, w.staging, STAGING), w.dim_donors, w.unresolved)
    day = raw.where((F.col(LOAD_DATE) == F.lit(DAYS[1])) & (F.col("AMNDT_IND") != "A"))
    R.ingest_raw(spark, S.select_source_columns(day), DAYS[1], path)
    R.run_staging(spark, path, w.staging, DAYS[1])
    R.run_identity(spark, tb.read_partition(spark, w.staging, STAGING, DAYS[1]), w.dim_donors, w.unresolved, day=DAYS[1])
    return _public(tb.read_table(spark, w.dim_donors, DIM_DONORS))


@query
def daily_run(spark, sf_dir):
    """The whole ordered run for each day, with its checks, on one warehouse: the entries of the run log."""
    w = R.Warehouse(scratch_path(spark, "warehouse"))
    raw = _stored(S.enforce_raw_schema(_raw(spark, sf_dir)), "records")
    limits = Q.Limits(null_rates={"NAME": 0.0, "TRANSACTION_AMT": 0.0, "TRANSACTION_DT": 0.0, "SUB_ID": 0.0, "ZIP_CODE": 20.0})
    for day in DAYS:
        source = S.select_source_columns(raw.where(F.col(LOAD_DATE) == F.lit(day)))
        R.run_day(spark, source, day, w, R.Options(as_of=AS_OF, limits=limits))
    return read_run_log(spark, w.run_log).drop("run_id", "timestamp")


@query
def fixture_identity(spark, sf_dir):
    """Identity on a scenario file: the staged records written as one, read back and resolved."""
    path = scratch_path(spark, "scenario")
    columns = ["donor_name_normalized", "donor_address_normalized", "zip_normalized"]
    scenario = _staged(spark, sf_dir).select(F.col("sub_id").alias("record_id"), *columns)
    D.write_delimited(scenario, path, sep=",")
    dim = I.resolve_identity(D.read_identity_fixture(spark, path, DAYS[0]))
    return dim.select("sub_id", "donor_id", "match_rule")


@query
def match_rule_distribution(spark, sf_dir):
    return I.match_rule_distribution(I.resolve_identity(_staging_table(spark, sf_dir)))


@query
def donor_lookup(spark, sf_dir):
    return I.find_donor(I.resolve_identity(_staging_table(spark, sf_dir)), LOOKUP_ID, DAYS[0])


# --- profile ---------------------------------------------------------------------------------------------------


@query
def null_profile(spark, sf_dir):
    return P.null_profile(_raw(spark, sf_dir)).drop("position")


@query
def top_null_columns(spark, sf_dir):
    return P.top_null_columns(_raw(spark, sf_dir)).drop("position")


@query
def key_population(spark, sf_dir):
    return P.key_population(_raw(spark, sf_dir))


@query
def key_population_partial(spark, sf_dir):
    """The verdict on a column that is populated for two thirds of the records."""
    return P.key_population(_raw(spark, sf_dir), "OTHER_ID")


@query
def duplicate_profile(spark, sf_dir):
    return P.duplicate_profile(_raw(spark, sf_dir))


@query
def duplicate_examples(spark, sf_dir):
    return P.duplicate_examples(_raw(spark, sf_dir))


@query
def blank_zip_rate(spark, sf_dir):
    return P.blank_zip_rate(_staged(spark, sf_dir))


# --- mart ------------------------------------------------------------------------------------------------------


def _summary(spark, sf_dir) -> DataFrame:
    staged = _staging_table(spark, sf_dir)
    return M.donor_summary(staged, I.resolve_identity(staged, scope="all"), MONEY)


@query
def donor_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query
def engagement_score(spark, sf_dir):
    return M.add_scores(_summary(spark, sf_dir), AS_OF).select(
        "donor_id", "days_since_last", "recency_score", "frequency_score", "monetary_score", "engagement_score"
    )


@query
def lapsed_donors(spark, sf_dir):
    lapsed = M.lapsed_donors(_summary(spark, sf_dir), AS_OF)
    return lapsed.select("donor_id", "total_amount", "last_contribution_date")


# --- quality, run log ------------------------------------------------------------------------------------------


@query
def quality_report(spark, sf_dir):
    raw, limits = _raw(spark, sf_dir), Q.Limits()
    staged = _staging_table(spark, sf_dir)
    dim = _stored(I.resolve_identity(staged, scope="all"), "dim")
    mart = _stored(M.build_mart(staged, dim, AS_OF), "mart", partitioned=False)
    return Q.combine(
        Q.raw_report(raw, limits),
        Q.staging_report(staged, limits),
        Q.not_more_rows_report(staged, raw, "staging_not_more_than_raw"),
        Q.identity_report(dim, limits),
        Q.key_audit(staged, dim, "sub_id", "staging_unique_sub_id", "identity_unique_sub_id", "identity_covers_staging"),
        R.mart_gate(mart, limits),
        *[Q.schema_report(df, schema, f"{name}_schema") for name, df, schema in (
            ("raw", raw.withColumn("TRANSACTION_AMT", F.col("TRANSACTION_AMT").cast(AMOUNT)), RAW), ("staging", staged, STAGING),
            ("identity", dim, DIM_DONORS), ("mart", mart, MART))],
    )


@query
def table_fingerprint(spark, sf_dir):
    return Q.fingerprint(_staged(spark, sf_dir), portable=True)


@query
def run_log(spark, sf_dir):
    """Staging of each day logged with its row counts; the log read back without its clock."""
    path = scratch_path(spark, "run-log")
    raw = _raw(spark, sf_dir)
    kept = F.count_if(F.col("ENTITY_TP") == S.INDIVIDUAL)
    counts = raw.groupBy(LOAD_DATE).agg(F.count("*").alias("rows_in"), kept.alias("rows_out"))
    for row in counts.collect():  # one row per load date
        log_task(spark, path, f"run-{row[LOAD_DATE]}", row[LOAD_DATE], R.STAGE, row["rows_in"], row["rows_out"])
    return read_run_log(spark, path).drop("timestamp")

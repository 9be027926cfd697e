"""The jobs behind the tables, and the ordered run that stops at the first failed check."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.identity import resolve_identity, unresolved_rows
from ..operators.mart import ScoreRules, build_mart
from ..operators.staging import add_load_date, build_staging, keep_unknown_columns, unknown_columns
from ..operators.upsert import UpsertResult, upsert_table
from ..schemas import DIM_DONORS, LOAD_DATE, MART, RAW, RAW_STORED, RECORD_ID, STAGING, UNRESOLVED
from ..sources import tables as tb
from ..sources import versions as V
from ..sources.delimited import good_rows, read_headerless, read_identity_fixture, read_with_header, require_well_formed
from .runlog import FAIL, RunLog

INGEST, STAGE, IDENTITY, BUILD_MART = "ingest_raw", "build_staging", "build_identity_layer", "build_mart"
CHECK_RAW, CHECK_STAGING, CHECK_IDENTITY, CHECK_MART = (
    "check_raw",
    "check_staging",
    "check_identity",
    "check_mart",
)


@dataclass(frozen=True)
class Warehouse:
    """Where the tables live: one folder per layer under a root."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self._at("raw/contributions")

    @property
    def staging(self) -> str:
        return self._at("staging/stg_contributions")

    @property
    def dim_donors(self) -> str:
        return self._at("core/dim_donors")

    @property
    def unresolved(self) -> str:
        return self._at("core/dim_donors_unresolved")

    @property
    def mart(self) -> str:
        return self._at("marts/mart_donor_summary")

    @property
    def run_log(self) -> str:
        return self._at("metadata/pipeline_run_log")


@dataclass(frozen=True)
class Options:
    """Choices of one run. The defaults match the plain behaviour; see the functions they go to."""

    as_of: date | None = None  # day the scores refer to; the execution date when not given
    conflict_mode: str = "inherit_min"
    zero_zip_is_null: bool = False
    scope: str = "date"
    lenient_dates: bool = False
    keep: int = V.KEEP  # states of each table that a finished run leaves for readers
    limits: Q.Limits = field(default_factory=Q.Limits)
    rules: ScoreRules = field(default_factory=ScoreRules)


def read_source(
    spark: SparkSession, path: str, header: bool = True, header_path: str | None = None, on_malformed: str = "fail"
) -> DataFrame:
    """Source records as strings. ``on_malformed``: "fail" stops at a bad line, "skip" leaves bad lines out."""
    rows = read_with_header(spark, path) if header else read_headerless(spark, path, header_path)
    return require_well_formed(rows) if on_malformed == "fail" else good_rows(rows)


@dataclass(frozen=True)
class Reconciled:
    rows_in: int
    rows_in_table: int

    @property
    def matches(self) -> bool:
        return self.rows_in == self.rows_in_table


def ingest_raw(spark: SparkSession, source: DataFrame, execution_date: date, table: str) -> Reconciled:
    """Make the source records the whole content of the day's raw partition, and count it back.

    Columns we do not know are kept in one map column, and the table's record says which days have them.
    """
    tb.ensure_table(spark, table, RAW_STORED)
    kept = keep_unknown_columns(add_load_date(source, execution_date))
    rows = tb.overwrite_partition(kept, table, execution_date, unknown_columns(source), by=RECORD_ID)
    stored = tb.partition_row_count(tb.read_table(spark, table, RAW), execution_date).first()["row_count"]
    result = Reconciled(rows, stored)
    if not result.matches:
        raise Q.GateFailed(INGEST, [f"wrote {rows} rows but the partition has {stored}"])
    return result


def run_staging(
    spark: SparkSession, raw_table: str, table: str, execution_date: date, lenient_dates: bool = False
) -> UpsertResult:
    """Stage the raw records of one day; staged records of that day that were not sent again are withdrawn."""
    tb.ensure_table(spark, table, STAGING)
    raw = tb.read_partition(spark, raw_table, RAW, execution_date)
    return upsert_table(spark, table, STAGING, build_staging(raw, lenient_dates), day=execution_date)


def run_identity(
    spark: SparkSession,
    staged: DataFrame,
    dim_table: str,
    unresolved_table: str,
    mode: str = "inherit_min",
    zero_zip_is_null: bool = False,
    scope: str = "date",
    day: date | None = None,
) -> UpsertResult:
    """Resolve the staged rows (of one load date or of many) and upsert them into the donor dimension.

    ``day``: the staged rows are all there is of that load date, so its other records leave the dimension. In route mode the records with several candidate donors also show up in the review table.
    """
    tb.ensure_table(spark, dim_table, DIM_DONORS)
    tb.ensure_table(spark, unresolved_table, UNRESOLVED)
    result = upsert_table(spark, dim_table, DIM_DONORS, resolve_identity(staged, mode, zero_zip_is_null, scope), day=day)
    if result.load_dates:
        # The review table mirrors the flagged rows of the dimension, for every load date the upsert concerned.
        touched = tb.read_table(spark, dim_table, DIM_DONORS).where(F.col(LOAD_DATE).isin(*result.load_dates))
        flagged = unresolved_rows(touched)
        tb.replace_partitions(flagged, unresolved_table, result.load_dates, dates=len(result.load_dates), by="sub_id")
    return result


def rebuild_identity(spark: SparkSession, staged: DataFrame, dim_table: str, unresolved_table: str, **choices) -> int:
    """Resolve everything again and replace the whole dimension and review table, load dates that have gone included."""
    tb.ensure_table(spark, dim_table, DIM_DONORS)
    tb.ensure_table(spark, unresolved_table, UNRESOLVED)
    # The dates the dimension has so far: there may be others now, which costs no more than a few files.
    spread = {"dates": len(tb.load_dates(spark, dim_table)) or None, "by": "sub_id"}
    rows = tb.replace_partitions(resolve_identity(staged, **choices), dim_table, emptied=None, **spread)
    flagged = unresolved_rows(tb.read_table(spark, dim_table, DIM_DONORS))
    tb.replace_partitions(flagged, unresolved_table, emptied=None, **spread)
    return rows


def rebuild(spark: SparkSession, warehouse: Warehouse, as_of: date, rules: ScoreRules = ScoreRules(), **choices) -> str:
    """Dimension, review table and mart from all staged rows, each published whole; the mart after its check.

    Returns the version of the mart. Old states stay for readers until a run sweeps them.
    """
    staged, version = tb.read_table(spark, warehouse.staging, STAGING), V.new_version()
    rebuild_identity(spark, staged, warehouse.dim_donors, warehouse.unresolved, **choices)
    rows = build_mart(staged, tb.read_table(spark, warehouse.dim_donors, DIM_DONORS), as_of, rules)
    mart = spark.read.schema(MART).parquet(tb.write_snapshot(rows, warehouse.mart, version))
    Q.enforce(CHECK_MART, mart_gate(mart, Q.Limits()))
    tb.publish_snapshot(spark, warehouse.mart, version)
    return version


def run_fixture_identity(spark: SparkSession, path: str, execution_date: date, dim_table: str, unresolved_table: str):
    """Identity on a scenario file, into tables of its own."""
    staged = read_identity_fixture(spark, path, execution_date)
    return run_identity(spark, staged, dim_table, unresolved_table)


def staging_gate(raw: DataFrame, staged: DataFrame, limits: Q.Limits) -> DataFrame:
    return Q.combine(
        Q.staging_report(staged, limits),
        Q.unique_key_report(staged, ["sub_id"], "staging_unique_sub_id"),
        Q.not_more_rows_report(staged, raw, "staging_not_more_than_raw"),
    )


def identity_gate(staged: DataFrame, dim: DataFrame, limits: Q.Limits) -> DataFrame:
    return Q.combine(
        Q.identity_report(dim, limits),
        Q.key_audit(staged, dim, "sub_id", None, "identity_unique_sub_id", "identity_covers_staging"),
    )


def mart_gate(mart: DataFrame, limits: Q.Limits) -> DataFrame:
    return Q.combine(Q.mart_report(mart, limits), Q.unique_key_report(mart, ["donor_id"], "mart_unique_donor_id"))


def run_day(
    spark: SparkSession, source: DataFrame, execution_date: date, warehouse: Warehouse, options: Options = Options()
) -> str:
    """Ingest, check, stage, check, identify, check, build the mart, check, publish. Returns the run id.

    Every step is logged, in one job at the end of the run. The first failed check is logged as FAIL and raised; nothing after it runs, and readers
    keep the mart of the last good run, because a new one is published only after its check. Safe to repeat for the
    same date; a backfill is the same call with an older date.
    """
    log = RunLog(spark, warehouse.run_log, uuid.uuid4().hex, execution_date)
    try:
        _run_steps(spark, source, execution_date, warehouse, options, log)
    finally:
        log.write()
    for table in (warehouse.raw, warehouse.staging, warehouse.dim_donors, warehouse.unresolved, warehouse.mart):
        V.sweep(spark, table, options.keep)
    return log.run_id


def _run_steps(
    spark: SparkSession, source: DataFrame, execution_date: date, warehouse: Warehouse, options: Options, log: RunLog
) -> None:
    limits = options.limits

    def step(task: str, action):
        """Run one job; log what went in and out, or that it failed."""
        try:
            rows_in, rows_out = action()
        except Exception:
            log.add(task, 0, 0, FAIL)
            raise
        log.add(task, rows_in, rows_out)
        return rows_out

    def gate(task: str, rows: int, df: DataFrame, schema, report: DataFrame) -> None:
        try:
            Q.require_schema(task, df, schema)
            Q.enforce(task, report)
        except Exception:
            log.add(task, rows, 0, FAIL)
            raise
        log.add(task, rows, rows)

    def ingest():
        counted = ingest_raw(spark, source, execution_date, warehouse.raw)
        return counted.rows_in, counted.rows_in_table

    raw_rows = step(INGEST, ingest)
    raw = tb.read_partition(spark, warehouse.raw, RAW, execution_date)
    gate(CHECK_RAW, raw_rows, raw, RAW, Q.raw_report(raw, limits))

    def stage():
        done = run_staging(spark, warehouse.raw, warehouse.staging, execution_date, options.lenient_dates)
        return raw_rows, done.rows_in

    staged_rows = step(STAGE, stage)
    staged = tb.read_partition(spark, warehouse.staging, STAGING, execution_date)
    gate(CHECK_STAGING, staged_rows, staged, STAGING, staging_gate(raw, staged, limits))

    all_staged = tb.read_table(spark, warehouse.staging, STAGING)
    to_resolve = all_staged if options.scope == "all" else staged

    def identify():
        done = run_identity(
            spark,
            to_resolve,
            warehouse.dim_donors,
            warehouse.unresolved,
            options.conflict_mode,
            options.zero_zip_is_null,
            options.scope,
            execution_date,
        )
        return staged_rows, done.rows_in

    resolved_rows = step(IDENTITY, identify)
    dim = tb.read_partition(spark, warehouse.dim_donors, DIM_DONORS, execution_date)
    gate(CHECK_IDENTITY, resolved_rows, dim, DIM_DONORS, identity_gate(staged, dim, limits))

    def mart_job():
        rows = build_mart(
            all_staged,
            tb.read_table(spark, warehouse.dim_donors, DIM_DONORS),
            options.as_of or execution_date,
            options.rules,
        )
        path = tb.write_snapshot(rows, warehouse.mart, log.run_id)
        return resolved_rows, spark.read.schema(MART).parquet(path).count()

    mart_rows = step(BUILD_MART, mart_job)
    mart = spark.read.schema(MART).parquet(tb.snapshot_path(warehouse.mart, log.run_id))
    gate(CHECK_MART, mart_rows, mart, MART, mart_gate(mart, limits))
    tb.publish_snapshot(spark, warehouse.mart, log.run_id)

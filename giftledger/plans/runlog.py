"""Append-only run log."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RUN_LOG
from ..sources.tables import append_rows, read_rows
from ..sources.workspace import delete_path, materialized

PASS, FAIL = "PASS", "FAIL"


def log_task(
    spark: SparkSession,
    path: str,
    run_id: str,
    execution_date: date,
    task_name: str,
    rows_in: int,
    rows_out: int,
    status: str = PASS,
    at: datetime | None = None,
) -> None:
    """Add one entry; entries are never changed, so a rerun adds its own."""
    at = at or datetime.now(timezone.utc)
    entry = (run_id, execution_date, task_name, rows_in, rows_out, status, at)
    append_rows(spark.createDataFrame([entry], RUN_LOG).coalesce(1), path)


class RunLog:
    """Entries of one run, gathered while it goes and added to the log in one job: one file for each run."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, execution_date: date):
        self.spark, self.path, self.run_id, self.execution_date = spark, path, run_id, execution_date
        self.entries: list[tuple] = []

    def add(self, task_name: str, rows_in: int, rows_out: int, status: str = PASS) -> None:
        at = datetime.now(timezone.utc)
        self.entries.append((self.run_id, self.execution_date, task_name, rows_in, rows_out, status, at))

    def write(self) -> None:
        if self.entries:
            append_rows(self.spark.createDataFrame(self.entries, RUN_LOG).coalesce(1), self.path)
            self.entries = []


def compact_run_log(spark: SparkSession, path: str) -> None:
    """Bring the files of the log together in one; the entries stay as they are.

    The entries are written beside the log first; then the new file goes in before the old ones are deleted. A crash in
    between leaves entries twice, which `read_run_log` shows once.
    """
    log = spark.read.schema(RUN_LOG).parquet(path)
    old = log.inputFiles()
    if len(old) < 2:
        return
    with materialized(log.distinct().coalesce(1), "run-log") as entries:
        append_rows(entries.coalesce(1), path)
    for file in old:
        delete_path(spark, file)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, RUN_LOG).distinct()

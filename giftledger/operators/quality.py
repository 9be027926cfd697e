"""Data-quality gates.

A report has one row per check: ``check_name``, ``metric`` (a count or a percentage) and ``passed``. Checks on the
rows of one table are aggregates of a single scan; uniqueness and coverage of keys add one grouping for each side
(`key_audit`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_blank, percent
from ..schemas import ALLOWED_TYPES, LOAD_DATE, SOURCE_COLUMNS
from .staging import INDIVIDUAL
from .upsert import key_violations


class GateFailed(RuntimeError):
    """A check did not pass; carries the names of the failed checks."""

    def __init__(self, stage: str, failed: Sequence[str]):
        super().__init__(f"{stage}: {', '.join(failed)}")
        self.stage = stage
        self.failed = tuple(failed)


@dataclass(frozen=True)
class Limits:
    """Thresholds of the gates. Null rates are percentages of all rows, by raw column."""

    min_rows: int = 1
    max_rows: int | None = None
    null_rates: Mapping[str, float] = field(
        default_factory=lambda: {
            "NAME": 0.0, "TRANSACTION_AMT": 0.0, "TRANSACTION_DT": 0.0, "SUB_ID": 0.0, "ZIP_CODE": 1.0,
        }
    )


@dataclass(frozen=True)
class Check:
    name: str
    metric: Column
    passed: Column


def _zero(name: str, violations: Column) -> Check:
    return Check(name, violations, violations == 0)


def _report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate aggregate checks in one pass and lay them out one per row."""
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"), c.metric.cast("double").alias("metric"), c.passed.alias("passed")
        )
        for c in checks
    ]
    return df.agg(F.array(*rows).alias("checks")).select(F.inline("checks"))


def _row_count(prefix: str, limits: Limits) -> Check:
    rows = F.count("*")
    within = rows >= limits.min_rows
    return Check(f"{prefix}_row_count", rows, within if limits.max_rows is None else within & (rows < limits.max_rows))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def raw_report(raw: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Row count, blank rates of critical fields, empty rows, and one load date per batch."""
    all_blank = reduce(lambda a, b: a & b, [is_blank(_text(c)) for c in SOURCE_COLUMNS])
    rates = [(c, percent(F.count_if(is_blank(_text(c))), F.count("*"))) for c in limits.null_rates]
    no_date = F.count_if(F.col(LOAD_DATE).isNull())
    several_dates = F.when(F.min(LOAD_DATE) != F.max(LOAD_DATE), 1).otherwise(0)
    return _report(
        raw,
        [
            _row_count("raw", limits),
            *[Check(f"raw_null_rate_{c}", rate, rate <= limits.null_rates[c]) for c, rate in rates],
            _zero("raw_empty_rows", F.count_if(all_blank)),
            _zero("raw_null_load_date", no_date),
            _zero("raw_single_load_date", several_dates),
        ],
    )


def unique_key_report(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with a null key plus keys that occur more than once."""
    violations = F.sum(F.col("null_keys") + F.col("repeated_keys"))
    return _report(key_violations(df, keys), [_zero(name, violations)])


def staging_report(staged: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Shape of the normalized columns, entity filter, load date."""
    name, address, zip_code = (
        F.col(c) for c in ("donor_name_normalized", "donor_address_normalized", "zip_normalized")
    )
    length = F.length(zip_code)
    # Any character but a-z, 0-9 and space, as ranges; Java matches the negated class several times slower.
    not_name = name.rlike(r"[\x00-\x1f!-/:-`{-\x{10FFFF}]")
    loose_spaces = name.contains("  ") | name.startswith(" ") | name.endswith(" ")
    return _report(
        staged,
        [
            _row_count("staging", limits),
            _zero("staging_zip_shape", F.count_if(zip_code.isNull() | ~length.isin(0, 5))),
            _zero("staging_name_shape", F.count_if(name.isNull() | not_name | loose_spaces)),
            _zero("staging_address_shape", F.count_if(address.isNull() | address.rlike("[A-Z,.]"))),
            _zero("staging_only_individuals", F.count_if(~F.col("entity_type").eqNullSafe(INDIVIDUAL))),
            _zero("staging_null_load_date", F.count_if(F.col(LOAD_DATE).isNull())),
            # Reported, not limited: every donor without a name in one ZIP shares one identity.
            Check("staging_blank_names", F.count_if(name == ""), F.lit(True)),
        ],
    )


def not_more_rows_report(smaller: DataFrame, larger: DataFrame, name: str) -> DataFrame:
    """``smaller`` has at most as many rows as ``larger``; the metric is the excess."""
    counts = (
        smaller.select(F.lit(1).alias("sign"))
        .unionByName(larger.select(F.lit(-1).alias("sign")))
        .agg(F.coalesce(F.sum("sign"), F.lit(0)).alias("difference"))
    )
    return _report(counts, [_zero(name, F.sum(F.greatest("difference", F.lit(0))))])


def coverage_report(source: DataFrame, target: DataFrame, key: str, name: str) -> DataFrame:
    """Every source key is in the target; the metric counts the missing ones."""
    missing = source.select(key).join(target.select(key), key, "left_anti")
    return _report(missing, [_zero(name, F.count("*"))])


def key_audit(source: DataFrame, target: DataFrame, key: str, unique_source: str | None, unique_target: str, covered: str) -> DataFrame:
    """Uniqueness of a key on both sides and coverage of the source, from one full join of the grouped sides.

    Each side is shuffled once, already counted by key on the map side, and the join uses the same partitioning. The
    metrics are those of `unique_key_report` and `coverage_report`.
    """
    sides = [df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((source, "sent"), (target, "held"))]
    both = sides[0].join(sides[1], key, "full")

    def violations(n: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col(n)).otherwise((F.col(n) > 1).cast("int"))), F.lit(0))

    missing = F.coalesce(F.sum(F.when(F.col("held").isNull(), F.col("sent"))), F.lit(0))
    checks = [_zero(unique_target, violations("held")), _zero(covered, missing)]
    return _report(both, ([_zero(unique_source, violations("sent"))] if unique_source else []) + checks)


def schema_report(df: DataFrame, expected: T.StructType, name: str) -> DataFrame:
    """Number of schema problems (missing, repeated, unexpected, wrongly typed columns) as a check."""
    problems = F.lit(len(schema_problems(df.schema, expected)))
    return df.sparkSession.range(1).select(
        F.lit(name).alias("check_name"), problems.cast("double").alias("metric"), (problems == 0).alias("passed")
    )


def identity_report(dim: DataFrame, limits: Limits = Limits()) -> DataFrame:
    rules = F.coalesce(F.col("match_rule").isin("rule1", "rule2", "no_match"), F.lit(False))
    return _report(
        dim,
        [
            _row_count("identity", limits),
            _zero("identity_null_donor_id", F.count_if(F.col("donor_id").isNull())),
            _zero("identity_unknown_rule", F.count_if(~rules)),
        ],
    )


def mart_report(mart: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return _report(
        mart,
        [
            _row_count("mart", limits),
            _zero("mart_score_range", F.count_if(~F.coalesce(F.col("engagement_score").between(1, 5), F.lit(False)))),
            _zero("mart_no_gifts", F.count_if(F.coalesce(F.col("contribution_count"), F.lit(0)) < 1)),
        ],
    )


def combine(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def schema_problems(actual: T.StructType, expected: T.StructType, exact: bool = True) -> list[str]:
    """Missing, repeated, unexpected or wrongly typed columns; types outside the allowed set. Empty when all is well.

    Nullability is not compared: files do not keep it, so required columns are checked by value instead.
    """
    names = [f.name for f in actual.fields]
    types = {f.name: f.dataType for f in actual.fields}
    problems = [f"repeated column {n}" for n in sorted({n for n in names if names.count(n) > 1})]
    for f in expected.fields:
        if f.name not in types:
            problems.append(f"missing column {f.name}")
        elif types[f.name] != f.dataType:
            problems.append(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if exact:
        problems += [f"unexpected column {n}" for n in names if n not in expected.fieldNames()]
    problems += [f"type of {n} is not allowed" for n, t in types.items() if not isinstance(t, ALLOWED_TYPES)]
    return problems


def require_schema(stage: str, df: DataFrame, expected: T.StructType) -> None:
    problems = schema_problems(df.schema, expected)
    if problems:
        raise GateFailed(stage, problems)


def failed_checks(report: DataFrame) -> list[str]:
    """Names of the checks that did not pass (a report has a fixed, small number of rows)."""
    return [row["check_name"] for row in report.where(~F.col("passed")).select("check_name").collect()]


def enforce(stage: str, report: DataFrame) -> None:
    failed = failed_checks(report)
    if failed:
        raise GateFailed(stage, failed)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, portable: bool = False) -> DataFrame:
    """Row count and an order-free sum of row hashes; equal contents give equal rows.

    A sum, not an exclusive or, so that pairs of equal rows do not cancel. Nulls are hashed too, and text parts carry
    their length, so a value cannot pass for one of another column. ``portable`` hashes text with MD5, which other
    engines can repeat, and sums both halves of the digest (``hash_sum`` and ``hash_sum_low``); the default is much
    cheaper.
    """
    columns = list(columns or df.columns)
    if portable:
        text = [F.col(c).cast("string") for c in columns]
        parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in text]
        digest = F.md5(F.concat_ws("|", *parts))
        hashes = {"hash_sum": F.conv(F.substring(digest, 1, 16), 16, 10), "hash_sum_low": F.conv(F.substring(digest, 17, 16), 16, 10)}
    else:
        hashes = {"hash_sum": F.xxhash64(*[part for c in columns for part in (F.col(c).isNull(), F.col(c))])}
    number = T.DecimalType(38, 0)
    sums = [F.coalesce(F.sum(h.cast(number)), F.lit(0)).cast(number).alias(name) for name, h in hashes.items()]
    return df.agg(F.count("*").alias("row_count"), *sums)

"""Deterministic donor identity.

Rule 1: a record with a ZIP is keyed by name + ZIP. Rule 2: a record without one takes the key of a Rule-1 record
with the same name and address - the smallest such key when there are several - else name + address, else a key of
its own. The donor id is the MD5 of the key.

How the plan behaves on large, skewed input:

* Rule-1 rows, nearly all of the data, are keyed in place and never shuffled.
* The Rule-2 lookup is aggregated before the join, with hash aggregation on the map side, so a name that a third
  of all rows carry sends one row per map task. All keys of one name differ in the ZIP alone, so it carries the
  smallest (and largest) ZIP instead of whole keys.
* Only the rows without a ZIP are joined. The join key is a struct, which keeps the planner from reusing the
  aggregate's partitioning: each side of the join then has an exchange of its own, the shape in which adaptive
  execution splits a skewed partition. A small lookup is broadcast by Spark, by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DIM_DONORS, LOAD_DATE, UNRESOLVED

NAME = "donor_name_normalized"
ADDRESS = "donor_address_normalized"
ZIP = "zip_normalized"
SLICE = ("sub_id", NAME, ADDRESS, ZIP, LOAD_DATE)

PLACEHOLDER_ZIP = "00000"
CONFLICT_REASON = "rule2_multiple_candidates"
MODES = ("inherit_min", "route")
SCOPES = ("date", "all")


def has_zip(zero_zip_is_null: bool = False) -> Column:
    present = F.col(ZIP).isNotNull() & (F.col(ZIP) != "")
    return present & (F.col(ZIP) != PLACEHOLDER_ZIP) if zero_zip_is_null else present


def no_zip(zero_zip_is_null: bool = False) -> Column:
    """Exact complement of `has_zip`, nulls included."""
    absent = F.col(ZIP).isNull() | (F.col(ZIP) == "")
    return absent | (F.col(ZIP) == PLACEHOLDER_ZIP) if zero_zip_is_null else absent


def _has_address() -> Column:
    return F.col(ADDRESS).isNotNull() & (F.col(ADDRESS) != "")


def _key(tag: str, value: str | Column) -> Column:
    """name|tag:value; null when a part is null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.col(NAME), F.lit(f"|{tag}:"), value)


def rule1_keys(staged: DataFrame, zero_zip_is_null: bool = False) -> DataFrame:
    return staged.select(*SLICE).where(has_zip(zero_zip_is_null)).select(
        *SLICE,
        _key("zip", ZIP).alias("canonical_key"),
        F.lit("rule1").alias("match_rule"),
        F.lit(False).alias("identity_conflict"),
    )


def _scope_columns(scope: str) -> list[str]:
    return [NAME, ADDRESS] if scope == "all" else [LOAD_DATE, NAME, ADDRESS]


def _zip_text(code: Column) -> Column:
    return F.lpad(code.cast("string"), 5, "0")


def rule2_lookup(staged: DataFrame, zero_zip_is_null: bool = False, scope: str = "date") -> DataFrame:
    """Smallest and largest ZIP of the Rule-1 records per name and address (and load date).

    A minimum of strings would make Spark sort every row before aggregating; a minimum of integers is hash-aggregated.
    Five-digit ZIPs go through as integers, which sort the same. A ZIP that is anything else (digits of another
    script, say) becomes part of the grouping, so a key has one row plus one per such ZIP.
    """
    by = _scope_columns(scope)
    code = F.col(ZIP).try_cast("int")
    five_digits = F.coalesce((code >= 0) & (_zip_text(code) == F.col(ZIP)), F.lit(False))
    return (
        staged.where(has_zip(zero_zip_is_null) & _has_address() & F.col(NAME).isNotNull())
        .select(
            *by,
            F.when(five_digits, code).alias("zip_code"),
            F.when(~five_digits, F.col(ZIP)).alias("other_zip"),
        )
        .groupBy(*by, "other_zip")
        .agg(F.min("zip_code").alias("low"), F.max("zip_code").alias("high"))
        .select(
            F.struct(NAME, ADDRESS).alias("lookup_key"),
            *([F.col(LOAD_DATE).alias("lookup_date")] if scope == "date" else []),
            F.coalesce("other_zip", _zip_text(F.col("low"))).alias("first_zip"),
            F.coalesce("other_zip", _zip_text(F.col("high"))).alias("last_zip"),
        )
    )


def rule2_keys(
    staged: DataFrame, mode: str = "inherit_min", zero_zip_is_null: bool = False, scope: str = "date"
) -> DataFrame:
    records = staged.select(*SLICE).where(no_zip(zero_zip_is_null))
    # The load date is a join column of its own, so that a filter on it reaches the scan of the lookup, too.
    same = F.col("record_key") == F.col("lookup_key")
    if scope == "date":
        same = same & (F.col(LOAD_DATE) == F.col("lookup_date"))
    found_zips = (
        records.withColumn("record_key", F.struct(NAME, ADDRESS))
        .join(rule2_lookup(staged, zero_zip_is_null, scope), same, "left")
        # One row per record; identical records collapse to one.
        .groupBy(*SLICE)
        .agg(F.min("first_zip").alias("first_zip"), F.max("last_zip").alias("last_zip"))
    )
    found = F.col("first_zip").isNotNull()
    inherited = F.coalesce(
        _key("zip", "first_zip"), F.when(_has_address(), _key("addr", ADDRESS)).otherwise(_key("id", "sub_id"))
    )
    if mode == "route":
        conflict = found & (F.col("first_zip") != F.col("last_zip"))
        key = F.when(conflict, _key("id", "sub_id")).otherwise(inherited)
    else:
        conflict, key = F.lit(False), inherited
    return found_zips.select(
        *SLICE,
        key.alias("canonical_key"),
        F.when(found | _has_address(), "rule2").otherwise("no_match").alias("match_rule"),
        conflict.alias("identity_conflict"),
    )


def resolve_keys(
    staged: DataFrame, mode: str = "inherit_min", zero_zip_is_null: bool = False, scope: str = "date"
) -> DataFrame:
    """Every staged record with its canonical key, the rule that gave it, and the conflict flag."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    return rule1_keys(staged, zero_zip_is_null).unionByName(rule2_keys(staged, mode, zero_zip_is_null, scope))


def resolve_identity(
    staged: DataFrame, mode: str = "inherit_min", zero_zip_is_null: bool = False, scope: str = "date"
) -> DataFrame:
    """Rows of the donor dimension, one per staged record.

    ``mode="route"`` gives a record with more than one candidate donor a key of its own and flags it (see
    `unresolved_rows`) instead of taking the smallest. ``zero_zip_is_null`` treats the ZIP 00000 as missing.
    ``scope="date"`` looks for Rule-2 candidates within the record's load date, ``"all"`` over all of them; with
    either, any number of load dates goes through in one job.
    """
    keyed = resolve_keys(staged, mode, zero_zip_is_null, scope).withColumn("donor_id", F.md5("canonical_key"))
    return keyed.select(*DIM_DONORS.fieldNames())


def unresolved_rows(dim: DataFrame) -> DataFrame:
    """Flagged rows in the shape of the review table."""
    flagged = dim.where("identity_conflict").withColumn("conflict_reason", F.lit(CONFLICT_REASON))
    return flagged.select(*UNRESOLVED.fieldNames())


def match_rule_counts(dim: DataFrame) -> DataFrame:
    """Records per match rule, largest first."""
    return dim.groupBy("match_rule").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "match_rule")


def match_rule_distribution(dim: DataFrame) -> DataFrame:
    """Records per match rule with their share in percent, largest first."""
    counts = dim.groupBy("match_rule").agg(F.count("*").alias("cnt"))
    # The window sees one row per match rule, never the data.
    total = F.sum("cnt").over(Window.partitionBy())
    share = F.round(F.col("cnt") * F.lit(100.0) / total, 2)
    return counts.select("match_rule", "cnt", share.alias("pct")).orderBy(F.desc("cnt"), "match_rule")


def find_donor(dim: DataFrame, sub_id: str, load_date=None) -> DataFrame:
    """Point lookup; both predicates reach the scan (partition filter and Parquet statistics)."""
    rows = dim.where(F.col("sub_id") == sub_id)
    if load_date is not None:
        rows = rows.where(F.col(LOAD_DATE) == F.lit(load_date))
    return rows.select("sub_id", "donor_id").limit(1)


def donor_id_for(dim: DataFrame, sub_id: str, load_date=None) -> str | None:
    row = find_donor(dim, sub_id, load_date).first()
    return row["donor_id"] if row else None

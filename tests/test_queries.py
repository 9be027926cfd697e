"""Every registered query against its SQL, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from giftledger.plans.oracles import ORACLES  # noqa: E402
from giftledger.plans.queries import QUERIES  # noqa: E402
from tools.check_queries import compare, duckdb_over  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, SF) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["match_rule"] for r in rows] == ["rule1", "rule2", "no_match"]
    assert sum(r["cnt"] for r in rows) == 1350


@pytest.mark.parametrize(
    "folder, rule1, rule2, no_match, conflicts", [("0.001", 381, 63, 6, 0), ("0.01", 3790, 667, 43, 167)]
)
def test_known_counts_of_the_first_day(spark, folder, rule1, rule2, no_match, conflicts):
    from giftledger.operators.identity import match_rule_counts, resolve_identity
    from giftledger.operators.staging import build_staging
    from giftledger.sources.testdata import contribution_records

    staged = build_staging(contribution_records(spark, f"/root/testdata/sf{folder}")).where("_load_date = date'2025-01-01'")
    counts = {r["match_rule"]: r["cnt"] for r in match_rule_counts(resolve_identity(staged)).collect()}
    assert counts == {"rule1": rule1, "rule2": rule2, "no_match": no_match}
    assert resolve_identity(staged, mode="route").where("identity_conflict").count() == conflicts


def test_known_mart_counts(spark):
    from giftledger.plans.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    scored = QUERIES["engagement_score"](spark, sf).groupBy("monetary_score").count().collect()
    assert {r["monetary_score"]: r["count"] for r in scored} == {1: 83, 2: 226, 3: 5, 5: 1311}
    assert QUERIES["lapsed_donors"](spark, sf).count() == 428

from datetime import date

import pytest
from giftledger.operators import quality as Q
from giftledger.operators.staging import add_load_date, build_staging, enforce_raw_schema
from giftledger.schemas import DIM_DONORS, LOAD_DATE, MART, RAW, RUN_LOG, SOURCE_COLUMNS, STAGING, UNRESOLVED
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import DAY, SOURCE_ROWS, source_frame, source_row


def raw_of(spark, rows):
    return enforce_raw_schema(add_load_date(source_frame(spark, rows), DAY))


def metrics(report):
    return {r["check_name"]: (r["metric"], r["passed"]) for r in report.collect()}


def test_schemas_are_well_formed():
    assert len(SOURCE_COLUMNS) == 21 == len(set(SOURCE_COLUMNS))
    assert (len(RAW), len(STAGING), len(DIM_DONORS), len(UNRESOLVED)) == (22, 14, 8, 7)
    assert RAW["TRANSACTION_AMT"].dataType == T.DecimalType(38, 9)
    assert not RAW[LOAD_DATE].nullable and not DIM_DONORS["donor_id"].nullable
    for schema in (RAW, STAGING, DIM_DONORS, UNRESOLVED, MART, RUN_LOG):
        assert Q.schema_problems(schema, schema) == []


def test_schema_problems():
    expected = T.StructType().add("a", "string").add("b", "date")
    actual = T.StructType().add("a", "integer").add("c", "string").add("c", "string").add("d", "binary")
    assert Q.schema_problems(actual, expected) == [
        "repeated column c", "column a is int, not string", "missing column b", "unexpected column c",
        "unexpected column c", "unexpected column d", "type of d is not allowed",
    ]
    assert Q.schema_problems(expected.add("extra", "string"), expected, exact=False) == []


def test_raw_report(spark):
    good = metrics(Q.raw_report(raw_of(spark, SOURCE_ROWS)))
    assert good["raw_row_count"] == (9.0, True) and all(passed for _, passed in good.values())
    rows = [*SOURCE_ROWS, source_row(90, name=" ", zip_code="")]
    bad = metrics(Q.raw_report(raw_of(spark, rows), Q.Limits(min_rows=11)))
    assert bad["raw_row_count"] == (10.0, False)
    assert bad["raw_null_rate_NAME"] == (10.0, False)
    assert bad["raw_null_rate_ZIP_CODE"] == (10.0, False)
    assert bad["raw_null_rate_SUB_ID"] == (0.0, True)
    many = metrics(Q.raw_report(raw_of(spark, rows), Q.Limits(max_rows=10)))
    assert not many["raw_row_count"][1]


def test_empty_rows_and_load_dates(spark):
    raw = raw_of(spark, SOURCE_ROWS)
    blank = raw.limit(1).select(*[(F.lit(" ") if c != "TRANSACTION_AMT" else F.lit(None)).cast(RAW[c].dataType).alias(c) for c in SOURCE_COLUMNS], LOAD_DATE)
    assert metrics(Q.raw_report(raw.unionByName(blank)))["raw_empty_rows"] == (1.0, False)
    assert metrics(Q.raw_report(raw))["raw_single_load_date"] == (0.0, True)
    other = raw.withColumn(LOAD_DATE, F.lit(date(2000, 1, 1)))
    assert not metrics(Q.raw_report(raw.unionByName(other)))["raw_single_load_date"][1]


def test_staging_report(spark):
    staged = build_staging(raw_of(spark, SOURCE_ROWS))
    assert all(passed for _, passed in metrics(Q.staging_report(staged)).values())
    changes = {
        "staging_zip_shape": ("zip_normalized", "123"),
        "staging_name_shape": ("donor_name_normalized", "Smith, john"),
        "staging_address_shape": ("donor_address_normalized", "Atlanta"),
        "staging_only_individuals": ("entity_type", "ORG"),
    }
    for check, (column, value) in changes.items():
        got = metrics(Q.staging_report(staged.withColumn(column, F.lit(value))))
        assert [name for name, (_, passed) in got.items() if not passed] == [check]
        assert got[check][0] == 8.0
    for name in ("a b", "0 z", ""):
        good = metrics(Q.staging_report(staged.withColumn("donor_name_normalized", F.lit(name))))
        assert good["staging_name_shape"] == (0.0, True)
    for name in ("a,b", "a  b", " a", "a ", "A", "a-b", "a\tb", "é", "a`", "a{"):
        bad = metrics(Q.staging_report(staged.withColumn("donor_name_normalized", F.lit(name))))
        assert bad["staging_name_shape"] == (8.0, False)
    blank = metrics(Q.staging_report(staged.withColumn("donor_name_normalized", F.lit(""))))
    assert blank["staging_blank_names"] == (8.0, True)


def test_key_count_and_coverage_reports(spark):
    a = spark.createDataFrame([("1",), ("1",), (None,), ("2",)], "k string")
    b = spark.createDataFrame([("1",)], "k string")
    assert metrics(Q.unique_key_report(a, ["k"], "u")) == {"u": (2.0, False)}
    assert metrics(Q.unique_key_report(b, ["k"], "u")) == {"u": (0.0, True)}
    assert metrics(Q.unique_key_report(b.where("false"), ["k"], "u")) == {"u": (0.0, True)}
    assert metrics(Q.coverage_report(a, b, "k", "c")) == {"c": (2.0, False)}
    assert metrics(Q.coverage_report(b, a, "k", "c")) == {"c": (0.0, True)}
    assert metrics(Q.not_more_rows_report(b, a, "n")) == {"n": (0.0, True)}
    assert metrics(Q.not_more_rows_report(a, b, "n")) == {"n": (3.0, False)}


def test_identity_and_mart_reports(spark):
    dim = spark.createDataFrame([(None, "rule1"), ("d", "rule9")], "donor_id string, match_rule string")
    got = metrics(Q.identity_report(dim))
    assert not got["identity_null_donor_id"][1] and not got["identity_unknown_rule"][1]
    mart = spark.createDataFrame([("d", 0, 7)], "donor_id string, contribution_count bigint, engagement_score int")
    got = metrics(Q.mart_report(mart))
    assert not got["mart_no_gifts"][1] and not got["mart_score_range"][1]


def test_enforce(spark):
    report = spark.createDataFrame([("a", 0.0, True), ("b", 1.0, False)], "check_name string, metric double, passed boolean")
    with pytest.raises(Q.GateFailed, match="stage: b") as error:
        Q.enforce("stage", report)
    assert error.value.failed == ("b",)
    Q.enforce("stage", report.where("passed"))


@pytest.mark.parametrize("portable", [False, True])
def test_fingerprint(spark, portable):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "n int, s string")
    base = Q.fingerprint(df, portable=portable).first()
    assert Q.fingerprint(df.orderBy(F.desc("n")).repartition(3), portable=portable).first() == base
    assert Q.fingerprint(df.where("n = 1"), portable=portable).first() != base
    assert Q.fingerprint(df.fillna("x"), portable=portable).first() != base
    pairs = [[(None, "x")], [("x", None)], [("a|b", "c")], [("a", "b|c")], [("N", "x")], [("", "x")]]
    prints = [Q.fingerprint(spark.createDataFrame(p, "a string, b string"), portable=portable).first() for p in pairs]
    assert len(set(prints)) == len(pairs)


def test_key_audit_equals_the_single_reports(spark):
    def keys(*ids):
        return spark.createDataFrame([(i,) for i in ids], "sub_id string")

    for source, target in (
        (keys("a", "b", "b", None, "z", "z"), keys("a", "b", "c", "c", None, None)), (keys(), keys("a", "a")), (keys("a", "a"), keys()), (keys(), keys()),
    ):
        audit = Q.key_audit(source, target, "sub_id", "s", "t", "c").collect()
        single = [
            *Q.unique_key_report(source, ["sub_id"], "s").collect(), *Q.unique_key_report(target, ["sub_id"], "t").collect(),
            *Q.coverage_report(source, target, "sub_id", "c").collect(),
        ]
        assert [(r["check_name"], r["metric"] or 0.0) for r in audit] == [(r["check_name"], r["metric"] or 0.0) for r in single]


def test_schema_report(spark):
    df = spark.createDataFrame([], STAGING)
    assert tuple(Q.schema_report(df, STAGING, "x").first()) == ("x", 0.0, True)
    assert tuple(Q.schema_report(df.drop("sub_id").withColumn("more", Q.F.lit(1)), STAGING, "x").first()) == ("x", 2.0, False)

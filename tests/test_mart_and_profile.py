from datetime import date, timedelta
from decimal import Decimal

import pytest
from giftledger.operators import mart as M
from giftledger.operators import profile as P
from giftledger.operators import staging as S
from giftledger.operators.quality import schema_problems
from giftledger.schemas import MART, STAGING
from giftledger.sources import delimited as D
from pyspark.sql import functions as F
from samples import SOURCE_ROWS, source_frame

AS_OF = date(2025, 6, 30)


def scores(spark, rows):
    schema = "donor_id string, contribution_count bigint, total_amount decimal(18,2), last_contribution_date date"
    return M.add_scores(spark.createDataFrame(rows, schema), AS_OF).orderBy("donor_id").collect()


def test_score_edges(spark):
    days = [0, 90, 91, 180, 181, 365, 366, 730, 731, None]
    gifts = [1, 2, 3, 5, 6, 10, 11, 100, 1, 1]
    totals = ["99.99", "100", "499.99", "500", "999.99", "1000", "4999.99", "5000", "-5", None]
    rows = [
        (f"{i:02d}", g, t and Decimal(t), None if d is None else AS_OF - timedelta(days=d))
        for i, (d, g, t) in enumerate(zip(days, gifts, totals))
    ]
    got = scores(spark, rows)
    assert [r["days_since_last"] for r in got] == days
    assert [r["recency_score"] for r in got] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert [r["frequency_score"] for r in got] == [1, 2, 3, 3, 4, 4, 5, 5, 1, 1]
    assert [r["monetary_score"] for r in got] == [1, 2, 2, 3, 3, 4, 4, 5, 1, 1]
    assert got[0]["engagement_score"] == Decimal("2.60") and got[9]["engagement_score"] == Decimal("1.00")


def test_mart_from_staging_and_dimension(spark):
    def gift(sub_id, amount, day):
        return (sub_id, *[""] * 9, amount and Decimal(amount), day, "IND", AS_OF)

    staged = spark.createDataFrame(
        [gift("a", "300", date(2024, 1, 1)), gift("b", "200.50", date(2024, 5, 1)), gift("c", "10", AS_OF),
         gift("d", None, None), gift("e", "9", AS_OF)], STAGING,
    )
    dim = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y"), ("f", "z")], "sub_id string, donor_id string")
    mart = M.build_mart(staged, dim, AS_OF)
    assert schema_problems(mart.schema, MART) == []
    rows = {r["donor_id"]: r for r in mart.collect()}
    assert set(rows) == {"x", "y"}
    assert (rows["x"]["contribution_count"], rows["x"]["total_amount"]) == (2, Decimal("500.500000000"))
    assert (rows["x"]["first_contribution_date"], rows["x"]["last_contribution_date"]) == (date(2024, 1, 1), date(2024, 5, 1))
    assert (rows["y"]["contribution_count"], rows["y"]["total_amount"]) == (2, Decimal("10"))
    assert [r["donor_id"] for r in M.lapsed_donors(mart, AS_OF).collect()] == ["x"]


def test_lapsed_edges(spark):
    rows = [("in", "500", date(2024, 6, 29)), ("too recent", "500", date(2024, 6, 30)), ("too little", "499.99", date(2020, 1, 1)),
            ("no date", "900", None)]
    mart = spark.createDataFrame(
        [(d, Decimal(t), last) for d, t, last in rows],
        "donor_id string, total_amount decimal(18,2), last_contribution_date date",
    )
    assert [r["donor_id"] for r in M.lapsed_donors(mart, AS_OF).collect()] == ["in"]


@pytest.fixture
def text(spark, tmp_path):
    lines = ["1|x |5", "2||5", "|\xa0|5", "4|x|5", "5|y|5|6", "6|y"]
    path = tmp_path / "d.txt"
    path.write_bytes("\n".join(lines).encode("latin-1"))
    return D.read_headerless(spark, str(path), columns=["K", "B", "C"])


def test_totals_and_key(spark, text):
    assert tuple(P.totals(text, 3).first()) == (6, 2, 3)
    assert tuple(P.totals(text, 50).first()) == (6, 2, 4)
    assert tuple(P.key_population(text, "K").first()) == (3, 6, 50.0, "fallback")
    assert tuple(P.key_population(D.good_rows(text), "K").first()) == (3, 4, 75.0, "preferred")
    assert P.key_population(D.good_rows(text), "C").first()["verdict"] == "reliable"


def test_null_profile(spark, text):
    assert [tuple(r)[1:] for r in P.null_profile(text).orderBy("position").collect()] == [
        ("K", 1, 16.67), ("B", 2, 33.33), ("C", 0, 0.0),
    ]
    assert [r["column_name"] for r in P.top_null_columns(text).collect()] == ["B", "K"]
    assert [r["column_name"] for r in P.top_null_columns(text, 1).collect()] == ["B"]


def test_duplicates_compare_stripped_values(spark, text):
    assert tuple(P.duplicate_profile(text, ["B", "C"]).first()) == (2, 2)
    assert [tuple(r) for r in P.duplicate_examples(text, 1, ["B", "C"]).collect()] == [("", "5", 2)]


def test_profile_of_the_source_columns(spark):
    report = P.profile_report(source_frame(spark, SOURCE_ROWS))
    assert tuple(report["totals"].first()) == (9, 0, 9)
    assert tuple(report["duplicates"].first()) == (8, 1)
    assert report["duplicate_examples"].first()["NAME"] == "HARRIS, JANET P"
    assert report["top_null_columns"].first()["column_name"] == "OTHER_ID"


@pytest.mark.parametrize("n", [1, 7, 100, 5000])
def test_first_rows_equal_sort_and_limit(spark, n):
    df = spark.range(3000, numPartitions=40).select(
        F.lpad((F.col("id") * 7919 % 3001).cast("string"), 4, "0").alias("SUB_ID"), "id"
    )
    got = [r["SUB_ID"] for r in P.first_rows(df, n, groups=(8, 3)).collect()]
    assert got == sorted(r["SUB_ID"] for r in df.collect())[:n]


def test_first_rows_with_a_repeated_key(spark):
    df = spark.range(300, numPartitions=10).select(F.when(F.col("id") % 3 == 0, "m").otherwise(F.col("id").cast("string")).alias("SUB_ID"))
    assert P.first_rows(df, 250).count() == 250


def test_first_rows_with_null_and_tied_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "SUB_ID string, v int").repartition(3)
    for n, wanted in [(1, [None]), (2, [None, None]), (3, [None, None, "a"]), (5, [None, None, "a", "a", "b"]), (9, [None, None, "a", "a", "b"])]:
        got = P.first_rows(df, n).collect()
        assert [r["SUB_ID"] for r in got] == wanted
        assert got == P.first_rows(df.repartition(2), n).collect()
    tied = spark.range(5000, numPartitions=8).select(F.lit("").alias("SUB_ID"), "id")
    assert len({r["id"] for r in P.first_rows(tied, 10).collect()}) == 10


def test_blank_zip_rate(spark):
    staged = spark.createDataFrame([("", AS_OF), ("1", AS_OF), ("2", AS_OF)], "zip_normalized string, _load_date date")
    assert tuple(P.blank_zip_rate(staged).first()) == (AS_OF, 1, 3, 33.33)


def test_staging_of_the_source_records(spark):
    raw = S.enforce_raw_schema(S.add_load_date(source_frame(spark, SOURCE_ROWS), AS_OF))
    assert tuple(S.individual_counts(raw).first()) == (9, 8, 1)
    staged = S.build_staging(raw)
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in STAGING]
    rows = staged.orderBy("sub_id").collect()
    assert len(rows) == 8
    assert rows[0]["donor_name_normalized"] == "smith john" and rows[0]["contribution_amount"] == Decimal(100)
    assert [r["zip_normalized"] for r in rows] == ["30301", "02101", "10001", "10001", "30301", "30301", "02101", "10001"]
    assert rows[1]["donor_address_normalized"] == "boston ma"
    from giftledger.operators.identity import resolve_identity

    dim = resolve_identity(staged)
    assert dim.select("donor_id").distinct().count() == 6
    assert {r["match_rule"] for r in dim.collect()} == {"rule1"}


def test_unknown_columns_are_ignored_and_missing_ones_fail(spark):
    grown = source_frame(spark, SOURCE_ROWS).withColumn("NEW", F.lit(1))
    assert S.select_source_columns(grown).columns == source_frame(spark, SOURCE_ROWS).columns
    with pytest.raises(Exception, match="SUB_ID"):
        S.select_source_columns(grown.drop("SUB_ID")).collect()
    with pytest.raises(Exception, match="SUB_ID"):
        S.build_staging(S.add_load_date(grown.drop("SUB_ID"), AS_OF)).collect()


def test_the_report_equals_the_single_results_and_reads_the_text_once(spark, text, monkeypatch):
    from pyspark.sql import DataFrame

    def texts(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")

    assert texts(text) == 1
    report = P.profile_report(text, 2, key="SUB_ID" if "SUB_ID" in text.columns else text.columns[0], gift=text.columns[:2])
    key = "SUB_ID" if "SUB_ID" in text.columns else text.columns[0]
    single = {
        "totals": P.totals(text, 2), "key_population": P.key_population(text, key), "top_null_columns": P.top_null_columns(text),
        "duplicates": P.duplicate_profile(text, text.columns[:2]), "duplicate_examples": P.duplicate_examples(text, key=text.columns[:2]),
        "sample": P.first_rows(text, 2, key),
    }
    for name, df in single.items():
        assert isinstance(report[name], DataFrame) and texts(report[name]) == 0
        assert report[name].columns == df.columns and report[name].collect() == df.collect(), name

from datetime import date
from decimal import Decimal

import pytest
from giftledger import functions as G
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = {
    "JOHN DOE": "john doe", "  MARY SUE  ": "mary sue", "John A. Doe Jr.": "john a doe jr",
    "O'NEIL, PATRICK": "oneil patrick", "MARY-SUE JONES": "mary sue jones", "SMITH, JOHN": "smith john",
    "JOHN  A   DOE": "john a doe", "": "", "JOHN_DOE": "john doe", "   ": "", "---": "",
    "DOE, JOHN III": "doe john iii", "José": "jos", "a 　b\x1c": "a b", "- x -": "x",
}
ADDRESSES = {
    "123 MAIN STREET": "123 main st", "456 Elm Avenue": "456 elm ave", "789 Oak Road": "789 oak rd",
    "100 Sunset Boulevard": "100 sunset blvd", "  123 Main St  ": "123 main st", "456 Elm Rd.": "456 elm rd",
    "123 Main St": "123 main st", "": "", "123 Main St Apt 4B": "123 main st apt 4b",
    "123 N Main Street": "123 n main st", "Suite 1-A": "suite 1a", "a_b": "a_b", "12 street street": "12 st st",
    "streets avenues": "streets avenues", "Drive Court Lane Place Circle": "dr ct ln pl cir", "street": "st",
    "a b": "a b", "École Road": "école rd", "x_street y": "x_street y", "st. street.": "st st",
}
ZIPS = {
    " 37209 ": "37209", "37209-1234": "37209", "372091234": "37209", "3720": "03720", "30301": "30301", "": "",
    "3720 1": "37201", "INVALID": "", "---": "", "00000": "00000", "٣٤": "000٣٤",
}


@pytest.mark.parametrize(
    "function, cases",
    [(G.normalize_name, NAMES), (G.normalize_address, ADDRESSES), (G.normalize_zip, ZIPS)],
    ids=["name", "address", "zip"],
)
def test_normalization(one_value, function, cases):
    assert one_value(function, [*cases, None]) == [*cases.values(), ""]


def test_every_unicode_space_is_whitespace(spark, one_value):
    spaces = [chr(c) for c in range(1, 0x3002) if chr(c).isspace()]
    assert one_value(G.is_blank, spaces) == [True] * len(spaces)
    assert one_value(G.normalize_name, [f"a{s}b" for s in spaces]) == ["a b"] * len(spaces)
    assert one_value(G.strip_whitespace, [f"{s}x y{s}" for s in spaces]) == ["x y"] * len(spaces)


def test_letters_and_digits_are_kept_in_addresses(one_value):
    """Word characters are those Python calls alphanumeric, and the underscore."""
    characters = [chr(c) for c in range(0x21, 0x1000) if not chr(c).isspace()]
    kept = one_value(G.normalize_address, characters)
    wrong = [c for c, k in zip(characters, kept) if (k != "") != (c.isalnum() or c == "_")]
    assert len(wrong) <= 40  # code points newer than the Java runtime's Unicode tables


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=50, max_size=50))
def test_normalizing_twice_changes_nothing(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for function in (G.normalize_name, G.normalize_address, G.normalize_zip):
        once = df.select(function("v").alias("once"))
        assert once.where(function("once") != F.col("once")).count() == 0


def test_city_and_state(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None), (None, None)], "c string, s string")
    assert [r[0] for r in df.select(G.address_source("c", "s")).collect()] == ["A B", " B", "A ", " "]


def test_strict_dates(one_value):
    given_ = ["01012025", "13012025", "02302025", "", " 01012025", "010120255", "1012025", None, "01010000"]
    assert one_value(G.parse_contribution_date, given_) == [date(2025, 1, 1)] + [None] * 8


def test_lenient_dates(one_value):
    given_ = ["01012025", "1012025", "112025", "12312025", "02302025", "132025", "1 12025", "", None]
    lenient = one_value(lambda c: G.parse_contribution_date(c, lenient=True), given_)
    assert lenient == [
        date(2025, 1, 1), date(2025, 10, 1), date(2025, 1, 1), date(2025, 12, 31), None, date(2025, 1, 3),
        date(2025, 1, 1), None, None,
    ]


def test_amounts_and_iso_dates(one_value):
    assert one_value(G.parse_amount, ["100", "1.5", "None", "", None, " 1e2 "]) == [
        Decimal("100"), Decimal("1.5"), None, None, None, Decimal("100"),
    ]
    assert one_value(G.parse_iso_date, ["2025-01-02", "None", None]) == [date(2025, 1, 2), None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_stops_the_job(spark, one_value, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cast = lambda c: G.strict_cast(c, T.DecimalType(38, 9))
        assert one_value(cast, ["12.5", None]) == [Decimal("12.5"), None]
        with pytest.raises(PySparkException, match="not a decimal"):
            one_value(cast, ["12", "abc"])
        with pytest.raises(PySparkException, match="not a decimal"):
            one_value(cast, [""])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_percent_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(G.percent("a", "b")).collect()] == [33.33, 0.0]


def test_translated_text_equals_the_expressions(one_value):
    """ASCII text is translated character by character; results are those of the regular expressions alone."""
    from giftledger.functions import text as T

    signs = [f"a{chr(c)}b {chr(c)}{chr(c)} {chr(c)}1" for c in range(0x250)]
    values = [*signs, "", "   ", "a - - b", "x street  street lane", "K st", "　a  b", "0٣٥ 12", None]

    def words(kept, gaps):
        def of(column):
            low = F.lower(F.coalesce(column, F.lit("")))
            return F.trim(F.regexp_replace(F.regexp_replace(low, f"[^{kept}{gaps}]+", ""), f"[{gaps}]+", " "))

        return of

    assert one_value(T.normalize_name, values) == one_value(words("a-z0-9", f"{T.WS}_\\-"), values)
    expected = [" ".join(T.STREET_WORDS.get(w, w) for w in v.split(" ")) for v in one_value(words(r"a-z0-9_\p{L}\p{N}", T.WS), values)]
    assert one_value(T.normalize_address, values) == expected
    digits = one_value(lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\P{Nd}", ""), values)
    assert one_value(T.normalize_zip, values) == [d and d[:5].rjust(5, "0") for d in digits]


def test_a_text_is_translated_before_any_expression(spark):
    """Plain names need no regular expression: it is in the second branch only, and ZIP digits are taken once."""
    from giftledger.functions import text as T

    plan = spark.createDataFrame([("a",)], "v string").select(T.normalize_name("v").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" in plan and plan.index("translate(") < plan.index("regexp_replace(")
    plan = spark.createDataFrame([("a",)], "v string").select(T.normalize_zip("v").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1

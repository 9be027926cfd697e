"""PII: format-preserving Feistel pseudonyms. DataFrame code only; texts are neither shuffled nor collected.

Values are validated by kind: card numbers (13 to 19 digits with a right check digit), ISO dates (from 1800 to 2199, a
whole Gregorian cycle of 146,097 days), telephone numbers `+1 (ddd) ddd-dddd`, social security numbers and IPv4
addresses. Each is written as a pair (a, b) of whole numbers below two fixed bounds and goes through `ROUNDS` rounds that
add a keyed hash of one number to the other. That permutes the values of a kind: equal values get equal pseudonyms in
every document, different ones different pseudonyms, and a pseudonym is valid where its value was. Separators stay. A
card keeps its length and gets the check digit of its new body; where a run of digit groups fails the check, the longest
part of it made of whole groups that passes is the card. Telephone numbers whose area or exchange is below 200 are
permuted among themselves. A date may be followed by the time of a timestamp.

The key is a required argument: who has it can invert the rounds, so it belongs in no source file. Only the registered
query, whose results have to be the same in every run, names one (`TEST_KEY`).

Defined results: a null text stays null; a text without values stays as it is; what fails its validation stays; rows
that repeat are each returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read

ROUNDS, CYCLE = 10, "1800-01-01"
CARD, DATE = r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", r"(?<![\w-])(?:18|19|20|21)[0-9]{2}-[01][0-9]-[0-3][0-9](?:(?=T[0-9])|(?![\w-]))"
PHONE, SSN = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])", r"(?<![\w-])[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}(?![\w-])"
IP = r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"
ANY = f"{DATE}|{SSN}|{PHONE}|{CARD}|{IP}"


def feistel(a: Column, b: Column, most_a: Column, most_b: Column, kind: str, key: str) -> Column:
    """A permutation of the pairs with a < most_a and b < most_b, as a struct (a, b)."""

    def moved(value: Column, other: Column, most: Column, turn: Column) -> Column:
        seed = F.concat_ws(":", F.lit(key), F.lit(kind), turn.cast("string"), most.cast("string"), other.cast("string"))
        return F.pmod(value + F.conv(F.substring(F.md5(seed), 1, 15), 16, 10).cast("long"), most)

    def turn_of(s: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(F.when(even, moved(s["a"], s["b"], most_a, turn)).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise(moved(s["b"], s["a"], most_b, turn)).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn_of)


def _with(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _pad(number: Column, size: Column | int) -> Column:
    return F.lpad(number.cast("string"), size, "0")


def _number(text: Column, start: int, size: int) -> Column:
    return F.substring(text, start, size).try_cast("long")


def _card(m: Column, key: str) -> Column:
    def permuted(d: Column) -> Column:
        left = F.floor((F.length(d) - 1) / 2).cast("int")
        right = F.length(d) - 1 - left
        bound = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
        pair = feistel(F.substring(d, F.lit(1), left), F.substring(d, left + 1, right), bound(left), bound(right), "card", key)
        body = _with(pair, lambda p: F.concat(_pad(p["a"], left), _pad(p["b"], right)))
        return _with(body, lambda x: F.concat(x, F.filter(F.sequence(F.lit(0), F.lit(9)), lambda c: F.call_function("luhn_check", F.concat(x, c.cast("string"))))[0].cast("string")))

    def laid_out(new: Column) -> Column:  # digits take the places of the old ones, separators stay
        at = lambda i: F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), "[^0-9]", ""))
        return F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(new, at(i), F.lit(1))).otherwise(c)), "")

    digits = F.regexp_replace(m, "[^0-9]", "")
    return F.when(F.call_function("luhn_check", digits), _with(_with(digits, permuted), laid_out))


def _card_within(m: Column, key: str) -> Column:
    """A run of digit groups with the longest (then first) part of whole groups that passes the check in pseudonym."""
    gap = lambda i: F.substring(m, i, F.lit(1)).isin(" ", "-")
    places, size = F.sequence(F.lit(1), F.length(m)), F.length(m)
    starts = F.filter(places, lambda i: (i == 1) | gap(F.greatest(i - 1, F.lit(1))))
    ends = F.filter(places, lambda i: (i == size) | gap(i + 1))
    parts = F.flatten(F.transform(starts, lambda s: F.transform(ends, lambda e: F.struct((s - e).alias("n"), s.alias("s"), F.substring(m, s, F.greatest(e - s + 1, F.lit(0))).alias("t")))))

    def right(x: Column) -> Column:
        digits = F.regexp_replace(x["t"], "[^0-9]", "")
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)

    best = F.array_min(F.filter(parts, right))
    return _with(best, lambda x: F.concat(F.substring(m, F.lit(1), x["s"] - 1), _card(x["t"], key), F.substring(m, x["s"] + F.length(x["t"]), size)))


def _date(m: Column, key: str) -> Column:
    day = F.try_to_date(m, "yyyy-MM-dd")
    place = F.date_diff(day, F.lit(CYCLE).cast("date"))  # 146,097 = 189 * 773 days
    pair = feistel(F.floor(place / 773), place % 773, F.lit(189), F.lit(773), "date", key)
    return F.when(day.isNotNull(), _with(pair, lambda p: F.date_format(F.date_add(F.lit(CYCLE).cast("date"), (p["a"] * 773 + p["b"]).cast("int")), "yyyy-MM-dd")))


def _phone(m: Column, key: str) -> Column:
    area, exchange = _number(m, 5, 3), _number(m, 10, 3)
    low, near = area < 200, (area >= 200) & (exchange < 200)  # neither is assigned: each class is permuted in itself
    from_a, from_b = F.when(low, 0).otherwise(200), F.when(low | near, 0).otherwise(200)
    most_a, most_b = F.when(low, 200).otherwise(800), F.when(low, 10_000_000).when(near, 2_000_000).otherwise(8_000_000)
    pair = feistel(area - from_a, (exchange - from_b) * 10_000 + _number(m, 14, 4), most_a, most_b, "phone", key)
    return _with(pair, lambda p: F.concat(F.lit("+1 ("), _pad(p["a"] + from_a, 3), F.lit(") "),
                                          _pad(F.floor(p["b"] / 10_000) + from_b, 3), F.lit("-"), _pad(p["b"] % 10_000, 4)))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = _number(m, 1, 3), _number(m, 5, 2), _number(m, 8, 4)
    pair = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9_999 + serial - 1, F.lit(898), F.lit(99 * 9_999), "ssn", key)
    new = _with(pair, lambda p: F.concat_ws("-", _pad(p["a"] + F.when(p["a"] >= 665, 2).otherwise(1), 3),
                                            _pad(F.floor(p["b"] / 9_999) + 1, 2), _pad(p["b"] % 9_999 + 1, 4)))
    return F.when((area > 0) & (area != 666) & (group > 0) & (serial > 0), new)


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    pair = _with(octets, lambda o: feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65_536), F.lit(65_536), "ip", key))
    new = _with(pair, lambda p: F.concat_ws(".", *[x.cast("string") for n in ("a", "b") for x in (F.floor(p[n] / 256), p[n] % 256)]))
    return F.when(F.forall(octets, lambda o: o < 256), new)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one value, null if it is of no kind or fails its validation."""
    kinds = [(DATE, _date), (SSN, _ssn), (PHONE, _phone), (IP, _ip)]
    out = F.when(m.rlike(f"^(?:{kinds[0][0]})$"), kinds[0][1](m, key))
    for pattern, of in kinds[1:]:
        out = out.when(m.rlike(f"^(?:{pattern})$"), of(m, key))
    return out.otherwise(F.coalesce(_card(m, key), _card_within(m, key)))


def values_of(text: Column, key: str) -> Column:
    """(value, pseudonym) of each value in order; those that fail their validation have no pseudonym."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.transform(found, lambda m: F.struct(m.alias("value"), pseudonym(m, key).alias("pseudonym")))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """row (all columns of ``docs``), text with pseudonyms in place of values, and n_values (how many were replaced)."""
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"), values_of(text, key).alias("found"))
    gaps = F.split("text", ANY, -1)
    joined = F.array_join(F.zip_with(gaps, "found", lambda g, x: F.concat(g, F.coalesce(x["pseudonym"], x["value"], F.lit("")))), "")
    return rows.select("row", joined.alias("text"), F.coalesce(F.size(F.filter("found", lambda x: x["pseudonym"].isNotNull())), F.lit(0)).alias("n"))


def masked_documents(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` with all their columns and pseudonyms in ``text``."""
    return pseudonymised(docs, key).select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")


#: Public, so no secret: for the registered query and its checks alone.
TEST_KEY = "pseudonyms"


def op8_pseudonyms(spark, sf_dir):
    out = pseudonymised(read(spark, sf_dir, "documents"), TEST_KEY)
    return out.select("row.doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("n")).cast("long").alias("n_values"), "text")

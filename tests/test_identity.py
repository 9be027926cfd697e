import hashlib
import random
from datetime import date

import pytest
from giftledger.operators import identity as I
from pyspark.sql import functions as F
from samples import DAY, IDENTITY, staged_rows

D1, D2 = date(2025, 1, 1), date(2025, 1, 2)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def resolved(spark, rows, **choices):
    return {r["sub_id"]: r for r in I.resolve_identity(staged_rows(spark, rows), **choices).collect()}


def keys(spark, rows, **choices):
    return {r["sub_id"]: r["canonical_key"] for r in I.resolve_keys(staged_rows(spark, rows), **choices).collect()}


def test_scenarios(spark):
    rows = resolved(spark, [r[:4] for r in IDENTITY])
    assert {s: (r["match_rule"], r["donor_id"]) for s, r in rows.items()} == {
        s: (rule, md5(key)) for s, _, _, _, rule, key in IDENTITY
    }
    assert not any(r["identity_conflict"] for r in rows.values())
    assert all(r["_load_date"] == DAY for r in rows.values())


def test_route_mode_flags_the_record_with_two_candidates(spark):
    dim = I.resolve_identity(staged_rows(spark, [r[:4] for r in IDENTITY]), mode="route")
    rows = {r["sub_id"]: r for r in dim.collect()}
    assert [s for s, r in rows.items() if r["identity_conflict"]] == ["R026"]
    assert rows["R026"]["donor_id"] == md5("chen robert|id:R026")
    assert len(rows) == 26
    review = I.unresolved_rows(dim).collect()
    assert [(r["sub_id"], r["conflict_reason"]) for r in review] == [("R026", "rule2_multiple_candidates")]
    assert "match_rule" not in review[0].asDict()


def test_two_records_without_zip_share_a_donor_by_address_only(spark):
    rows = [("a", "n", "x st", ""), ("b", "n", "x st", None), ("c", "n", "", ""), ("d", "n", None, ""), ("e", "n", "", "")]
    assert keys(spark, rows) == {
        "a": "n|addr:x st", "b": "n|addr:x st", "c": "n|id:c", "d": "n|id:d", "e": "n|id:e",
    }


def test_blank_address_never_links(spark):
    assert keys(spark, [("a", "n", "", "11111"), ("b", "n", "", "")])["b"] == "n|id:b"


def test_blank_names_merge_within_a_zip_and_null_names_have_no_donor(spark):
    rows = resolved(spark, [("a", "", "x", "11111"), ("b", "", "y", "11111"), ("c", None, "x", "11111"), ("d", None, "x", "")])
    assert rows["a"]["donor_id"] == rows["b"]["donor_id"] == md5("|zip:11111")
    assert rows["c"]["donor_id"] is None and rows["d"]["donor_id"] is None


def test_placeholder_zip(spark):
    rows = [("a", "n", "x", "00000"), ("b", "n", "x", "12345"), ("c", "n", "x", "")]
    assert keys(spark, rows) == {"a": "n|zip:00000", "b": "n|zip:12345", "c": "n|zip:00000"}
    assert keys(spark, rows, zero_zip_is_null=True) == {"a": "n|zip:12345", "b": "n|zip:12345", "c": "n|zip:12345"}


def test_scope(spark):
    rows = [("a", "n", "x", "12345", D1), ("b", "n", "x", "", D2)]
    assert keys(spark, rows)["b"] == "n|addr:x"
    assert keys(spark, rows, scope="all")["b"] == "n|zip:12345"


def test_zips_that_are_not_five_digits_sort_as_text(spark):
    others = ["٣٤٥٦٧", "123456", "-1234", " 1234", "+1234", "1234", "99999", "00001"]
    for kept in (others, others[:3], others[3:6], ["٣٤٥٦٧"], ["-1234", "-0999"], ["123456", "12345"]):
        rows = [(str(i), "n", "x", z) for i, z in enumerate(kept)] + [("q", "n", "x", "")]
        assert keys(spark, rows)["q"] == "n|zip:" + min(kept, key=lambda z: z.encode())
        flagged = resolved(spark, rows, mode="route")["q"]["identity_conflict"]
        assert flagged == (len(kept) > 1)


def test_identical_records_without_zip_collapse_and_others_do_not(spark):
    rows = [("a", "n", "x", "")] * 3 + [("b", "n", "x", "1")] * 2
    counts = {r["sub_id"]: r["count"] for r in I.resolve_identity(staged_rows(spark, rows)).groupBy("sub_id").count().collect()}
    assert counts == {"a": 1, "b": 2}


def brute_force(rows, scope, zero_is_null):
    blank = ("", None, "00000") if zero_is_null else ("", None)
    result = {}
    for sub_id, name, address, zip_code, day in rows:
        if zip_code not in blank:
            result[sub_id] = (f"{name}|zip:{zip_code}", "rule1", False)
            continue
        found = {
            z for _, n, a, z, d in rows
            if z not in blank and n == name and a == address and address and (scope == "all" or d == day)
        }
        if found:
            result[sub_id] = (f"{name}|zip:{min(found)}", "rule2", len(found) > 1)
        elif address:
            result[sub_id] = (f"{name}|addr:{address}", "rule2", False)
        else:
            result[sub_id] = (f"{name}|id:{sub_id}", "no_match", False)
    return result


@pytest.mark.parametrize("scope", I.SCOPES)
@pytest.mark.parametrize("zero_is_null", [False, True])
def test_against_brute_force_with_a_hot_name(spark, scope, zero_is_null):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        hot = rng.random() < 1 / 3
        name, address = ("hot", "hotville") if hot else (f"n{rng.randrange(25)}", rng.choice(["", None, "x", "y"]))
        rows.append((f"s{i}", name, address, rng.choice(["", None, "00000", "11111", "22222", "٣٣٣٣٣"]), rng.choice([D1, D2])))
    expected = brute_force(rows, scope, zero_is_null)
    staged = staged_rows(spark, rows)
    plain = I.resolve_keys(staged, scope=scope, zero_zip_is_null=zero_is_null).collect()
    assert {r["sub_id"]: (r["canonical_key"], r["match_rule"]) for r in plain} == {s: e[:2] for s, e in expected.items()}
    routed = I.resolve_keys(staged, mode="route", scope=scope, zero_zip_is_null=zero_is_null).collect()
    assert {r["sub_id"]: r["canonical_key"] for r in routed} == {
        s: f"{key.split('|')[0]}|id:{s}" if conflict else key for s, (key, _, conflict) in expected.items()
    }
    assert {r["sub_id"] for r in routed if r["identity_conflict"]} == {s for s, e in expected.items() if e[2]}
    assert len(plain) == len(routed) == 600


def test_distribution_and_lookup(spark):
    dim = I.resolve_identity(staged_rows(spark, [r[:4] for r in IDENTITY]))
    assert [tuple(r) for r in I.match_rule_distribution(dim).collect()] == [
        ("rule1", 22, 84.62), ("rule2", 3, 11.54), ("no_match", 1, 3.85),
    ]
    assert [tuple(r) for r in I.match_rule_counts(dim).collect()] == [("rule1", 22), ("rule2", 3), ("no_match", 1)]
    assert I.donor_id_for(dim, "R005", DAY) == md5("obrien patrick|zip:60601")
    assert I.donor_id_for(dim, "R005", D1) is None
    assert I.donor_id_for(dim, "R005") is not None


def test_unknown_choices_are_refused(spark):
    staged = staged_rows(spark, [("a", "n", "x", "1")])
    with pytest.raises(ValueError):
        I.resolve_identity(staged, mode="other")
    with pytest.raises(ValueError):
        I.resolve_identity(staged.where(F.lit(True)), scope="other")

from datetime import date
from decimal import Decimal

import pytest
from giftledger.operators import quality as Q
from giftledger.operators import upsert as U
from giftledger.schemas import LOAD_DATE, STAGING
from giftledger.sources import tables as tb
from pyspark.sql import functions as F

D1, D2, D3 = date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3)


def staged(spark, *rows):
    """Staging rows from (sub_id, name, load date)."""
    full = [
        (s, "C", "T", name, "c", "s", "z", name, "a", "z", Decimal(1), D1, "IND", day) for s, name, day in rows
    ]
    return spark.createDataFrame(full, STAGING)


def stored(spark, path):
    rows = tb.read_table(spark, path, STAGING).collect()
    return sorted((r["sub_id"] or "", r["name_raw"], r[LOAD_DATE]) for r in rows)


def test_merge_rows_replaces_and_inserts(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "sub_id string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "sub_id string, v int")
    merged = sorted(U.merge_rows(target, source).collect(), key=lambda r: r["v"])
    assert [tuple(r) for r in merged] == [("a", 1), (None, 3), ("b", 20), ("c", 30), (None, 40)]


def test_upsert_into_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    first = U.upsert_table(spark, path, STAGING, staged(spark, ("a", "x", D1), ("b", "x", D1), ("c", "x", D2)))
    assert (first.rows_in, first.load_dates, first.emptied) == (3, (D1, D2), ())
    # b changes in place; c moves to D3, which empties D2; e is new.
    batch = staged(spark, ("b", "y", D1), ("c", "y", D3), ("e", "y", D3))
    second = U.upsert_table(spark, path, STAGING, batch)
    expected = [("a", "x", D1), ("b", "y", D1), ("c", "y", D3), ("e", "y", D3)]
    assert stored(spark, path) == expected
    assert (second.rows_in, second.load_dates, second.emptied) == (3, (D1, D2, D3), (D2,))
    assert tb.load_dates(spark, path) == [D1, D3]
    # Running the batch again changes nothing, down to the content.
    before = Q.fingerprint(tb.read_table(spark, path, STAGING)).first()
    U.upsert_table(spark, path, STAGING, batch)
    assert Q.fingerprint(tb.read_table(spark, path, STAGING)).first() == before


def test_moved_row_leaves_the_rest_of_its_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    U.upsert_table(spark, path, STAGING, staged(spark, ("a", "x", D1), ("b", "x", D1), ("z", "x", D2)))
    untouched = tb.read_partition(spark, path, STAGING, D2).inputFiles()
    result = U.upsert_table(spark, path, STAGING, staged(spark, ("a", "y", D3)))
    assert stored(spark, path) == [("a", "y", D3), ("b", "x", D1), ("z", "x", D2)]
    assert result.emptied == () and result.load_dates == (D1, D3)
    # A partition the batch does not concern is not rewritten.
    assert tb.read_partition(spark, path, STAGING, D2).inputFiles() == untouched


def test_new_rows_join_a_partition_that_keeps_all_of_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    U.upsert_table(spark, path, STAGING, staged(spark, ("a", "x", D1), ("b", "x", D2)))
    U.upsert_table(spark, path, STAGING, staged(spark, ("c", "y", D1)))
    assert stored(spark, path) == [("a", "x", D1), ("b", "x", D2), ("c", "y", D1)]
    # All rows of one day replaced, some of another, none of a third, in one batch.
    U.upsert_table(spark, path, STAGING, staged(spark, ("a", "z", D1), ("c", "z", D2), ("d", "z", D3)))
    assert stored(spark, path) == [("a", "z", D1), ("b", "x", D2), ("c", "z", D2), ("d", "z", D3)]


def test_many_batches_equal_a_dictionary(spark, tmp_path):
    import random

    rng, path, expected = random.Random(3), str(tmp_path / "t"), {}
    tb.ensure_table(spark, path, STAGING)
    for step in range(6):
        ids = rng.sample(range(12), rng.randrange(1, 9))
        batch = {f"s{i:02d}": (f"v{step}", rng.choice([D1, D2, D3])) for i in ids}
        expected.update(batch)
        U.upsert_table(spark, path, STAGING, staged(spark, *[(k, v, d) for k, (v, d) in batch.items()]))
        assert stored(spark, path) == sorted((k, v, d) for k, (v, d) in expected.items())


def test_empty_batch_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    assert U.upsert_table(spark, path, STAGING, staged(spark)) == U.UpsertResult(0, 0)
    assert stored(spark, path) == []


@pytest.mark.parametrize(
    "rows", [[("a", "x", D1), ("a", "y", D2)], [(None, "x", D1)], [("a", "x", None)]], ids=["repeat", "null", "no day"]
)
def test_bad_keys_are_refused(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    with pytest.raises(U.KeyViolation):
        U.upsert_table(spark, path, STAGING, staged(spark, *rows))
    assert stored(spark, path) == []


def test_key_violations_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "sub_id string")
    assert tuple(U.key_violations(df).first()) == (2, 1)
    assert tuple(U.key_violations(df.where("false")).first()) == (0, 0)


def test_fallback_key(spark):
    schema = "donor_name_normalized string, contribution_date date, contribution_amount int, sub_id string"
    target = spark.createDataFrame([("n", D1, 5, "t1"), ("n", None, 5, "t2"), ("m", D1, 5, "t3")], schema)
    source = spark.createDataFrame(
        [("n", D1, 5, "s2"), ("n", D1, 5, "s1"), ("n", None, 5, "s3"), ("n", None, 5, "s4")], schema
    )
    merged = U.merge_on_fallback_key(target, source)
    assert sorted(r["sub_id"] for r in merged.collect()) == ["s1", "s3", "s4", "t2", "t3"]


def test_fallback_key_without_record_ids(spark):
    schema = "donor_name_normalized string, contribution_date date, contribution_amount int, cmte_id string, sub_id string"
    rows = [("n", D1, 5, "C3", None), ("n", D1, 5, "C2", None), ("m", D1, 5, "C4", None), ("m", D1, 5, "C5", "s1"), ("k", D1, 1, None, None)]
    target = spark.createDataFrame([("n", D1, 5, "C1", "t1"), ("z", D1, 5, "C1", None)], schema)
    merged = U.merge_on_fallback_key(target, spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, merged.collect())) == [
        ("k", D1, 1, None, None), ("m", D1, 5, "C5", "s1"), ("n", D1, 5, "C2", None), ("z", D1, 5, "C1", None)
    ]


def test_one_large_date_is_written_in_several_files_and_small_ones_in_one(spark, tmp_path):
    """Few dates must not leave writers and later readers with one or two tasks; small tables still get few files."""
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    one = staged(spark, ("a", "x", D1))
    many = spark.range(150_000).select(F.col("id").cast("string").alias("sub_id"), F.sha2(F.col("id").cast("string"), 256).alias("name_raw"))
    large = one.drop("sub_id", "name_raw").crossJoin(many).select(*STAGING.fieldNames())
    U.upsert_table(spark, path, STAGING, large)
    assert len(tb.read_partition(spark, path, STAGING, D1).inputFiles()) > 1
    U.upsert_table(spark, path, STAGING, staged(spark, *[(f"s{i}", "x", D2) for i in range(50)]))
    assert len(tb.read_partition(spark, path, STAGING, D2).inputFiles()) == 1
    assert tb.read_table(spark, path, STAGING).count() == 150_050


def test_withdrawn_moved_and_kept_rows_of_one_batch(spark, tmp_path):
    """Kept rows of other dates lose exactly the batch's keys, found without a second comparison with the index."""
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    U.upsert_table(spark, path, STAGING, staged(spark, ("a", "x", D1), ("b", "x", D1), ("c", "x", D2), ("d", "x", D2)))
    done = U.upsert_table(spark, path, STAGING, staged(spark, ("b", "y", D2), ("d", "x", D2)), day=D2)
    assert stored(spark, path) == [("a", "x", D1), ("b", "y", D2), ("d", "x", D2)]
    assert (done.updated, done.deleted, done.unchanged) == (1, 1, 1)

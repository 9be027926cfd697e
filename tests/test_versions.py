"""Tables as manifests and versions: crashes after every step, competing writers, the key index, retention."""

import random
from datetime import date
from decimal import Decimal

import pytest
from giftledger.operators import upsert as U
from giftledger.plans import daily_run as R
from giftledger.schemas import DIM_DONORS, LOAD_DATE, MART, STAGING
from giftledger.sources import keys as K
from giftledger.sources import tables as tb
from giftledger.sources import versions as V
from giftledger.sources import workspace
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from samples import DAY, SOURCE_ROWS, source_frame, source_row

D1, D2, D3 = date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3)


class Crash(Exception):
    pass


class Stops:
    """Counts the steps that touch storage and stops the process before or after the n-th, or in the middle of it."""

    def __init__(self, monkeypatch):
        self.left, self.when = None, "before"
        for owner, name in ((DataFrameWriter, "parquet"), (DataFrameWriter, "insertInto"), (V, "create_file"), (V, "delete_path"), (workspace, "delete_path")):
            monkeypatch.setattr(owner, name, self._wrapped(getattr(owner, name), name))

    def _wrapped(self, step, name):
        def run(*arguments, **options):
            if self.left is None:
                return step(*arguments, **options)
            self.left -= 1
            if self.left == 0 and self.when == "before":
                raise Crash(name)
            result = step(*arguments, **options)
            if self.left == 0:
                if self.when == "middle" and name == "parquet":
                    self._lose_files(arguments[1])
                raise Crash(name)
            return result

        return run

    @staticmethod
    def _lose_files(folder):
        """As if the commit of the job had been cut short: every other file is not there yet."""
        import pathlib

        for file in sorted(pathlib.Path(folder).rglob("part-*.parquet"))[::2]:
            file.unlink()

    def at(self, step, when):
        self.left, self.when = step, when

    def off(self):
        self.left = None


def staged(spark, *rows):
    full = [(s, "C", "T", name, "c", "s", "z", name, "a", "z", Decimal(1), D1, "IND", day) for s, name, day in rows]
    return spark.createDataFrame(full, STAGING)


def stored(spark, path):
    rows = tb.read_table(spark, path, STAGING).collect()
    return sorted((r["sub_id"], r["name_raw"], r[LOAD_DATE]) for r in rows)


def indexed(spark, path):
    index = V.current(spark, path).index
    return sorted((r["sub_id"], r[LOAD_DATE]) for r in K.latest(spark, path, STAGING, index).collect())


FIRST = [("a", "x", D1), ("b", "x", D1), ("c", "x", D2), ("d", "x", D3)]
SECOND = [("b", "y", D1), ("c", "y", D3), ("e", "y", D3)]  # changes in place, moves and so empties a day, is new
AFTER = [("a", "x", D1), ("b", "y", D1), ("c", "y", D3), ("d", "x", D3), ("e", "y", D3)]


@pytest.mark.parametrize("when", ["before", "middle", "after"])
def test_a_crash_after_any_step_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, when):
    stops, before, seen = Stops(monkeypatch), sorted(FIRST), set()
    for step in range(1, 20):
        path = str(tmp_path / f"t{step}")
        tb.ensure_table(spark, path, STAGING)
        U.upsert_table(spark, path, STAGING, staged(spark, *FIRST))
        stops.at(step, when)
        try:
            U.upsert_table(spark, path, STAGING, staged(spark, *SECOND))
            crashed = False
        except Crash:
            crashed = True
        stops.off()
        found = stored(spark, path)
        assert found in (before, AFTER)
        seen.add(found == AFTER)
        U.upsert_table(spark, path, STAGING, staged(spark, *SECOND))  # the rerun
        assert stored(spark, path) == AFTER and indexed(spark, path) == [(s, d) for s, _, d in AFTER]
        if not crashed:
            break
    assert step > 3 and seen == {True, False}


@pytest.mark.parametrize("when", ["before", "middle", "after"])
def test_a_crash_while_partitions_are_replaced(spark, tmp_path, monkeypatch, when):
    stops = Stops(monkeypatch)
    for step in range(1, 10):
        path = str(tmp_path / f"t{step}")
        tb.replace_partitions(staged(spark, *FIRST), path)
        stops.at(step, when)
        try:
            tb.replace_partitions(staged(spark, ("z", "z", D1), ("y", "z", D2)), path, emptied=[D3])
            crashed = False
        except Crash:
            crashed = True
        stops.off()
        assert stored(spark, path) in (sorted(FIRST), [("y", "z", D2), ("z", "z", D1)])
        tb.replace_partitions(staged(spark, ("z", "z", D1), ("y", "z", D2)), path, emptied=[D3])
        assert stored(spark, path) == [("y", "z", D2), ("z", "z", D1)]
        if not crashed:
            break
    assert step > 1


def test_the_second_of_two_writers_fails_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.replace_partitions(staged(spark, *FIRST), path)
    old = V.current(spark, path)
    tb.replace_partitions(staged(spark, ("z", "z", D1)), path)
    with pytest.raises(V.ConcurrentWrite):
        V.commit(spark, path, old, {D2: ("v0",)})
    assert ("z", "z", D1) in stored(spark, path)
    assert not [n for n in workspace.list_names(spark, f"{path}/manifests") if not n.isdigit()]


def test_a_reader_keeps_the_state_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.replace_partitions(staged(spark, *FIRST), path)
    reader = tb.read_table(spark, path, STAGING)
    tb.replace_partitions(staged(spark, ("z", "z", D1)), path, emptied=None)
    assert reader.count() == 4 and tb.read_table(spark, path, STAGING).count() == 1


def test_unchanged_parts_are_referred_to_and_additions_do_not_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    U.upsert_table(spark, path, STAGING, staged(spark, *FIRST))
    first = V.current(spark, path).parts
    assert U.upsert_table(spark, path, STAGING, staged(spark, ("f", "x", D1))).rows_written == 1
    second = V.current(spark, path).parts
    assert second[D2] == first[D2] and second[D1][:1] == first[D1] and len(second[D1]) == 2
    number = V.current(spark, path).number
    again = U.upsert_table(spark, path, STAGING, staged(spark, ("f", "x", D1)))  # nothing to do, nothing written
    assert (again.unchanged, again.rows_written, V.current(spark, path).number) == (1, 0, number)


def test_many_versions_and_a_rewritten_index_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "MOST", 2)
    monkeypatch.setattr(U, "MOST_VERSIONS", 2)
    rng, path, expected = random.Random(5), str(tmp_path / "t"), {}
    tb.ensure_table(spark, path, STAGING)
    for step in range(7):
        ids = rng.sample(range(15), rng.randrange(1, 8))
        day = [None, D1, D2][step % 3]
        batch = {f"s{i:02d}": (f"v{step // 2}", day or rng.choice([D1, D2, D3])) for i in ids}
        gone = [k for k, (_, d) in expected.items() if day and d == day and k not in batch]
        changed = {k for k, v in batch.items() if k in expected and expected[k] != v}
        fresh = set(batch) - set(expected)
        for k in gone:
            del expected[k]
        expected.update(batch)
        done = U.upsert_table(spark, path, STAGING, staged(spark, *[(k, v, d) for k, (v, d) in batch.items()]), day=day)
        assert stored(spark, path) == sorted((k, v, d) for k, (v, d) in expected.items())
        assert indexed(spark, path) == sorted((k, d) for k, (_, d) in expected.items())
        assert (done.inserted, done.updated, done.deleted) == (len(fresh), len(changed), len(gone))
        assert done.unchanged == len(batch) - len(fresh) - len(changed)
    assert len(V.current(spark, path).index.versions) <= 2 and max(map(len, V.current(spark, path).parts.values())) <= 2


def test_an_index_is_built_for_a_table_that_has_none(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.replace_partitions(staged(spark, *FIRST), path)
    assert V.current(spark, path).index is None
    U.upsert_table(spark, path, STAGING, staged(spark, *SECOND))
    assert stored(spark, path) == AFTER and indexed(spark, path) == [(s, d) for s, _, d in AFTER]


def test_a_day_without_records_is_withdrawn(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    U.upsert_table(spark, path, STAGING, staged(spark, *FIRST))
    done = U.upsert_table(spark, path, STAGING, staged(spark), day=D1)
    assert (done.deleted, done.emptied, done.rows_in) == (2, (D1,), 0)
    assert stored(spark, path) == [("c", "x", D2), ("d", "x", D3)]
    assert U.upsert_table(spark, path, STAGING, staged(spark), day=D1) == U.UpsertResult(0, 0)


def test_history_is_not_shuffled(spark, tmp_path):
    """Only the batch is dealt into the buckets of the key index, whatever the number of shuffle partitions."""
    path = str(tmp_path / "t")
    tb.ensure_table(spark, path, STAGING)
    for step in range(2):  # two versions, so the newest row of each key has to be found
        rows = staged(spark, *[(f"s{i}", f"v{step}", D1) for i in range(50)])
        U.upsert_table(spark, path, STAGING, rows)
    index = V.current(spark, path).index
    held = K.latest(spark, path, STAGING, index)
    batch = staged(spark, ("s1", "v9", D2)).select("sub_id", LOAD_DATE, *K.content_hashes(STAGING, ["sub_id"]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        compared = U.changes(batch, held, index.buckets)
        plan = compared._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        history = plan[:plan.index("FileScan")].splitlines()
        assert not [line for line in history if "Exchange" in line]
        assert compared.where("change <> 'keep'").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sweep_removes_what_no_kept_manifest_names(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in "abcde":
        tb.replace_partitions(staged(spark, (name, "x", D1)), path)
    failed = V.new_version()
    tb.write_version(staged(spark, ("z", "z", D2)), path, failed)  # never published
    reader = tb.read_table(spark, path, STAGING)
    assert len(workspace.list_names(spark, f"{path}/versions")) == 6
    gone = V.sweep(spark, path, keep=2)
    assert any(failed in item for item in gone) and len(workspace.list_names(spark, f"{path}/versions")) == 2
    assert len(workspace.list_names(spark, f"{path}/manifests")) == 2
    assert stored(spark, path) == [("e", "x", D1)] and reader.count() == 1
    assert V.sweep(spark, path, keep=2) == []


def test_runs_keep_few_mart_snapshots_and_none_that_failed(spark, tmp_path):
    w = R.Warehouse(str(tmp_path / "w"))
    source = source_frame(spark, SOURCE_ROWS)
    bad = R.Options(limits=R.Q.Limits(max_rows=7, null_rates={}), keep=1)  # eight rows are staged
    R.run_day(spark, source, DAY, w)
    with pytest.raises(R.Q.GateFailed):
        R.run_day(spark, source_frame(spark, [source_row(9)]), D2, w, R.Options(limits=R.Q.Limits(max_rows=2)))
    snapshots = workspace.list_names(spark, f"{w.mart}/versions")
    assert len(snapshots) == 2  # one of them failed its check
    with pytest.raises(R.Q.GateFailed):
        R.run_day(spark, source, DAY, w, bad)
    R.run_day(spark, source_frame(spark, [source_row(9)]), D2, w, R.Options(keep=1))
    assert workspace.list_names(spark, f"{w.mart}/versions") == [f"version={tb.current_version(spark, w.mart)}"]
    for path in (w.raw, w.staging, w.dim_donors):
        assert len(workspace.list_names(spark, f"{path}/manifests")) == 1
    assert tb.read_snapshot(spark, w.mart, MART).agg(F.sum("contribution_count")).first()[0] == tb.read_table(spark, w.dim_donors, DIM_DONORS).count()

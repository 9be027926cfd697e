from dataclasses import replace
from datetime import date

import pytest
from giftledger.__main__ import main
from giftledger.operators import quality as Q
from giftledger.plans import daily_run as R
from giftledger.plans.runlog import read_run_log
from giftledger.schemas import DIM_DONORS, MART, RAW, SOURCE_COLUMNS, STAGING, UNRESOLVED
from giftledger.sources import tables as tb
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from samples import DAY, IDENTITY, SOURCE_ROWS, source_frame, source_row

DAY_2 = date(2099, 1, 2)
TASKS = ["ingest_raw", "check_raw", "build_staging", "check_staging", "build_identity_layer", "check_identity",
         "build_mart", "check_mart"]


def write_source(path, rows, header=True, encoding="utf-8"):
    lines = (["|".join(SOURCE_COLUMNS)] if header else []) + ["|".join(r) for r in rows]
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)


@pytest.fixture
def warehouse(tmp_path):
    return R.Warehouse(str(tmp_path / "warehouse"))


def fingerprints(spark, w):
    tables = [(w.raw, RAW), (w.staging, STAGING), (w.dim_donors, DIM_DONORS)]
    prints = [Q.fingerprint(tb.read_table(spark, path, schema)).first() for path, schema in tables]
    return [*prints, Q.fingerprint(tb.read_snapshot(spark, w.mart, MART)).first()]


def log_of(spark, w, run_id=None):
    rows = read_run_log(spark, w.run_log)
    rows = rows.where(F.col("run_id") == run_id) if run_id else rows
    return [(r["task_name"], r["row_count_input"], r["row_count_output"], r["status"]) for r in rows.orderBy("timestamp").collect()]


def test_a_day_and_its_rerun(spark, tmp_path, warehouse):
    source = R.read_source(spark, write_source(tmp_path / "s.csv", SOURCE_ROWS))
    run_id = R.run_day(spark, source, DAY, warehouse)
    assert log_of(spark, warehouse, run_id) == [
        ("ingest_raw", 9, 9, "PASS"), ("check_raw", 9, 9, "PASS"), ("build_staging", 9, 8, "PASS"),
        ("check_staging", 8, 8, "PASS"), ("build_identity_layer", 8, 8, "PASS"), ("check_identity", 8, 8, "PASS"),
        ("build_mart", 8, 6, "PASS"), ("check_mart", 6, 6, "PASS"),
    ]
    assert tb.read_table(spark, warehouse.unresolved, UNRESOLVED).count() == 0
    before = fingerprints(spark, warehouse)
    again = R.run_day(spark, source, DAY, warehouse)
    assert fingerprints(spark, warehouse) == before
    assert len(log_of(spark, warehouse)) == 16 and again != run_id

    # Another day adds to it; a backfill of the first leaves the second alone.
    more = source_frame(spark, [source_row(50, name="NEW, PERSON", zip_code="", city="", state="")] * 1)
    R.run_day(spark, more, DAY_2, warehouse, R.Options(limits=Q.Limits(null_rates={"NAME": 0.0})))
    counts = tb.partition_row_count(tb.read_table(spark, warehouse.dim_donors, DIM_DONORS)).collect()
    assert {r["load_date"]: r["row_count"] for r in counts} == {DAY: 8, DAY_2: 1}
    assert tb.read_snapshot(spark, warehouse.mart, MART).count() == 7


def test_a_failed_check_stops_the_run_and_keeps_the_mart(spark, tmp_path, warehouse):
    R.run_day(spark, source_frame(spark, SOURCE_ROWS), DAY, warehouse)
    published = tb.current_version(spark, warehouse.mart)
    before = fingerprints(spark, warehouse)
    bad = source_frame(spark, [*SOURCE_ROWS, source_row(77, zip_code="")])
    with pytest.raises(Q.GateFailed, match="raw_null_rate_ZIP_CODE"):
        R.run_day(spark, bad, DAY_2, warehouse)
    after = fingerprints(spark, warehouse)
    assert after[1:] == before[1:] and after[0] != before[0]
    assert tb.current_version(spark, warehouse.mart) == published
    assert log_of(spark, warehouse)[-1] == ("check_raw", 10, 0, "FAIL")

    # A mart that fails its check is never published.
    options = R.Options(limits=replace(Q.Limits(), max_rows=10))
    wide = source_frame(spark, [source_row(100 + i, name=f"P{i}") for i in range(5)])
    with pytest.raises(Q.GateFailed, match="mart_row_count"):
        R.run_day(spark, wide, DAY_2, warehouse, options)
    assert tb.current_version(spark, warehouse.mart) == published
    assert log_of(spark, warehouse)[-1][0::3] == ("check_mart", "FAIL")


def test_repeated_record_ids_stop_staging(spark, warehouse):
    rows = source_frame(spark, [*SOURCE_ROWS, SOURCE_ROWS[0]])
    with pytest.raises(ValueError, match="repeated keys"):
        R.run_day(spark, rows, DAY, warehouse)
    assert [t for t, *_ in log_of(spark, warehouse)] == TASKS[:3]
    assert log_of(spark, warehouse)[-1][3] == "FAIL"


def test_a_bad_amount_or_line_stops_the_ingest(spark, tmp_path, warehouse):
    R.ingest_raw(spark, source_frame(spark, SOURCE_ROWS), DAY, warehouse.raw)
    for rows in ([source_row(1, amount="x")], [source_row(1)[:-1]]):
        source = R.read_source(spark, write_source(tmp_path / "bad.csv", rows))
        with pytest.raises(PySparkException, match="not a decimal|malformed row"):
            R.ingest_raw(spark, source, DAY, warehouse.raw)
    assert tb.read_table(spark, warehouse.raw, RAW).count() == 9
    skipped = R.read_source(spark, write_source(tmp_path / "bad.csv", [source_row(1)[:-1], source_row(2)]), on_malformed="skip")
    assert R.ingest_raw(spark, skipped, DAY, warehouse.raw) == R.Reconciled(1, 1)


def test_route_mode_fills_and_clears_the_review_table(spark, warehouse):
    from samples import staged_rows

    staged = staged_rows(spark, [r[:4] for r in IDENTITY])
    run = lambda mode: R.run_identity(spark, staged, warehouse.dim_donors, warehouse.unresolved, mode)
    run("route")
    review = tb.read_table(spark, warehouse.unresolved, UNRESOLVED)
    assert [r["sub_id"] for r in review.collect()] == ["R026"]
    assert tb.read_table(spark, warehouse.dim_donors, DIM_DONORS).where("identity_conflict").count() == 1
    run("inherit_min")
    assert tb.read_table(spark, warehouse.unresolved, UNRESOLVED).count() == 0
    assert tb.read_table(spark, warehouse.dim_donors, DIM_DONORS).count() == 26


def test_rebuild_drops_load_dates_that_have_gone(spark, warehouse):
    from samples import staged_rows

    rows = [r[:4] for r in IDENTITY]
    two_days = staged_rows(spark, [*[(*r, DAY) for r in rows[:20]], *[(*r, DAY_2) for r in rows[20:]]])
    tables = (warehouse.dim_donors, warehouse.unresolved)
    assert R.rebuild_identity(spark, two_days, *tables, mode="route") == 26
    flagged = tb.read_table(spark, warehouse.dim_donors, DIM_DONORS).where("identity_conflict").count()
    assert tb.read_table(spark, warehouse.unresolved, UNRESOLVED).count() == flagged > 0
    assert R.rebuild_identity(spark, two_days.where(F.col("_load_date") == F.lit(DAY)), *tables) == 20
    assert tb.read_table(spark, warehouse.unresolved, UNRESOLVED).count() == 0
    counts = tb.partition_row_count(tb.read_table(spark, warehouse.dim_donors, DIM_DONORS)).collect()
    assert [tuple(r) for r in counts] == [(DAY, 20)]


def test_a_run_over_all_dates_links_across_days(spark, warehouse):
    options = R.Options(scope="all", limits=Q.Limits(null_rates={}))
    R.run_day(spark, source_frame(spark, [source_row(1)]), DAY, warehouse, options)
    R.run_day(spark, source_frame(spark, [source_row(2, zip_code="")]), DAY_2, warehouse, options)
    rows = tb.read_table(spark, warehouse.dim_donors, DIM_DONORS).collect()
    assert len(rows) == 2 and len({r["donor_id"] for r in rows}) == 1


def test_command_line(spark, tmp_path, capsys):
    root = str(tmp_path / "w")
    source = write_source(tmp_path / "s.csv", SOURCE_ROWS)
    day = ["--execution-date", DAY.isoformat(), "--warehouse", root]
    with pytest.raises(SystemExit):
        main(["ingest", "--warehouse", root, "--csv-path", source])
    assert "--execution-date" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        main(["ingest", "--execution-date", "01/02/2025", "--warehouse", root, "--csv-path", source])
    assert main(["ingest", *day, "--csv-path", source]) == 0
    assert main(["staging", *day]) == 0
    assert main(["identity", *day]) == 0
    assert "rule1" in capsys.readouterr().out
    assert main(["run", *day, "--csv-path", source]) == 0
    bad = write_source(tmp_path / "bad.csv", [source_row(1, zip_code="")])
    assert main(["run", *day, "--csv-path", bad]) == 1
    assert main(["run", *day, "--csv-path", source, "--min-rows", "100"]) == 1
    late = write_source(tmp_path / "late.csv", [source_row(1, zip_code="", day="1012025", amount="700"), source_row(2)])
    assert main(["run", *day, "--csv-path", late, "--null-rate", "ZIP_CODE=50", "--lenient-dates", "--keep", "1"]) == 0
    staged = tb.read_table(spark, R.Warehouse(root).staging, STAGING)
    assert {r["contribution_date"].isoformat() for r in staged.collect()} == {"2025-10-01", "2025-01-01"}
    published = tb.current_version(spark, R.Warehouse(root).mart)
    assert main(["rebuild", *day, "--scope", "all", "--conflicts", "route"]) == 0
    assert tb.current_version(spark, R.Warehouse(root).mart) != published
    lapsed = str(tmp_path / "lapsed")
    assert main(["lapsed", "--execution-date", "2027-01-01", "--warehouse", root, "--output", lapsed]) == 0
    assert [r["total_amount"] for r in spark.read.option("header", True).option("sep", "|").csv(lapsed).collect()] == ["800.000000000"]

    scenario = tmp_path / "scenario.csv"
    lines = ["record_id,donor_name_normalized,donor_address_normalized,zip_normalized"]
    scenario.write_text("\n".join(lines + [",".join(r[:4]) for r in IDENTITY]))
    assert main(["identity", *day, "--fixture", str(scenario)]) == 0
    w = R.Warehouse(root)
    assert tb.read_table(spark, w.dim_donors + "_test", DIM_DONORS).count() == 26

    header = tmp_path / "h.csv"
    header.write_text(",".join(SOURCE_COLUMNS) + "\n")
    plain = write_source(tmp_path / "plain.txt", SOURCE_ROWS, header=False, encoding="latin-1")
    sample = str(tmp_path / "sample")
    assert main(["profile", "--input", plain, "--headers", str(header), "--rows", "4", "--output", sample]) == 0
    assert R.read_source(spark, sample).count() == 4


def test_a_day_sent_again_with_fewer_records(spark, warehouse):
    """Records that are not sent again leave staging, dimension and mart, and the run passes its checks."""
    R.run_day(spark, source_frame(spark, SOURCE_ROWS), DAY, warehouse)
    R.run_day(spark, source_frame(spark, [source_row(50, name="NEW, PERSON")]), DAY_2, warehouse)
    left = [r for r in SOURCE_ROWS if r[-1] not in ("S0001", "S0002")]
    changed = [(*r[:14], "999", *r[15:]) if r[-1] == "S0003" else r for r in left]
    run_id = R.run_day(spark, source_frame(spark, changed), DAY, warehouse)
    assert [s for *_, s in log_of(spark, warehouse, run_id)] == ["PASS"] * 8
    for path, schema in ((warehouse.staging, STAGING), (warehouse.dim_donors, DIM_DONORS)):
        ids = {r["sub_id"] for r in tb.read_table(spark, path, schema).collect()}
        assert ids == {r[-1] for r in left if r[6] == "IND"} | {"S0050"}
    total = tb.read_snapshot(spark, warehouse.mart, MART).agg(F.sum("total_amount"), F.sum("contribution_count")).first()
    assert (int(total[0]), total[1]) == (sum(int(r[14]) for r in changed if r[6] == "IND") + 100, 7)


def test_a_run_adds_one_file_to_the_log_and_files_can_be_joined(spark, warehouse):
    from giftledger.plans.runlog import compact_run_log

    def files():
        return spark.read.parquet(warehouse.run_log).inputFiles()

    R.run_day(spark, source_frame(spark, SOURCE_ROWS), DAY, warehouse)
    assert len(files()) == 1
    with pytest.raises(Q.GateFailed):
        R.run_day(spark, source_frame(spark, [source_row(1, zip_code="")]), DAY_2, warehouse)
    assert len(files()) == 2
    before = log_of(spark, warehouse)
    assert len(before) == 10 and before[-1][-1] == "FAIL"
    compact_run_log(spark, warehouse.run_log)
    assert len(files()) == 1 and log_of(spark, warehouse) == before


def test_unknown_columns_are_kept_and_breaking_changes_fail(spark, warehouse):
    from giftledger.operators.staging import unknown_values
    from giftledger.schemas import RAW_STORED

    plain = source_frame(spark, SOURCE_ROWS[:3])
    R.ingest_raw(spark, plain, DAY, warehouse.raw)
    grown = plain.withColumns({"a.b": F.lit("x"), "UNKNOWN_COLUMNS": F.lit(7), "nested": F.struct(F.lit(1).alias("n")), "none": F.lit(None).cast("date")})
    R.ingest_raw(spark, grown, DAY_2, warehouse.raw)
    stored = tb.read_table(spark, warehouse.raw, RAW_STORED)
    assert stored.where(F.col("_load_date") == F.lit(DAY)).where("unknown_columns IS NULL").count() == 3
    values = unknown_values(stored).where("SUB_ID = 'S0001'").collect()
    assert {(r["_load_date"], r["column_name"], r["value"]) for r in values} == {
        (DAY_2, "a.b", "x"), (DAY_2, "UNKNOWN_COLUMNS", "7"), (DAY_2, "nested", '{"n":1}'), (DAY_2, "none", None)
    }
    recorded = {(r["load_date"], r["column_name"], r["column_type"]) for r in tb.unknown_columns(spark, warehouse.raw).collect()}
    assert recorded == {(DAY_2, "a.b", "string"), (DAY_2, "UNKNOWN_COLUMNS", "int"), (DAY_2, "nested", "struct<n:int>"), (DAY_2, "none", "date")}
    # The fixed columns are read as before; a day sent again without the columns loses its record of them.
    assert tb.read_table(spark, warehouse.raw, RAW).columns == RAW.fieldNames()
    R.ingest_raw(spark, plain, DAY_2, warehouse.raw)
    assert tb.unknown_columns(spark, warehouse.raw).count() == 0
    for broken in (plain.drop("ZIP_CODE"), plain.withColumn("TRANSACTION_AMT", F.lit("ten"))):
        with pytest.raises(PySparkException, match="ZIP_CODE|not a decimal"):
            R.ingest_raw(spark, broken, DAY, warehouse.raw)
    assert tb.read_table(spark, warehouse.raw, RAW).count() == 6

from datetime import date

import pytest
from giftledger.schemas import DIM_DONORS, LOAD_DATE, RAW, SOURCE_COLUMNS
from giftledger.sources import delimited as D
from giftledger.sources import tables as tb
from giftledger.sources.workspace import materialized, path_exists, shared_folder
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from samples import DAY, IDENTITY, SOURCE_ROWS, source_frame

DAY_2 = date(2099, 1, 2)


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_header_file_and_headerless_latin1(spark, tmp_path):
    header = write(tmp_path / "h.csv", "A, B ,C\n")
    data = write(tmp_path / "d.txt", "1|é|\n2||\xa0x\n", "latin-1")
    assert D.header_names(spark, header) == ["A", "B", "C"]
    rows = D.good_rows(D.read_headerless(spark, data, header)).collect()
    assert [tuple(r) for r in rows] == [("1", "é", ""), ("2", "", "\xa0x")]


def test_empty_fields_stay_empty_strings(spark, tmp_path):
    path = write(tmp_path / "d.csv", 'A|B|C\n1||""\n" x"|"a""b"|NA\n')
    rows = D.good_rows(D.read_with_header(spark, path)).collect()
    assert [tuple(r) for r in rows] == [("1", "", ""), (" x", 'a"b', "NA")]


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        D.read_with_header(spark, str(tmp_path / "none.csv"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        D.read_headerless(spark, str(tmp_path / "none.txt"), columns=["A"])


def test_malformed_rows_are_seen_whatever_columns_are_read(spark, tmp_path):
    path = write(tmp_path / "d.txt", "1|2|3\n4|5\n6|7|8|9\n")
    rows = D.read_headerless(spark, path, columns=["A", "B", "C"])
    assert D.good_rows(rows).count() == 1
    assert [r[0] for r in D.good_rows(rows).select("B").collect()] == ["2"]
    assert sorted(r[0] for r in D.malformed_rows(rows).collect()) == ["4|5", "6|7|8|9"]
    with pytest.raises(PySparkException, match="malformed row: 4"):
        D.require_well_formed(rows).select("A").collect()
    assert D.require_well_formed(rows.where("A = '1'")).count() == 1


def test_files_with_another_header_are_an_error(spark, tmp_path):
    write(tmp_path / "a.csv", "A|B\n1|2\n")
    write(tmp_path / "b.csv", "B|A\n1|2\n")
    with pytest.raises(Exception, match="header does not conform"):
        D.read_with_header(spark, str(tmp_path)).collect()


def test_written_text_is_plain_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(" a ", None, 'q"z'), ("", "x|y", "é")], "A string, B string, C string").coalesce(1)
    D.write_delimited(df, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text("utf-8").splitlines()
    assert text[0] == "A|B|C"
    assert text[2] == '|"x|y"|é'
    back = D.good_rows(D.read_with_header(spark, str(tmp_path / "out")))
    assert sorted(tuple(r) for r in back.collect()) == [("", "x|y", "é"), (" a ", "", 'q"z')]


def test_scenario_file(spark, tmp_path):
    lines = ["record_id,extra,donor_name_normalized,donor_address_normalized,zip_normalized"]
    lines += [f"{r},,{n},{a},{z}" for r, n, a, z, _, _ in IDENTITY]
    df = D.read_identity_fixture(spark, write(tmp_path / "s.csv", "\n".join(lines)), DAY)
    rows = {r["sub_id"]: r for r in df.collect()}
    assert len(rows) == 26 and rows["R023"]["zip_normalized"] == "" and rows["R001"][LOAD_DATE] == DAY


def raw_rows(spark, day, rows=SOURCE_ROWS):
    from giftledger.operators.staging import add_load_date, enforce_raw_schema

    return enforce_raw_schema(add_load_date(source_frame(spark, rows), day))


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert tb.ensure_table(spark, path, RAW) and not tb.ensure_table(spark, path, RAW)
    assert tb.read_table(spark, path, RAW).count() == 0

    def counts():
        return {r["load_date"]: r["row_count"] for r in tb.partition_row_count(tb.read_table(spark, path, RAW)).collect()}

    assert tb.overwrite_partition(raw_rows(spark, DAY), path, DAY) == 9
    assert tb.overwrite_partition(raw_rows(spark, DAY_2), path, DAY_2) == 9
    assert tb.overwrite_partition(raw_rows(spark, DAY, SOURCE_ROWS[:4]), path, DAY) == 4
    assert tb.overwrite_partition(raw_rows(spark, DAY, SOURCE_ROWS[:4]), path, DAY) == 4
    assert counts() == {DAY: 4, DAY_2: 9}
    # An empty load empties its own partition and no other.
    assert tb.overwrite_partition(raw_rows(spark, DAY, []), path, DAY) == 0
    assert counts() == {DAY_2: 9}
    one_day = tb.partition_row_count(tb.read_table(spark, path, RAW), DAY).collect()
    assert [tuple(r) for r in one_day] == [(DAY, 0)]


def test_partition_read_is_pruned(spark, tmp_path):
    path = str(tmp_path / "raw")
    tb.overwrite_partition(raw_rows(spark, DAY), path, DAY)
    day = tb.read_partition(spark, path, RAW, DAY)
    assert day.columns == [*SOURCE_COLUMNS, LOAD_DATE]
    plan = day.select("SUB_ID")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_date" in plan
    assert "ReadSchema: struct<SUB_ID:string>" in plan


def test_snapshots_are_seen_only_when_published(spark, tmp_path):
    path = str(tmp_path / "mart")
    schema = DIM_DONORS[:2]
    one = spark.createDataFrame([("d1", "s1")], schema)
    with pytest.raises(FileNotFoundError):
        tb.read_snapshot(spark, path, schema)
    tb.write_snapshot(one, path, "v1")
    tb.publish_snapshot(spark, path, "v1")
    tb.write_snapshot(one.withColumn("donor_id", F.lit("d2")), path, "v2")
    assert [r["donor_id"] for r in tb.read_snapshot(spark, path, schema).collect()] == ["d1"]
    tb.publish_snapshot(spark, path, "v2")
    assert [r["donor_id"] for r in tb.read_snapshot(spark, path, schema).collect()] == ["d2"]


def test_scratch_tables_live_in_the_shared_folder_and_go_away(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    with materialized(spark.range(5), "numbers") as numbers:
        path = numbers.inputFiles()[0].rsplit("/", 1)[0]
        assert path.startswith("file:") and shared_folder(spark) in path
        assert numbers.count() == 5
    assert not path_exists(spark, path)


SESSION = """
import sys
sys.path.insert(0, sys.argv[1])
from giftledger.session import get_session
from giftledger.sources.workspace import release_scratch, scratch_path, session_folder, path_exists
spark = get_session("scratch", "local[1]", spark__ui__enabled="false", **{"spark.checkpoint.dir": sys.argv[2]})
for _ in range(2):
    path = scratch_path(spark, "rows")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    if _ == 0:
        release_scratch(spark)
        assert not path_exists(spark, path)
from giftledger.plans.queries import QUERIES
QUERIES["partition_overwrite"](spark, "/root/testdata/sf0.001").collect()
assert path_exists(spark, session_folder(spark))
spark.stop()
"""


def test_no_scratch_is_left_when_the_driver_ends(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(__file__).resolve().parent.parent)
    subprocess.run([sys.executable, "-c", SESSION, root, str(tmp_path)], check=True, capture_output=True, timeout=300)
    assert not list(tmp_path.glob("giftledger-*"))

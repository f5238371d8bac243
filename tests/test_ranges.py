"""Equal-depth ranges, one scan for all of them, and runs that find damaged or missing files."""

import datetime
import decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_extract import DDL, killed_before_publish, source_of, values_of
from test_footers import damage
from tidemark.operators.marks import equal_depth_cuts, in_ranges, range_number
from tidemark.plans.extract import dump_table
from tidemark.sources.publish import OnConflict, write_parquet
from tidemark.sources.tables import JdbcSource, range_predicates, sql_literal

APPEND = {"on_conflict": OnConflict.APPEND}


def depths(df, cuts):
    found = df.groupBy(range_number(cuts, df).alias("r")).count().collect()
    return [row["count"] for row in sorted(found)]


def test_cuts_are_of_equal_depth_for_any_key(spark):
    ids = spark.range(10_000)
    skewed = ids.selectExpr("if(id < 9000, id, (id - 9000) * 1000) k")
    text = ids.selectExpr("md5(string(id)) k")
    pairs = ids.selectExpr("string(id % 3) k", "id j")
    dates = ids.selectExpr("date_add(date'2020-01-01', cast(id as int)) k")
    for df, keys in ((skewed, ["k"]), (text, ["k"]), (pairs, ["k", "j"]), (dates, ["k"]), (ids, ["id"])):
        cuts = equal_depth_cuts(df, keys, 8)
        found = depths(df, cuts)
        assert len(cuts) == 7 and len(found) == 8 and max(found) <= 2 * min(found), keys
        parts = [in_ranges(df, cuts, [n]).count() for n in range(8)]
        assert parts == found and in_ranges(df, cuts, [0, 7]).count() == found[0] + found[7]
    few = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert equal_depth_cuts(few, ["k"], 5) == [{"k": 2}] and depths(few, [{"k": 2}]) == [3, 1]
    assert equal_depth_cuts(few.where("k = 9"), ["k"], 5) == [] and equal_depth_cuts(few, ["k"], 1) == []


def test_cuts_hold_most_rows_of_large_frames(spark):
    large = spark.range(200_000).selectExpr("sha1(string(id)) k")
    found = depths(large, equal_depth_cuts(large, ["k"], 10))
    assert len(found) == 10 and max(found) <= 2 * min(found)


def test_conditions_for_a_database_are_disjoint_and_complete():
    """The text of the conditions, tried by an embedded engine on a table of its own process."""
    connection = duckdb.connect()
    connection.execute(
        "CREATE TABLE t AS SELECT CASE WHEN i % 7 <> 0 THEN i % 5 END AS a,"
        " CASE WHEN i % 11 <> 0 THEN chr(39) || i % 3 END AS \"b c\" FROM range(400) r(i)"
    )
    cuts = [{"a": 0, "b c": "'2"}, {"a": 2, "b c": "'1"}, {"a": 4, "b c": "'0"}]
    conditions = range_predicates(cuts)
    counts = [connection.execute(f"SELECT count(*) FROM t WHERE {c}").fetchall()[0][0] for c in conditions]
    assert sum(counts) == 400 and all(counts)
    assert connection.execute(f"SELECT count(*) FROM t WHERE {' OR '.join(conditions)}").fetchall()[0][0] == 400
    assert range_predicates([]) == ["1 = 1"]
    assert sql_literal(decimal.Decimal("1.50")) == "1.50" and sql_literal(datetime.date(2020, 1, 2)) == "'2020-01-02'"
    assert sql_literal(True) == "TRUE" and sql_literal(b"\x01\xff") == "X'01ff'"


def test_query_for_cuts_of_a_database(spark):
    """The text of the query, tried by an embedded engine on a table of its own process."""
    source = JdbcSource(spark, "jdbc:postgresql://db.example.com/x")
    connection = duckdb.connect()
    connection.execute("CREATE SCHEMA s")
    connection.execute("CREATE TABLE s.t AS SELECT md5(CAST(i AS VARCHAR)) AS k, i AS j FROM range(1000) r(i)")
    cuts = connection.execute(f"SELECT * FROM {source.cuts_query('s', 't', ['k', 'j'], 8)} ORDER BY k").fetchall()
    assert len(cuts) == 7
    conditions = range_predicates([{"k": k, "j": j} for k, j in cuts])
    counts = [connection.execute(f"SELECT count(*) FROM s.t WHERE {c}").fetchall()[0][0] for c in conditions]
    assert sum(counts) == 1000 and set(counts) == {125}




def test_all_ranges_are_read_by_one_scan(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame(values_of(400), DDL).coalesce(4)
    write_parquet(frame, str(tmp_path / "in"))
    seen = spark.read.parquet(str(tmp_path / "in")).mapInArrow(counted, DDL)
    from tidemark.sources.tables import FrameSource

    source = FrameSource(spark, {("public", "t"): seen}, {("public", "t"): [("PRIMARY KEY", ["id"])]})
    report = dump_table(source, "public", "t", str(tmp_path / "out"), slices=4)
    assert report.checkpoints == 4 and report.rows_read == 400
    # Once for the sample that places the cuts, once for the rows.
    assert calls.value == 800
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(values_of(400), key=repr)


@pytest.mark.parametrize("ddl_key", ["id", "tag"])
def test_a_failing_task_leaves_the_other_ranges_committed(spark, tmp_path, ddl_key):
    values = [(i, f"t{i:05}", i / 2) for i in range(400)]
    keys = [("PRIMARY KEY", [ddl_key])]
    source = source_of(spark, values, keys)
    table = source._tables["public", "t"]
    poisoned = table.withColumn("v", F.when(F.col("id") == 250, F.raise_error(F.lit("gone")).cast("double")).otherwise(F.col("v")))
    source._tables["public", "t"] = poisoned
    output = str(tmp_path / "out")
    with pytest.raises(Exception):
        dump_table(source, "public", "t", output, slices=4)
    working = tmp_path / "local" if (tmp_path / "local").exists() else tmp_path / "db.example.com"
    (checkpoint,) = working.glob("*checkpoint*")
    assert not (checkpoint / "_SUCCESS").exists()
    source._tables["public", "t"] = table
    report = dump_table(source, "public", "t", output, slices=4, **APPEND)
    assert rows(spark.read.parquet(output)) == sorted(values, key=repr)
    assert report.rows_read <= 400 and not working.exists()


def test_missing_and_damaged_ranges_are_read_again(spark, tmp_path, monkeypatch):
    values = values_of(300)
    killed_before_publish(spark, tmp_path, monkeypatch, source_of(spark, values), slices=3)
    checkpoint = tmp_path / "db.example.com" / "public.t.checkpoint_00000"
    files = sorted(checkpoint.glob("part-*"))
    assert len(files) > 3
    damage(files[1])
    files[2].unlink()
    report = dump_table(source_of(spark, values), "public", "t", str(tmp_path / "out"), slices=5, **APPEND)
    assert 0 < report.rows_read < 300 and [p.rsplit("/", 1)[1] for p in report.unreadable] == [files[1].name]
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(values, key=repr)


@pytest.mark.parametrize("keys", [[("PRIMARY KEY", ["id"])], [("UNIQUE", ["tag"])], []])
def test_a_damaged_plain_checkpoint_is_read_again(spark, tmp_path, keys):
    working = tmp_path / "db.example.com"
    values = values_of(60) if not keys or keys[0][0] == "PRIMARY KEY" else [(i, f"t{i:03}" if i > 8 else None, 0.0) for i in range(60)]
    for number, part in enumerate((values[:20], values[20:40])):
        write_parquet(spark.createDataFrame(part, DDL).coalesce(1), str(working / f"public.t.checkpoint_{number:05}"))
    if not keys:
        damage(next((working / "public.t.checkpoint_00000").glob("part-*")))
    else:
        damage(next((working / "public.t.checkpoint_00001").glob("part-*")), keep=0.6)
    report = dump_table(source_of(spark, values, keys), "public", "t", str(tmp_path / "out"), **APPEND)
    assert len(report.unreadable) == 1
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(values, key=repr)


@pytest.mark.parametrize("incremental", [False, True])
@pytest.mark.parametrize("all_files", [False, True])
def test_an_output_with_damaged_files_is_read_again(spark, tmp_path, incremental, all_files):
    output = tmp_path / "out"
    dump_table(source_of(spark, values_of(400)), "public", "t", str(output), slices=4)
    files = sorted(output.glob("part-*"))
    for file in files if all_files else files[:1]:
        damage(file)
    report = dump_table(source_of(spark, values_of(410)), "public", "t", str(output), incremental=incremental, **APPEND)
    assert report.rows_read == 410 and report.resumed_after is None and len(report.unreadable) == (len(files) if all_files else 1)
    assert rows(spark.read.parquet(str(output))) == sorted(values_of(410), key=repr)


def test_a_damaged_output_beside_checkpoints_of_an_incremental_run(spark, tmp_path, monkeypatch):
    """The checkpoints hold only what came after the output's mark: with the output gone all is read again."""
    output = tmp_path / "out"
    dump_table(source_of(spark, values_of(50)), "public", "t", str(output))
    killed_before_publish(spark, tmp_path, monkeypatch, source_of(spark, values_of(80)), incremental=True, **APPEND)
    for file in output.glob("part-*"):
        damage(file)
    report = dump_table(source_of(spark, values_of(80)), "public", "t", str(output), incremental=True, **APPEND)
    assert report.rows_read == 80 and report.unreadable
    assert rows(spark.read.parquet(str(output))) == sorted(values_of(80), key=repr)


def test_ranges_of_a_resumed_run_start_after_the_mark(spark, tmp_path, monkeypatch):
    """Killed after a first run and again after a second one, which found more rows: nothing is lost or doubled."""
    killed_before_publish(spark, tmp_path, monkeypatch, source_of(spark, values_of(100)), slices=3)
    killed_before_publish(spark, tmp_path, monkeypatch, source_of(spark, values_of(160)), slices=3, **APPEND)
    second = tmp_path / "db.example.com" / "public.t.checkpoint_00001"
    for file in sorted(second.glob("part-*"))[:1]:
        file.unlink()
    (second / "_SUCCESS").unlink()
    report = dump_table(source_of(spark, values_of(200)), "public", "t", str(tmp_path / "out"), slices=2, **APPEND)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(values_of(200), key=repr)
    assert report.rows_read < 100

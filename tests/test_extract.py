import datetime
import json

import pytest
from pyspark.sql import functions as F, types as T

from helpers import rows
from tidemark.errors import ConflictError, EmptySourceError, MissingTableError
from tidemark.operators.catalog import collect_keys, find_table, pick_longest, unique_keys
from tidemark.plans.extract import TableKeys, dump_table, resolve_keys, resolve_schema, unique_by_table_keys
from tidemark.sources.parquet import scan_checkpoints
from tidemark.sources.publish import OnConflict, read_metadata, write_parquet
from tidemark.sources.tables import (
    CONSTRAINTS_COLUMNS,
    KEY_COLUMNS_COLUMNS,
    FrameSource,
    JdbcSource,
    even_boundaries,
    qualified_name,
    range_slices,
)

DDL = "id int, tag string, v double"


def source_of(spark, values, keys=(("PRIMARY KEY", ["id"]),), ddl=DDL):
    return FrameSource(
        spark, {("public", "t"): spark.createDataFrame(values, ddl)}, {("public", "t"): list(keys)}, host="db.example.com"
    )


def values_of(n, start=0):
    return [(i, f"t{i % 5}", i / 2) for i in range(start, n)]


def test_keys_from_the_catalog(spark):
    constraints = spark.createDataFrame(
        [
            ("s", "pk", "s", "t", "PRIMARY KEY"),
            ("s", "uq", "s", "t", "UNIQUE"),
            ("s", "fk", "s", "t", "FOREIGN KEY"),
            ("s", "ck", "s", "t", "CHECK"),
            ("o", "pk", "o", "t", "PRIMARY KEY"),
        ],
        CONSTRAINTS_COLUMNS,
    )
    usage = spark.createDataFrame(
        [
            ("s", "uq", "s", "t", "c", 3),
            ("s", "uq", "s", "t", "a", 1),
            ("s", "uq", "s", "t", "b", 2),
            ("s", "pk", "s", "t", "id", 1),
            ("s", "fk", "s", "t", "a", 1),
            ("o", "pk", "o", "t", "other", 1),
        ],
        KEY_COLUMNS_COLUMNS,
    )
    keys = unique_keys(constraints, usage, "t", "s")
    assert collect_keys(keys) == [("PRIMARY KEY", ("id",)), ("UNIQUE", ("a", "b", "c"))]
    assert pick_longest([("a", "b"), ("c", "d"), ("e",)]) == ("a", "b") and pick_longest([]) is None


def test_table_lookup_uses_the_schema(spark):
    tables = spark.createDataFrame([("a", "t"), ("b", "t"), ("b", "u")], "table_schema string, table_name string")
    assert find_table(tables, "t") == ("a", "t") and find_table(tables, "t", "b") == ("b", "t")
    with pytest.raises(MissingTableError, match="a.u"):
        find_table(tables, "u", "a")


def test_dump_publishes_sorted_unique_rows(spark, tmp_path):
    output = str(tmp_path / "out")
    report = dump_table(source_of(spark, values_of(100) + values_of(20)), "public", "t", output, slices=3)
    assert report.rows_read == 120 and report.checkpoints == 3 and report.resumed_after is None
    result = spark.read.parquet(output)
    assert rows(result) == sorted(values_of(100), key=repr)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out"]  # no working data


def test_conflicts(spark, tmp_path):
    output = str(tmp_path / "out")
    dump_table(source_of(spark, values_of(5)), "public", "t", output)
    with pytest.raises(ConflictError):
        dump_table(source_of(spark, values_of(9)), "public", "t", output)
    dump_table(source_of(spark, [(1, "new", 0.0)]), "public", "t", output, on_conflict=OnConflict.OVERWRITE)
    assert rows(spark.read.parquet(output)) == [(1, "new", 0.0)]
    dump_table(source_of(spark, values_of(3)), "public", "t", output, on_conflict=OnConflict.APPEND)
    # Row 1 was read again: its new state replaces the one in the output.
    assert rows(spark.read.parquet(output)) == sorted(values_of(3), key=repr)


def test_leftover_work_is_a_conflict_too(spark, tmp_path):
    output = str(tmp_path / "out")
    leftover = str(tmp_path / "db.example.com" / "public.t.checkpoint_00000")
    write_parquet(spark.createDataFrame(values_of(3), DDL), leftover)
    with pytest.raises(ConflictError):
        dump_table(source_of(spark, values_of(5)), "public", "t", output)
    dump_table(source_of(spark, [(7, "x", 1.0)]), "public", "t", output, on_conflict=OnConflict.OVERWRITE)
    assert rows(spark.read.parquet(output)) == [(7, "x", 1.0)]


@pytest.mark.parametrize("slices", [1, 4])
def test_resume_after_an_interruption(spark, tmp_path, slices):
    """A committed range stays, an uncommitted one is read again, nothing is lost or doubled."""
    output, working = str(tmp_path / "out"), tmp_path / "db.example.com"
    write_parquet(
        spark.createDataFrame(values_of(40), DDL), str(working / "public.t.checkpoint_00000")
    )
    write_parquet(spark.createDataFrame(values_of(45, 40), DDL), str(working / "public.t.checkpoint_00001"))
    (working / "public.t.checkpoint_00001" / "_SUCCESS").unlink()
    assert scan_checkpoints(spark, str(working / "public.t")).count() == 40
    report = dump_table(
        source_of(spark, values_of(100)), "public", "t", output, on_conflict=OnConflict.APPEND, slices=slices
    )
    assert report.resumed_after == {"id": 39} and report.rows_read == 60
    assert rows(spark.read.parquet(output)) == sorted(values_of(100), key=repr)
    assert not working.exists()


def test_incremental_append_reads_new_rows_only(spark, tmp_path):
    output = str(tmp_path / "out")
    dump_table(source_of(spark, values_of(10)), "public", "t", output)
    options = {"on_conflict": OnConflict.APPEND, "incremental": True}
    report = dump_table(source_of(spark, values_of(15)), "public", "t", output, **options)
    assert report.rows_read == 5 and report.resumed_after == {"id": 9}
    assert spark.read.parquet(output).count() == 15
    with pytest.raises(EmptySourceError):
        dump_table(source_of(spark, values_of(15)), "public", "t", output, **options)
    assert spark.read.parquet(output).count() == 15


def test_incremental_append_keeps_rows_with_null_keys(spark, tmp_path):
    output = str(tmp_path / "out")
    keys = [("UNIQUE", ["id", "tag"])]
    first = [(1, "a", 1.0), (1, None, 2.0), (None, "x", 3.0)]
    second = first + [(1, None, 9.0), (2, None, 4.0), (None, "x", 5.0)]
    dump_table(source_of(spark, first, keys), "public", "t", output)
    dump_table(
        source_of(spark, second, keys), "public", "t", output, on_conflict=OnConflict.APPEND, incremental=True
    )
    assert rows(spark.read.parquet(output)) == sorted(second, key=repr)


def killed_before_publish(spark, tmp_path, monkeypatch, source, **options):
    """A run that commits its checkpoints and ends before it publishes."""
    import tidemark.plans.extract as extract

    def stop(*args, **more):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(extract, "post_process", stop)
        with pytest.raises(KeyboardInterrupt):
            dump_table(source, "public", "t", str(tmp_path / "out"), **options)


@pytest.mark.parametrize("keys", [(), [("PRIMARY KEY", ["id"])], [("UNIQUE", ["id", "tag"])], [("UNIQUE", ["tag"])]])
@pytest.mark.parametrize("slices", [(1, 1), (3, 2), (2, 4)])
def test_a_run_killed_before_publishing_is_resumed_row_by_row(spark, tmp_path, monkeypatch, keys, slices):
    values = [(k, None if k % 3 else f"t{k}", float(k)) for k in range(1, 11)]
    if not keys or "tag" in keys[0][1]:
        values += [(4, None, 4.0), (4, None, 4.0)]
    killed_before_publish(spark, tmp_path, monkeypatch, source_of(spark, values, keys), slices=slices[0])
    report = dump_table(
        source_of(spark, values, keys), "public", "t", str(tmp_path / "out"), on_conflict=OnConflict.APPEND, slices=slices[1]
    )
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(values, key=repr)
    assert report.rows_read == 0


def test_equal_rows_with_null_keys_stay_and_reappear_once(spark, tmp_path):
    output, keys = str(tmp_path / "out"), [("UNIQUE", ["tag"])]
    values = [(1, None, 1.0), (1, None, 1.0), (2, "a", 2.0)]
    dump_table(source_of(spark, values, keys), "public", "t", output)
    assert rows(spark.read.parquet(output)) == sorted(values, key=repr)
    dump_table(source_of(spark, values, keys), "public", "t", output, on_conflict=OnConflict.APPEND)
    assert rows(spark.read.parquet(output)) == sorted(values, key=repr)


def test_empty_source(spark, tmp_path):
    with pytest.raises(EmptySourceError):
        dump_table(source_of(spark, []), "public", "t", str(tmp_path / "out"))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == []
    with pytest.raises(MissingTableError):
        dump_table(source_of(spark, []), "public", "u", str(tmp_path / "out"))


def test_table_without_keys_keeps_every_row(spark, tmp_path):
    output = str(tmp_path / "out")
    report = dump_table(source_of(spark, values_of(5) * 2, ()), "public", "t", output, slices=3)
    assert report.checkpoints == 1 and spark.read.parquet(output).count() == 10


def test_configured_schema_wins_and_travels(spark, tmp_path):
    config = {
        "fields": [
            {"name": "id", "datatype": "uint8", "metadata": {"long_name": "Id"}},
            {"name": "v", "datatype": "float32"},
            {"name": "absent", "datatype": "string"},
        ],
        "metadata": {"title": "T"},
    }
    (tmp_path / "config").mkdir()
    (tmp_path / "config" / "public.t.json").write_text(json.dumps(config, indent=2))
    source, output = source_of(spark, values_of(4)), str(tmp_path / "out")
    reflected = resolve_schema(source, "public", "t", str(tmp_path))
    assert [f.name for f in reflected.fields] == ["id", "tag", "v"]
    dump_table(source, "public", "t", output, config_dir=str(tmp_path / "config"))
    result = spark.read.parquet(output)
    assert result.dtypes == [("id", "smallint"), ("v", "float"), ("absent", "string")]
    assert result.schema["id"].metadata == {"long_name": "Id"} and read_metadata(spark, output) == {"title": "T"}


class SplittingSource(FrameSource):
    """Records the ranges that a database would be asked for."""

    splits_reads = True

    def scan(self, schema_name, table_name, fetch_rows=0, split_on=None, split_range=(None, None)):
        self.asked = [*getattr(self, "asked", []), (split_on, *split_range)]
        return super().scan(schema_name, table_name)


def test_each_range_is_split_on_its_own(spark, tmp_path):
    output = str(tmp_path / "out")
    frames = {("public", "t"): spark.createDataFrame(values_of(101), DDL)}
    keys = {("public", "t"): [("PRIMARY KEY", ["id"])]}
    source = SplittingSource(spark, frames, keys)
    dump_table(source, "public", "t", output, slices=4)
    ranges = [asked for asked in source.asked if asked[0]]
    assert ranges == [("id", 0, 25), ("id", 25, 50), ("id", 50, 75), ("id", 75, 100)]
    source = SplittingSource(spark, frames, keys)
    write_parquet(spark.createDataFrame(values_of(61), DDL), str(tmp_path / "local" / "public.t.checkpoint_00000"))
    report = dump_table(
        source, "public", "t", output, on_conflict=OnConflict.APPEND, boundaries=[40, 80], fetch_rows=1
    )
    assert [asked for asked in source.asked if asked[0]] == [("id", 60, 80), ("id", 80, 100)]
    assert report.rows_read == 40 and rows(spark.read.parquet(output)) == sorted(values_of(101), key=repr)


def test_keys_can_be_given(spark, tmp_path):
    output = str(tmp_path / "out")
    source = source_of(spark, values_of(5) * 2, ())
    dump_table(source, "public", "t", output, keys=TableKeys((("id",),)))
    assert spark.read.parquet(output).count() == 5


def test_several_keys(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, None, 4.0), (4, None, 4.0)], DDL)
    both = unique_by_table_keys(df, TableKeys((("id",), ("tag",)), frozenset({"tag"})))
    assert rows(both) == [(1, "a", 1.0), (3, None, 4.0), (4, None, 4.0)]
    source = FrameSource(
        spark, {("public", "t"): df}, {("public", "t"): [("UNIQUE", ["tag", "id"]), ("PRIMARY KEY", ["id"])]}
    )
    keys = resolve_keys(source, "public", "t")
    assert keys.keys == (("id",), ("tag", "id")) and keys.longest == ("tag", "id")
    assert keys.nullable == frozenset({"tag"})


def test_slices_cover_everything_once(spark):
    df = spark.range(100).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"))
    for cuts in ([], [50], even_boundaries(1, 99, 7)):
        parts = [df if c is None else df.filter(c) for c in range_slices("k", cuts, T.LongType())]
        assert len(parts) == len(cuts) + 1 and sum(p.count() for p in parts) == 100
    days = even_boundaries(datetime.date(2020, 1, 1), datetime.date(2020, 1, 11), 5)
    assert days[0] == datetime.date(2020, 1, 3) and len(days) == 4
    assert even_boundaries(None, None, 4) == [] and even_boundaries(3, 3, 4) == []


def test_jdbc_options(spark):
    """Options only: no database may be started here, so the reads themselves are not run."""
    source = JdbcSource(
        spark, "jdbc:postgresql://www.db.example.com:5432/x", {"user": "u"}, partitions=32
    )
    assert source.host == "db.example.com"
    options = source.options(qualified_name("public", 'odd"name'), 1000)
    assert options["dbtable"] == '"public"."odd""name"' and options["fetchsize"] == "1000"
    assert options["preferTimestampNTZ"] == "true" and options["user"] == "u"
    assert source.options("t")["fetchsize"] == "50000"
    plain = source.scan_options("public", "t")
    assert "partitionColumn" not in plain and "partitionColumn" not in source.scan_options("public", "t", 9, "id")
    split = source.scan_options("public", "t", 9, "id", (1, 900))
    assert {k: v for k, v in split.items() if k not in source.options("t")} == {"partitionColumn": '"id"', "lowerBound": "1", "upperBound": "900", "numPartitions": "32"}
    assert source.bounds_query("s", "t", "k") == '(SELECT MIN("k") AS low, MAX("k") AS high FROM "s"."t") bounds'

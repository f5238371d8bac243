import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.errors import ConflictError, NothingToMergeError
from tidemark.plans.attempts import attempt, attempt_catalog
from tidemark.plans.merge import merge_frame, merge_inputs, merge_parquet
from tidemark.schema import parse_configured_schema
from tidemark.session import scratch_path, shared_dir, shuffle_partitions_for
from tidemark.sources import publish as publishing
from tidemark.sources.parquet import find_inputs, scan_parquet
from tidemark.sources.publish import (
    OnConflict,
    check_conflict,
    publish,
    read_metadata,
    recover,
    swap_in,
    write_parquet,
)
from tidemark.sources.storage import Storage


def save(spark, path, values, ddl="k int, v string"):
    spark.createDataFrame(values, ddl).coalesce(1).write.parquet(str(path))
    return str(path)


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_partition_sizing():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 2**40, 4000) == 409_600


def test_find_inputs(spark, tmp_path, caplog):
    a, b = save(spark, tmp_path / "a.parquet", [(1, "x")]), save(spark, tmp_path / "b.parquet", [(2, "y")])
    (tmp_path / "_hidden.parquet").mkdir()
    found = find_inputs(spark, [tmp_path / "b.parquet", str(tmp_path / "*.parquet"), str(tmp_path / "none"), 5])
    assert [p.rsplit("/", 1)[1] for p in found] == ["b.parquet", "a.parquet"]
    assert "does not exist" in caplog.text and "not a path" in caplog.text
    assert rows(scan_parquet(spark, found)) == [(1, "x"), (2, "y")]
    assert a != b


def test_scan_checks_every_schema(spark, tmp_path):
    first = save(spark, tmp_path / "1", [(1, "x")])
    more = save(spark, tmp_path / "2", [("y", 2, True)], "v string, k bigint, extra boolean")
    less = save(spark, tmp_path / "3", [(3,)], "k int")
    assert rows(scan_parquet(spark, [first, more])) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="lacks the columns"):
        scan_parquet(spark, [first, less])
    assert rows(scan_parquet(spark, [less, first])) == [(1,), (3,)]
    with pytest.raises(FileNotFoundError):
        scan_parquet(spark, [])


def test_merge_inputs_rules(spark, tmp_path):
    one = save(spark, tmp_path / "one", [(1, "x")])
    target = str(tmp_path / "target")
    with pytest.raises(FileNotFoundError):
        merge_inputs(spark, [str(tmp_path / "missing*")], target)
    with pytest.raises(NothingToMergeError):
        merge_inputs(spark, [one], target)
    save(spark, target, [(0, "t")])
    assert [p.rsplit("/", 1)[1] for p in merge_inputs(spark, [one], target)] == ["target", "one"]
    with pytest.raises(NothingToMergeError):
        merge_inputs(spark, [target], target)


def test_merge_strategies(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "k int, v string")
    assert merge_frame(df).count() == 3
    assert merge_frame(df, enforce_unique=True).count() == 2
    assert rows(merge_frame(df, ["k"])) == [(1, "x")]
    assert rows(merge_frame(df, ["k"])) == [(1, "x")]
    assert merge_frame(df, enforce_unique=True).count() == 2


def test_merge_into_an_input(spark, tmp_path):
    target = save(spark, tmp_path / "t", [(2, "b"), (1, "a"), (None, "n")])
    other = save(spark, tmp_path / "o", [(3, "c"), (2, "a")])
    for _ in range(2):  # merging again changes nothing
        merge_parquet(spark, [target, other], target, keys=["k"])
        assert [tuple(r) for r in spark.read.parquet(target).collect()] == [
            (1, "a"),
            (2, "a"),
            (3, "c"),
            (None, "n"),
        ]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["o", "t"]


def test_merge_applies_schema_and_carries_metadata(spark, tmp_path):
    schema = parse_configured_schema(
        '{"fields": [{"name": "v", "datatype": "string", "metadata": {"long_name": "V"}},'
        ' {"name": "k", "datatype": "uint8"}], "metadata": {"title": "T", "n": 3}}'
    )
    a, b = save(spark, tmp_path / "a", [(1, "x")]), save(spark, tmp_path / "b", [(200, "y")])
    target = str(tmp_path / "t")
    merge_parquet(spark, [a, b], target, schema=schema, order="files")
    result = spark.read.parquet(target)
    assert result.schema["v"].metadata == {"long_name": "V"} and result.dtypes == [("v", "string"), ("k", "smallint")]
    assert read_metadata(spark, target) == {"title": "T", "n": 3}
    again = str(tmp_path / "u")
    merge_parquet(spark, [target, target + "/*.parquet"], again, enforce_unique=True)
    assert read_metadata(spark, again) == {"title": "T", "n": 3}
    c = save(spark, tmp_path / "c", [(256, "z")])
    before = rows(spark.read.parquet(target))
    with pytest.raises(Exception, match="uint8"):
        merge_parquet(spark, [target, c], target, schema=schema)
    assert rows(spark.read.parquet(target)) == before  # a failed merge leaves the target as it was
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_global_and_file_order(spark, tmp_path):
    big = spark.range(0, 5000, numPartitions=4).selectExpr("5000 - id AS k", "id AS v")
    big.write.parquet(str(tmp_path / "a"))
    big.limit(10).write.parquet(str(tmp_path / "b"))
    merge_parquet(spark, [str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path / "g"), keys=["k"])
    written = spark.read.parquet(str(tmp_path / "g"))
    assert sorted(r[0] for r in written.select("k").collect()) == list(range(1, 5001))
    ranges = (
        written.groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.min("k").alias("low"), F.max("k").alias("high"))
        .orderBy("file")
        .collect()
    )
    assert all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))
    with pytest.raises(ValueError):
        merge_parquet(spark, [str(tmp_path / "*")], str(tmp_path / "g"), order="other")


def test_compression_level_is_honoured(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    storage = Storage(spark)
    for level in (1, 19):
        write_parquet(df, str(tmp_path / str(level)), level=level)
    assert storage.size(str(tmp_path / "19")) < storage.size(str(tmp_path / "1"))
    write_parquet(df, str(tmp_path / "snappy"), codec="snappy", level=None, max_records_per_file=1000)
    assert len(list((tmp_path / "snappy").glob("*.snappy.parquet"))) >= 6


def test_conflict_policies(spark, tmp_path):
    storage = Storage(spark)
    path = save(spark, tmp_path / "x", [(1, "a")])
    check_conflict(storage, OnConflict.ERROR, str(tmp_path / "free"))
    with pytest.raises(ConflictError):
        check_conflict(storage, OnConflict.ERROR, str(tmp_path / "free"), path)
    for policy in (OnConflict.APPEND, OnConflict.OVERWRITE):
        check_conflict(storage, policy, path)


def test_interrupted_swap_is_undone(spark, tmp_path):
    storage = Storage(spark)
    target = save(spark, tmp_path / "t", [(1, "old")])
    storage.rename(target, str(tmp_path / "_previous_t"))  # stopped between the two renames
    recover(storage, target)
    assert rows(spark.read.parquet(target)) == [(1, "old")]
    staged = save(spark, tmp_path / "s", [(2, "new")])
    save(spark, tmp_path / "_previous_t", [(0, "older")])  # stopped before the clean-up
    swap_in(storage, staged, target)
    assert rows(spark.read.parquet(target)) == [(2, "new")]
    assert not storage.exists(str(tmp_path / "_previous_t"))


def test_failed_swap_keeps_the_target(spark, tmp_path):
    target = save(spark, tmp_path / "t", [(1, "old")])
    with pytest.raises(Exception):
        swap_in(Storage(spark), str(tmp_path / "no_such_staging"), target)
    assert rows(spark.read.parquet(target)) == [(1, "old")]


def test_publish_reads_its_own_target(spark, tmp_path):
    target = save(spark, tmp_path / "t", [(1, "a"), (2, "b")])
    publish(spark.read.parquet(target).filter("k > 1"), target, metadata={"n": 1})
    assert rows(spark.read.parquet(target)) == [(2, "b")] and read_metadata(spark, target) == {"n": 1}
    assert read_metadata(spark, str(tmp_path / "none")) == {}


def test_attempts_are_bounded():
    calls = []

    def fail():
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        attempt(fail, 5)
    assert len(calls) == 5
    with pytest.raises(OSError):
        attempt_catalog(fail, 0)
    assert len(calls) == 6  # not a dropped connection: final

    def flaky():
        calls.append(1)
        if len(calls) < 9:
            raise OSError("the server closed the connection unexpectedly")
        return "done"

    assert attempt_catalog(flaky, 0) == "done"


def test_a_second_writer_is_found(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    publish(spark.createDataFrame([(1, "x")], "k int, v string"), target)
    slow = spark.createDataFrame([(2, "mine")], "k int, v string")
    write, calls = publishing.write_parquet, []

    def write_while_another_publishes(df, path, *args, **options):
        write(df, path, *args, **options)
        calls.append(path)
        if len(calls) == 1:
            publish(spark.createDataFrame([(3, "other")], "k int, v string"), target)

    monkeypatch.setattr(publishing, "write_parquet", write_while_another_publishes)
    with pytest.raises(ConflictError, match="another writer"):
        publish(slow, target)
    assert rows(spark.read.parquet(target)) == [(3, "other")]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["target"]

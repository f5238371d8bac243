import datetime
import os
import random

import pytest

from pyspark.sql import functions as F

from helpers import plan_of, rows
from tidemark.operators.dedup import dedup_by_key
from tidemark.sources.publish import write_parquet
from tidemark.sources.storage import Storage
from tidemark.streaming.compaction import Compaction
from tidemark.streaming.distinct import append_distinct, first_per_key

DDL = "k int, v string"


def deliver(spark, folder, values):
    spark.createDataFrame(values, DDL).coalesce(1).write.mode("append").parquet(str(folder))


def compaction_of(spark, tmp_path, **options):
    schema = spark.createDataFrame([], DDL).schema
    options.setdefault("keys", ("k",))
    return Compaction(
        spark,
        str(tmp_path / "in"),
        str(tmp_path / "main"),
        str(tmp_path / "progress"),
        schema,
        **options,
    )


def test_parts_compacted_equal_one_merge(spark, tmp_path):
    generator = random.Random(5)
    parts = [[(generator.randrange(60), generator.choice("abcde")) for _ in range(50)] for _ in range(6)]
    everything = spark.createDataFrame([row for part in parts for row in part], DDL)
    expected = rows(dedup_by_key(everything, ["k"]))
    # Every batch holds one file, and main is rewritten as soon as the runs weigh as much.
    compaction = compaction_of(spark, tmp_path, files_per_batch=1, rewrite_bytes=0)
    for part in parts[:4]:
        deliver(spark, tmp_path / "in", part)
    compaction.drain()
    for part in parts[4:]:
        deliver(spark, tmp_path / "in", part)
    compaction.drain()
    assert rows(spark.read.parquet(compaction.main)) == expected == rows(compaction.current())
    assert compaction.pending() == []
    compaction.drain()  # nothing new
    assert rows(spark.read.parquet(compaction.main)) == expected


def test_runs_wait_until_they_are_worth_a_rewrite(spark, tmp_path):
    compaction = compaction_of(spark, tmp_path, files_per_batch=1)
    schema_rows = [[(1, "b"), (2, "z")], [(1, "a")]]
    for number, values in enumerate(schema_rows):
        compaction._write_run(spark.createDataFrame(values, DDL), number)
    assert len(compaction.pending()) == 2
    assert rows(compaction.current()) == [(1, "a"), (2, "z")]
    compaction._write_run(spark.createDataFrame(schema_rows[1], DDL), 1)  # a repeated batch
    compaction._write_run(spark.createDataFrame([], DDL), 2)
    assert len(compaction.pending()) == 2
    compaction.fold()
    compaction.fold()
    assert rows(spark.read.parquet(compaction.main)) == [(1, "a"), (2, "z")]


def test_main_is_always_an_input(spark, tmp_path):
    spark.createDataFrame([(9, "main")], DDL).write.parquet(str(tmp_path / "main"))
    deliver(spark, tmp_path / "in", [(1, "a"), (9, "other")])
    compaction = compaction_of(spark, tmp_path)
    compaction.drain()
    assert rows(spark.read.parquet(compaction.main)) == [(1, "a"), (9, "main")]


def test_without_keys_rows_are_unique(spark, tmp_path):
    deliver(spark, tmp_path / "in", [(1, "a"), (1, "a"), (1, "b")])
    deliver(spark, tmp_path / "in", [(1, "b")])
    compaction = compaction_of(spark, tmp_path, keys=(), files_per_batch=1)
    compaction.drain()
    assert rows(spark.read.parquet(compaction.main)) == [(1, "a"), (1, "b")]


def test_continuous_query(spark, tmp_path):
    deliver(spark, tmp_path / "in", [(1, "a")])
    compaction = compaction_of(spark, tmp_path)
    query = compaction.start("1 second")
    try:
        query.processAllAvailable()
        deliver(spark, tmp_path / "in", [(2, "b"), (1, "0")])
        compaction.finish(query)
    finally:
        query.stop()
    assert rows(spark.read.parquet(compaction.main)) == [(1, "0"), (2, "b")]


def test_leftover_runs_are_merged_first(spark, tmp_path):
    compaction = compaction_of(spark, tmp_path)
    compaction._write_run(spark.createDataFrame([(5, "left")], DDL), 0)
    deliver(spark, tmp_path / "in", [(6, "new")])
    compaction.drain()  # its first batch is number 0 again
    assert rows(spark.read.parquet(compaction.main)) == [(5, "left"), (6, "new")]


@pytest.mark.parametrize("files", [1, 10])
def test_stateful_distinct(spark, tmp_path, files):
    for values in ([(1, "a"), (2, "a")], [(1, "b"), (3, "c"), (3, "d")]):
        deliver(spark, tmp_path / "in", values)
    schema = spark.createDataFrame([], DDL).schema

    def stream():
        return (
            spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
        )

    for _ in range(2):  # the same progress folder: the second run adds nothing
        found = append_distinct(spark, stream(), ["k"], str(tmp_path / "out"), str(tmp_path / "state"))
        assert sorted(r["k"] for r in found.collect()) == [1, 2, 3]
    deliver(spark, tmp_path / "in", [(3, "z"), (4, "e")])
    found = append_distinct(spark, stream(), ["k"], str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r["k"] for r in found.collect()) == [1, 2, 3, 4]


def states(folder):
    return {p.name: p.stat().st_mtime_ns for p in folder.glob("part-*")}


@pytest.mark.parametrize("keys", [("k",), ("v", "k")])
def test_a_fold_rewrites_only_ranges_it_touches(spark, tmp_path, keys):
    compaction = compaction_of(spark, tmp_path, keys=keys, file_bytes=1_000)
    main = tmp_path / "main"
    first = [(k, f"v{k:05}") for k in range(2_000)]
    compaction._write_run(spark.createDataFrame(first, DDL), 0)
    compaction._write_run(spark.createDataFrame(first[:5], DDL), 1)
    compaction.fold()
    before = states(main)
    assert len(before) > 5
    compaction._write_run(spark.createDataFrame([(1_000, "v01000"), (1_001, "a")], DDL).coalesce(1), 2)
    compaction.fold()
    after = states(main)
    kept = {name for name, state in before.items() if after.get(name) == state}
    assert len(before) - len(kept) <= 2 and len(after) <= len(before) + 1
    everything = spark.createDataFrame(first + [(1_001, "a")], DDL)
    assert rows(spark.read.parquet(str(main))) == rows(dedup_by_key(everything, list(keys)))
    # Ranges do not overlap, and each file is in order.
    bounds = sorted(tuple(r) for r in spark.read.parquet(str(main)).groupBy(F.input_file_name()).agg(*[F.min(F.struct(*keys)), F.max(F.struct(*keys))]).drop("input_file_name()").collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_ranges_are_dealt_and_made_unique_by_one_exchange(spark, tmp_path, monkeypatch):
    plans = []

    def kept(df, path, *args, **options):
        plans.append(plan_of(df))
        write_parquet(df, path, *args, **options)

    compaction = compaction_of(spark, tmp_path, file_bytes=512)
    values = [(k, "abc"[k % 3]) for k in range(400)]
    deliver(spark, tmp_path / "in", values)
    compaction.drain()
    deliver(spark, tmp_path / "in", [(k, "a") for k in range(300, 500)])
    monkeypatch.setattr("tidemark.streaming.compaction.write_parquet", kept)
    compaction.drain()
    assert [plan.count("Exchange") for plan in plans if "__unit" in plan] == [1]
    expected = dedup_by_key(spark.createDataFrame(values + [(k, "a") for k in range(300, 500)], DDL), ["k"])
    assert rows(spark.read.parquet(compaction.main)) == rows(expected)


def test_null_keys_and_growth_of_a_ranged_main(spark, tmp_path):
    compaction = compaction_of(spark, tmp_path, file_bytes=1_000)
    given = []
    for number in range(4):
        part = [(k if k % 50 else None, f"v{k}") for k in range(number * 400, number * 1_200 + 400)]
        given += part
        compaction._write_run(spark.createDataFrame(part, DDL), number)
        compaction.fold()
        assert rows(spark.read.parquet(compaction.main)) == rows(dedup_by_key(spark.createDataFrame(given, DDL), ["k"]))


@pytest.mark.parametrize("done", [0, 1, 2])
def test_an_interrupted_fold_is_completed(spark, tmp_path, monkeypatch, done):
    compaction = compaction_of(spark, tmp_path, file_bytes=1_000)
    first = [(k, f"v{k:05}") for k in range(1_000)]
    compaction._write_run(spark.createDataFrame(first, DDL), 0)
    compaction._write_run(spark.createDataFrame(first[:5], DDL), 1)
    compaction.fold()
    compaction._write_run(spark.createDataFrame([(1, "a"), (999, "a")], DDL), 2)
    calls, rename = [], Storage.rename

    def stop_after(self, source, target):
        if "part-" in source:
            calls.append(source)
            if len(calls) > done:
                raise KeyboardInterrupt
        rename(self, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(Storage, "rename", stop_after)
        if done < 2:
            with pytest.raises(KeyboardInterrupt):
                compaction.fold()
        else:
            compaction.fold()
    compaction.fold()
    expected = [(k, "a" if k in (1, 999) else v) for k, v in first]
    assert rows(spark.read.parquet(compaction.main)) == sorted(expected, key=repr)
    assert compaction.pending() == [] and not [p for p in tmp_path.iterdir() if p.name.startswith(("_fold", "_staging"))]


def test_bounded_state_forgets_old_keys(spark, tmp_path):
    """Hours apart, a horizon of two hours: copies within it are found, and the state stays at the keys of two hours."""
    ddl = "k int, at timestamp"
    start = datetime.datetime(2024, 1, 1)
    for hour in range(8):
        at = start + datetime.timedelta(hours=hour)
        values = [(100 * hour + n, at) for n in range(50)] + [(100 * max(0, hour - 1) + n, at) for n in range(10)]
        spark.createDataFrame(values, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    files = sorted((tmp_path / "in").glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    for number, file in enumerate(files):  # one batch a file, in order of time
        os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))

    def run(output, **options):
        schema = spark.createDataFrame([], ddl).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = (
            first_per_key(stream, ["k"], **options)
            .writeStream.format("parquet")
            .option("path", str(tmp_path / output))
            .option("checkpointLocation", str(tmp_path / f"{output}_state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return sorted(r["k"] for r in spark.read.parquet(str(tmp_path / output)).collect()), sizes

    exact, growing = run("exact")
    bounded, held = run("bounded", event_time="at", horizon="2 hours")
    assert exact == bounded == sorted(100 * hour + n for hour in range(8) for n in range(50))
    assert growing[-1] == 400 and max(held) < 300 and held[-1] < 250
    with pytest.raises(ValueError, match="time of each row"):
        first_per_key(spark.createDataFrame([], DDL), ["k"], horizon="1 hour")

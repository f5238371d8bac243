import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tidemark.operators.dedup import (
    bag_union,
    dedup_by_key,
    dedup_by_keys,
    dedup_sorted,
    distinct_rows,
    necessary_keys,
    profile_keys,
    sorted_by,
)

SCHEMA = "k int, j int, s string, v double"


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(
        [
            (1, 1, "b", 2.0),
            (1, 1, "a", 9.0),
            (1, 1, None, 1.0),
            (None, 1, "x", 1.0),
            (None, 1, "w", 1.0),
            (2, None, "q", None),
            (2, None, "q", 3.0),
            (2, None, "q", None),
        ],
        SCHEMA,
    )


@pytest.mark.parametrize("many", [False, True])
def test_survivor_is_the_smallest_row_with_nulls_last(data, many):
    found = rows(dedup_by_key(data, ["k", "j"], many_per_key=many))
    assert found == sorted([(1, 1, "a", 9.0), (None, 1, "w", 1.0), (2, None, "q", 3.0)], key=repr)


@pytest.mark.parametrize("many", [False, True])
def test_preferred_column_comes_first(data, many):
    found = rows(dedup_by_key(data, ["k"], prefer=["v"], many_per_key=many).filter("k = 1"))
    assert found == [(1, 1, None, 1.0)]


def test_preferred_order_may_descend(data):
    found = rows(dedup_by_key(data, ["k"], prefer=[F.col("v").desc_nulls_last()]).filter("k = 1"))
    assert found == [(1, 1, "a", 9.0)]


def test_null_keys_can_follow_the_unique_rule(data):
    found = rows(dedup_by_key(data, ["k", "j"], null_keys="distinct"))
    assert len(found) == data.count() - 2  # one of key (1, 1) stays; rows with a NULL never conflict


def test_key_columns_only(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    for many in (False, True):
        assert rows(dedup_by_key(df, ["k"], many_per_key=many)) == [(1,), (None,)]


def test_map_column_is_no_obstacle(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"b": 2}), (2, {"c": 3})], "k int, m map<string,int>")
    first = rows(dedup_by_key(df, ["k"], many_per_key=True))
    assert len(first) == 2 and first == rows(dedup_by_key(df.orderBy(F.desc("m.b")), ["k"]))


def test_result_does_not_depend_on_arrival(spark):
    generator = random.Random(7)
    base = [(i % 13, i % 3, generator.choice("abc"), generator.choice([None, 1.0, 2.0])) for i in range(300)]
    results = []
    for _ in range(3):
        generator.shuffle(base)
        df = spark.createDataFrame(base, SCHEMA).repartition(generator.randint(1, 6))
        results += [rows(dedup_by_key(df, ["k"])), rows(dedup_by_key(df, ["k"], many_per_key=True))]
    assert all(result == results[0] for result in results)


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 90_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    assert dedup_by_key(df, ["k"]).count() == 60_001
    ranked = plan_of(dedup_by_key(df, ["k"]))
    below = ranked[ranked.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    smallest = plan_of(dedup_by_key(df, ["k"], many_per_key=True))
    assert "partial_min" in smallest[smallest.index("Exchange hashpartitioning") :]
    assert dedup_by_key(df, ["k"], many_per_key=True).count() == 60_001


def test_field_metadata_survives(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int").withMetadata("v", {"units": "m"})
    for many in (False, True):
        assert dedup_by_key(df, ["k"], many_per_key=many).schema["v"].metadata == {"units": "m"}


def test_supersets_of_a_key_need_no_second_pass(data):
    assert necessary_keys([["a"], ["b", "a"], ["b"], []]) == [("a",), ("b",)]
    df = dedup_by_keys(data, [["k"], ["k", "j"]])
    assert plan_of(df).count("Exchange hashpartitioning") == 1


def test_key_sets_apply_in_turn(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3)], "a int, b int")
    assert rows(dedup_by_keys(df, [["a"], ["b"]])) == [(1, 1), (3, 3)]


def test_sort_puts_nulls_last(data):
    assert [r[0] for r in sorted_by(data.select("k").distinct(), ["k"]).collect()] == [1, 2, None]


def test_distinct_rows(data):
    assert distinct_rows(data).count() == 7


def test_union_is_by_name_and_the_first_fixes_the_schema(spark):
    first = spark.createDataFrame([(1, "a")], "x int, y string")
    second = spark.createDataFrame([("b", 2.0, 2)], "y string, z double, x bigint")
    union = bag_union([first, second])
    assert union.schema == first.schema and rows(union) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="lacks"):
        bag_union([second, first])
    wide = spark.createDataFrame([("c", 2**40)], "y string, x bigint")
    with pytest.raises(Exception, match="column 'x'"):
        bag_union([first, wide]).collect()
    assert rows(bag_union([first, second], strict=False)) == sorted([(1, "a", None), (2, "b", 2.0)], key=repr)


def test_bad_arguments(data):
    with pytest.raises(ValueError):
        dedup_by_key(data, [])
    with pytest.raises(ValueError):
        dedup_by_key(data, ["k"], null_keys="other")
    with pytest.raises(ValueError):
        bag_union([])


def test_nullable_keys_take_one_scan_and_one_shuffle_each(spark, tmp_path):
    spark.createDataFrame([(1, None, 2), (1, None, 2), (1, 3, None)], "a int, b int, c int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for key in (["a", "b"], ["b", "c"], ["a", "c"]):
        df = dedup_by_key(df, key, null_keys="distinct")
    plan = plan_of(df)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 3
    assert df.count() == 2  # of the equal rows one goes by the complete key (a, c)


@pytest.mark.parametrize("null_keys", ["group", "distinct"])
@pytest.mark.parametrize("many", [False, True])
def test_sorted_dedup_equals_dedup_and_sort(data, null_keys, many):
    for keys in (["k"], ["k", "j"], ["s"], ["v", "k"]):
        found = [tuple(r) for r in dedup_sorted(data, keys, null_keys=null_keys, many_per_key=many).collect()]
        assert sorted(found, key=repr) == rows(dedup_by_key(data, keys, null_keys=null_keys))
        at = [data.columns.index(k) for k in keys]
        order = [tuple((r[k] is None, r[k] or 0 if data.columns[k] != "s" else r[k] or "") for k in at) for r in found]
        assert order == sorted(order)


def test_sorted_dedup_exchanges_rows_once(spark):
    df = spark.range(10_000).selectExpr("id % 5000 k", "id v")
    plan = plan_of(dedup_sorted(df, ["k"]))
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan
    assert plan.count("Sort [") == 1


def test_frequent_keys_are_reduced_before_the_exchange(spark):
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, -1, id) k", "id v")
    assert len(profile_keys(df, ["k"]).frequent) == 1
    found = dedup_sorted(df, ["k"])
    plan = plan_of(found)
    assert plan.count("Exchange") == 2 and plan.count("Exchange rangepartitioning") == 1
    assert found.count() == 40_001 and found.first()["k"] == -1
    assert profile_keys(spark.range(1000).selectExpr("id k"), ["k"]).frequent == ()
    assert profile_keys(df.where("false"), ["k"]).frequent == ()


def shown(df):
    """Rows as text: NaN equals NaN there, and zeros of both signs are made equal."""
    return sorted(repr(tuple(row)).replace("-0.0", "0.0") for row in df.collect())


def test_distinct_of_wide_rows_equals_distinct(spark, monkeypatch):
    long = [(k % 40, None if k % 7 == 0 else "x" * (k % 30), float("nan") if k % 5 == 0 else -0.0 if k % 2 else 0.0) for k in range(300)]
    df = spark.createDataFrame(long, "k int, s string, v double")
    for frame in (df, df.where("k = 99"), df.distinct(), df.withColumn("a", F.array(F.struct("s", "v")))):
        assert shown(distinct_rows(frame, wide=True)) == shown(frame.distinct())
    import tidemark.operators.dedup as dedup

    monkeypatch.setattr(dedup, "BROADCAST_DIGESTS", 1)
    assert shown(distinct_rows(df, wide=True)) == shown(df.distinct())


def test_rows_without_an_equal_do_not_travel(spark):
    df = spark.range(1_000).selectExpr("id", "repeat(string(id), 100) s")
    plan = plan_of(distinct_rows(df.union(df.limit(3)), wide=True))
    assert "LeftAnti" in plan and "LeftSemi" in plan
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert len(exchanges) == 1

import datetime

import pytest

from helpers import plan_of, rows
from tidemark.functions.keyset import after_mark
from tidemark.operators.marks import high_water_mark, read_mark, scan_after, scan_after_or_null

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


def test_mark_is_the_largest_key(spark):
    df = spark.createDataFrame([(1, "z"), (3, "a"), (3, "b"), (None, "y"), (3, None)], "a int, b string")
    assert read_mark(df, ["a", "b"]) == {"a": 3, "b": "b"}
    assert read_mark(df, ["b", "a"]) == {"b": "z", "a": 1}


def test_no_mark(spark):
    empty = spark.createDataFrame([], "a int")
    assert read_mark(None, ["a"]) is None
    assert read_mark(empty, ["a"]) is None
    assert read_mark(empty, []) is None
    assert scan_after(empty, None) is empty
    with pytest.raises(ValueError):
        after_mark({})


def test_mark_is_a_top_one_without_shuffle(spark):
    plan = plan_of(high_water_mark(spark.read.parquet(LINEITEM), ["l_orderkey", "l_linenumber"]))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert "l_quantity" not in plan


def test_predicate_equals_tuple_comparison(spark):
    tuples = [(a, b, c) for a in (1, 2, 3) for b in ("x", "y") for c in (1.5, 2.5)]
    df = spark.createDataFrame(tuples, "a int, b string, c double")
    for mark in tuples:
        found = rows(scan_after(df, dict(zip("abc", mark))))
        assert found == sorted((t for t in tuples if t > mark), key=repr)


def test_null_key_parts(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, None), (None, 9)], "a int, b int")
    assert rows(scan_after(df, {"a": 1, "b": 1})) == [(2, None)]
    assert rows(scan_after_or_null(df, {"a": 1, "b": 1})) == sorted([(2, None), (1, None), (None, 9)], key=repr)


def test_predicate_reaches_the_scan(spark):
    df = spark.read.parquet(LINEITEM)
    plan = scan_after(df, {"l_orderkey": 100, "l_linenumber": 2})._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(l_orderkey,100)" in pushed and "GreaterThan(l_linenumber,2)" in pushed


def test_zoneless_time_reaches_the_scan_unshifted(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    mark = read_mark(df.filter("o_orderkey < 100"), ["o_orderdate"])
    after = scan_after(df, mark)
    assert "GreaterThan(o_orderdate," in plan_of(after)
    moment = mark["o_orderdate"]
    assert isinstance(moment, datetime.datetime)
    expected = sum(1 for r in df.select("o_orderdate").collect() if r[0] > moment)
    assert after.count() == expected

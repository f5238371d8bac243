import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import error_text
from tidemark.functions.hosts import url_host
from tidemark.functions.packing import is_fill_collision, pack, scale_factor, unpack
from tidemark.functions.timetext import timestamp_text


def test_hosts(spark):
    cases = {
        "http://www.tide.test": "tide.test",
        "www.gauge.test": "gauge.test",
        "river.test": "river.test",
        "river.test/stations/12?day=3": "river.test",
        "www.river.test:8443": "river.test",
        "https://www.delta.test:8443/a/b": "delta.test",
        "postgresql+psycopg://user:p%40ss@db.example.org:5432/name": "db.example.org",
        "postgresql://user@db-1.example.org/name?x=a@b": "db-1.example.org",
        "postgresql://me:a!#$?c@10.0.0.1:5432/x": "10.0.0.1",
        "example.com?x=a@b": "example.com",
        "http://localhost": "localhost",
        "": None,
        "://": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "url string")
    assert {r[0]: r[1] for r in df.select("url", url_host("url")).collect()} == cases


def test_scale_factor():
    assert [scale_factor(p) for p in (0, 1, 2)] == [1.0, 0.1, 0.01]
    with pytest.raises(ValueError):
        scale_factor(-1)


def test_packing_edges(spark):
    values = [None, float("nan"), 0.125, 0.135, -0.125, -9.99, 1.005, 21474836.0, 0.0, -0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    packed = df.orderBy("i").select(pack(F.col("v")), is_fill_collision(F.col("v"))).collect()
    assert [r[0] for r in packed] == [-999, -999, 12, 14, -12, -999, 100, 2147483600, 0, 0]
    assert [r[1] for r in packed] == [False] * 5 + [True] + [False] * 4


@pytest.mark.parametrize("value", [2.2e7, -2.2e7, float("inf")])
def test_packing_overflow_raises(spark, value):
    with pytest.raises(Exception) as caught:
        spark.createDataFrame([(value,)], "v double").select(pack(F.col("v"))).collect()
    assert "does not fit" in error_text(caught)


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.floats(-1000, 1000, width=32), min_size=1, max_size=50), precision=st.integers(0, 3))
def test_unpack_is_within_half_a_step(spark, values, precision):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    result = df.select("v", unpack(pack(F.col("v"), precision), precision).alias("back")).collect()
    for row in result:
        if row["back"] is not None:
            assert abs(row["v"] - row["back"]) <= scale_factor(precision) / 2 + 1e-9


def test_timestamp_text(spark):
    now = spark.range(1).select(timestamp_text()).first()[0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d\+0000", now)
    fixed = spark.sql("SELECT TIMESTAMP'2024-03-04 05:06:07Z' AS t").select(timestamp_text(F.col("t"))).first()[0]
    assert fixed == "2024-03-04 05:06+0000"

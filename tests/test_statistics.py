import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tidemark.operators.statistics import PERCENTILES, day_statistics, merge_states, statistics_of_state, statistics_state
from tidemark.sources.publish import read_metadata

DDL = "place long, at timestamp, v double"


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(4), rng.randrange(40), rng.choice([1.5, 2.5, 7.0, None, float("nan"), rng.gauss(1e6, 3)])) for _ in range(3_000)]
    df = spark.createDataFrame(rows + [(9, 0, 5.0)], "place long, day int, v double")
    return df.withColumn("at", F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, day % 5 + 366 * (day % 3), day)")).select("place", "at", "v")


def table(df):
    return {tuple(row[:3]): row[3:] for row in df.collect()}


def close(a, b, at):
    if isinstance(a, float):
        return (a is None) == (b is None) and math.isclose(a, b, rel_tol=at, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("deliveries", [1, 2, 5])
def test_merged_deliveries_equal_one_pass(spark, values, exact, deliveries):
    numbered = values.withColumn("n", F.monotonically_increasing_id() % deliveries)
    state = None
    for n in range(deliveries):
        new = statistics_state(numbered.where(F.col("n") == n), "place", "at", "v", exact)
        state = new if state is None else merge_states(state.unionByName(new), "place")
    expected, found = table(day_statistics(values, "place", "at", "v")), table(statistics_of_state(state, "place"))
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        for name, a, b in zip(row.__fields__ if hasattr(row, "__fields__") else range(len(row)), row, found[key]):
            if exact or name not in range(6, 13):
                assert close(a, b, 1e-9), (key, name, a, b)
    if not exact:  # a sketch of few values holds them all: its percentiles are values next to the exact ones
        for key, row in expected.items():
            assert row[3] >= max(found[key][6:13]) and row[5] <= min(found[key][6:13])


def test_empty_states(spark):
    empty = spark.createDataFrame([], DDL)
    for exact in (True, False):
        state = statistics_state(empty, "place", "at", "v", exact)
        assert statistics_of_state(merge_states(state, "place"), "place").collect() == []


def test_published_types_and_metadata(spark):
    schema = registry._published_statistics_schema()
    assert len(schema.fields) == 17 and [f.name for f in schema.fields][6:] == ["max", "mean", "min", *PERCENTILES, "std"]
    found = registry.stats_published(spark, "/root/testdata/sf0.001")
    kinds = dict(found.dtypes)
    assert [kinds[n] for n in ("location_id", "month_nu", "day_nu", "count_nu", "p05", "std")] == ["bigint", "smallint", "smallint", "int", "float", "float"]
    assert found.schema["count_nu"].metadata["units"] == "1"
    path = found.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert read_metadata(spark, path)["frequency"] == "P0D"

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from helpers import error_text, plan_of, rows
from tidemark.operators import coordinates, grid
from tidemark.operators.coordinates import coordinate_values, index_coordinates
from tidemark.operators.grid import (
    dense_cells,
    dense_chunks,
    fill_collisions,
    grid_variables,
    packed_arrays,
    pivot_mean,
    pivot_mean_wide,
    row_texts,
    variable_arrays,
)
from tidemark.plans.to_grid import convert_to_grid, open_grid
from tidemark.schema import attach_field_metadata
from tidemark.sources.publish import write_metadata

NAN = float("nan")
ROWS = [
    (1, "a", 1.0, 10),
    (1, "a", 3.0, 20),  # duplicate cell: the mean is 2.0
    (1, "c", NAN, 5),
    (2, "b", 0.125, 7),
    (2, "c", -9.99, None),
    (3, "a", NAN, 1),
    (3, "a", 4.0, 2),  # NaN does not count
    (3, "c", None, 3),
]
DDL = "place int, day string, v double, n int"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, DDL)


def reference_grid(data, value):
    """The dense grid by plain loops."""
    places, days = sorted({r[0] for r in data}), sorted({r[1] for r in data})
    cells = {}
    for p in places:
        for d in days:
            values = [r[value] for r in data if r[0] == p and r[1] == d]
            values = [v for v in values if v is not None and v == v]
            cells[p, d] = sum(values) / len(values) if values else None
    return cells


def test_coordinates_are_sorted_and_dense(spark):
    values = [f"{i:05}" for i in range(3000)]
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values * 2], "x string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        axis = index_coordinates(df, "x")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert axis.size == 3000
    assert spark.read.parquet(axis.path).select(F.shiftright("ordinal", 33)).distinct().count() > 1
    found = [tuple(r) for r in axis.frame.orderBy("position").select("value", "position").collect()]
    assert found == [(v, i) for i, v in enumerate(sorted(values))]
    assert [r[0] for r in coordinate_values(df, "x").collect()] == sorted(values)


def test_numbering_is_spread_over_tasks(spark):
    axis = index_coordinates(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), "l_orderkey")
    plan = plan_of(axis.frame)
    assert "Window" not in plan and "SinglePartition" not in plan


def test_large_axis_is_not_broadcast(table, monkeypatch, spark):
    axes = [index_coordinates(table, d) for d in ("place", "day")]
    assert all(axis.may_be_broadcast for axis in axes)
    chunks = dense_chunks(pivot_mean(table, ["place", "day"], ["v"]), axes, ["v"])
    assert "BroadcastHashJoin" in plan_of(dense_cells(chunks, axes, ["v"]))
    expected = rows(dense_cells(chunks, axes, ["v"]))
    monkeypatch.setattr(coordinates, "BROADCAST_VALUES", 2)
    monkeypatch.setattr(grid, "MARKERS_PER_TASK", 1)
    monkeypatch.setattr(grid, "CHUNKS_PER_STRETCH", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not axes[0].may_be_broadcast
        chunks = dense_chunks(pivot_mean(table, ["place", "day"], ["v"]), axes, ["v"])
        cells = dense_cells(chunks, axes, ["v"])
        assert "Broadcast" not in plan_of(cells) and rows(cells) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_null_coordinate_is_an_error(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0)], "a int, v double")
    for action in (
        lambda: coordinate_values(df, "a").collect(),
        lambda: pivot_mean(df, ["a"]).collect(),
        lambda: index_coordinates(df, "a"),
    ):
        with pytest.raises(Exception) as caught:
            action()
        assert "dimension 'a' holds a NULL" in error_text(caught)


def test_variables(table, spark):
    assert grid_variables(table, ["place", "day"]) == ["v", "n"]
    assert grid_variables(table, ["place", "day"], ["n"]) == ["v"]
    with pytest.raises(TypeError, match="day"):
        grid_variables(table, ["place"])
    with pytest.raises(ValueError):
        grid_variables(table, ["place", "day"], ["v", "n"])
    with pytest.raises(KeyError):
        grid_variables(table, ["nowhere"])


@pytest.mark.parametrize("dimensions", [[], ["place", "day", "n"], ["day", "day"]])
def test_dimension_guard(table, dimensions):
    with pytest.raises(ValueError):
        pivot_mean(table, dimensions, ["v"])


def test_pivot_mean(table):
    means = {(r["place"], r["day"]): (r["v"], r["n"]) for r in pivot_mean(table, ["place", "day"]).collect()}
    assert means[1, "a"] == (2.0, 15.0) and means[3, "a"] == (4.0, 1.5)
    assert means[1, "c"] == (None, 5.0) and means[2, "c"] == (-9.99, None)
    assert (1, "b") not in means


def test_all_variables_share_one_shuffle(spark):
    plan = plan_of(
        pivot_mean(
            spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"),
            ["l_shipdate", "l_linenumber"],
            ["l_quantity", "l_tax", "l_discount"],
        )
    )
    assert plan.count("Exchange") == 1 and "partial_avg" in plan and "l_comment" not in plan
    assert "l_returnflag" not in plan


def test_pivot_wide(table):
    wide = pivot_mean_wide(table, "place", "day", "v", ["a", "b", "c"])
    assert wide.columns == ["place", "a", "b", "c"]
    assert {r["place"]: (r["a"], r["b"], r["c"]) for r in wide.collect()} == {
        1: (2.0, None, None),
        2: (None, 0.125, -9.99),
        3: (4.0, None, None),
    }
    with pytest.raises(Exception, match="unlisted value: c"):
        pivot_mean_wide(table, "place", "day", "v", ["a", "b"]).collect()


@pytest.mark.parametrize("chunk_cells", [1, 2, 3, 100])
@pytest.mark.parametrize("ordered", [False, True])
def test_dense_grid_equals_loops(table, chunk_cells, ordered):
    axes = [index_coordinates(table, d) for d in ("place", "day")]
    names = ["v", "n"]
    chunks = dense_chunks(pivot_mean(table, ["place", "day"], names), axes, names, chunk_cells, ordered)
    assert chunks.count() == 3 * -(-3 // chunk_cells)
    cells = dense_cells(chunks, axes, names, chunk_cells)
    assert cells.columns == ["place", "day", "v", "n"] and cells.count() == 9
    for position, name in ((2, "v"), (3, "n")):
        assert {(r["place"], r["day"]): r[name] for r in cells.collect()} == reference_grid(ROWS, position)


def test_random_sparse_grid(spark):
    generator = random.Random(11)
    data = [(generator.randrange(40), f"d{generator.randrange(50):02}", generator.random(), 1) for _ in range(500)]
    df = spark.createDataFrame(data, DDL).repartition(5)
    axes = [index_coordinates(df, d) for d in ("place", "day")]
    chunks = dense_chunks(pivot_mean(df, ["place", "day"], ["v"]), axes, ["v"], 7)
    found = {(r[0], r[1]): r[2] for r in dense_cells(chunks, axes, ["v"], 7).collect()}
    expected = reference_grid(data, 2)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_dense_grid_has_no_cross_join(table):
    axes = [index_coordinates(table, d) for d in ("place", "day")]
    chunks = dense_chunks(pivot_mean(table, ["place", "day"], ["v"]), axes, ["v"])
    plan = plan_of(dense_cells(chunks, axes, ["v"]))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_ordered_chunks_need_one_more_shuffle_only(table, spark):
    axes = [index_coordinates(table, d) for d in ("place", "day")]
    plan = plan_of(dense_chunks(pivot_mean(table, ["place", "day"], ["v"]), axes, ["v"], ordered=True))
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning") == 1  # the means


def test_one_dimension(table):
    df = table.select("place", "v")
    axes = [index_coordinates(df, "place")]
    chunks = dense_chunks(pivot_mean(df, ["place"]), axes, ["v"], 2)
    assert rows(dense_cells(chunks, axes, ["v"], 2)) == [(1, 2.0), (2, (0.125 - 9.99) / 2), (3, 4.0)]


def test_packed_chunks(table):
    axes = [index_coordinates(table, d) for d in ("place", "day")]
    chunks = dense_chunks(pivot_mean(table, ["place", "day"], ["v"]), axes, ["v"])
    packed = {r["row_position"]: r["v"] for r in packed_arrays(chunks, ["v"]).collect()}
    assert packed == {0: [200, -999, -999], 1: [-999, 12, -999], 2: [400, -999, -999]}
    assert chunks.select(F.sum(fill_collisions("v", 2))).first()[0] == 1
    arrays = {r["row_position"]: r["v"] for r in variable_arrays(chunks, ["v"]).collect()}
    assert arrays[1] == [None, 0.125, -9.99]


def test_a_row_text_joins_the_blocks_in_order(spark):
    blocks = spark.createDataFrame([(row, 9 - b, [10 * b, 10 * b + 1]) for row in (0, 1) for b in range(10)], "row_position long, block long, v array<int>")
    numbers = ",".join(str(n) for b in reversed(range(10)) for n in (10 * b, 10 * b + 1))
    assert rows(row_texts(blocks.repartition(5), "v")) == [(0, numbers), (1, numbers)]


def test_the_chunk_query_has_a_row_a_date_beyond_one_block(spark, tmp_path):
    columns = "CAST(id AS BIGINT) user_id, timestamp_ntz'2024-01-01' + make_dt_interval(id % 2) AS ts, id / 7D AS value"
    events = spark.range(9000).repartition(3).selectExpr(*columns.split(", "))
    events.write.parquet(str(tmp_path / "events.parquet"))
    found = sorted(map(tuple, registry.grid_chunks(spark, str(tmp_path)).collect()))
    database = duckdb.connect()
    database.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert found == sorted(database.execute(registry.core_oracle_sql()["grid_chunks"]).fetchall())
    assert [row[:2] for row in found] == [(0, 0), (1, 0)]


def test_grid_job(spark, table, tmp_path):
    source, output = str(tmp_path / "source"), str(tmp_path / "grid")
    attach_field_metadata(table, {"v": {"units": "m"}, "place": {"long_name": "Place"}}).write.parquet(source)
    write_metadata(spark, source, {"title": "Sample"})
    for _ in range(2):  # the second run replaces the first
        metadata = convert_to_grid(
            spark, source, output, ["place", "day"], ["n"], precision=1, chunk_cells=2, history="convert"
        )
    assert metadata["fill_collisions"] == {"v": 0}
    opened = open_grid(spark, output)
    assert opened.variables == ["v"]
    assert opened.metadata["variables"]["v"]["attributes"] == {"units": "m"}
    assert opened.metadata["variables"]["v"]["encoding"]["scale_factor"] == 0.1
    assert opened.metadata["coordinates"]["place"] == {"long_name": "Place"}
    attributes = opened.metadata["attributes"]
    assert attributes["title"] == "Sample" and attributes["source"] == source and attributes["history"] == "convert"
    assert set(attributes) == {"title", "source", "history", "generated_by", "generation_date"}
    values = {(r["place"], r["day"]): r["v"] for r in opened.values().collect()}
    expected = reference_grid(ROWS, 2)
    assert values.keys() == expected.keys()
    for key, value in expected.items():
        assert (values[key] is None) == (value is None)
        assert value is None or abs(values[key] - value) <= 0.05 + 1e-9
    stored = [r["row_position"] for r in spark.read.parquet(f"{output}/cells").collect()]
    assert sorted(stored) == [0, 0, 1, 1, 2, 2]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_empty_grid_is_an_error(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "e"))
    with pytest.raises(ValueError, match="no rows"):
        convert_to_grid(spark, str(tmp_path / "e"), str(tmp_path / "g"), ["place", "day"])
    assert not (tmp_path / "g").exists()

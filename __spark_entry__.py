"""Queries over the given tables, one per operator, and the SQL each must agree with.

``queries()`` and ``oracle_sql()`` share their keys; a query without SQL says why.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.casts import apply_schema
from tidemark.functions.hosts import HOST_PATTERN, url_host
from tidemark.functions.packing import pack
from tidemark.operators.coordinates import coordinate_values, index_axes, index_coordinates
from tidemark.operators.dedup import bag_union, dedup_by_key, dedup_by_keys, distinct_rows, sorted_by
from tidemark.operators.grid import (
    dense_cells,
    dense_chunks,
    packed_arrays,
    pivot_mean,
    pivot_mean_wide,
    row_texts,
    variable_arrays,
)
from tidemark.operators.marks import equal_depth_cuts, high_water_mark, range_number, read_mark, scan_after
from tidemark.operators.retype import retype_columns, retype_report
from tidemark.operators.statistics import (
    PERCENTILES,
    daily_means,
    day_statistics,
    merge_states,
    rolling_means,
    statistics_of_state,
    statistics_state,
)
from tidemark.plans.extract import FETCHES_PER_CHECKPOINT, TableKeys, dump_table, unique_by_table_keys
from tidemark.plans.merge import merge_frame, merge_parquet
from tidemark.plans.to_grid import convert_to_grid, open_grid
from tidemark.schema import TableSchema, attach_field_metadata, columns_except, parse_configured_schema
from tidemark.session import scratch_path
from tidemark.sources.publish import OnConflict, publish, write_parquet
from tidemark.sources.storage import Storage
from tidemark.sources.tables import DEFAULT_FETCH_ROWS, FrameSource
from tidemark.streaming.compaction import compact
from tidemark.streaming.distinct import append_distinct

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
GRID_DIMENSIONS = ["event_date", "user_id"]
ROWS_PER_CHECKPOINT = FETCHES_PER_CHECKPOINT * DEFAULT_FETCH_ROWS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------------------ merge and dedup


def merge_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order and line number, sorted by both."""
    lines = table(spark, sf_dir, "lineitem")
    merged = merge_frame(lines, LINE_KEY)
    return sorted_by(merged, LINE_KEY)


def merge_keyed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a second delivery of the returned lines."""
    lines = table(spark, sf_dir, "lineitem")
    delivered = bag_union([lines, lines.filter(F.col("l_returnflag") == "R")])
    return merge_frame(delivered, LINE_KEY)


def merge_keyed_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order, in order, from one exchange; a third of the lines are of one order as well."""
    lines = table(spark, sf_dir, "lineitem")
    crowded = lines.filter(F.col("l_orderkey") % 3 == 0).withColumn("l_orderkey", F.lit(-1).cast("bigint"))
    return merge_frame(bag_union([lines, crowded]), ["l_orderkey"], ordered=True)


def merge_keyed_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key with very few values, each holding a large share of all rows."""
    return dedup_by_key(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], many_per_key=True)


def dedup_prefer_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event of each type survives."""
    events = table(spark, sf_dir, "events")
    return dedup_by_key(events, ["user_id", "event_type"], prefer=[F.col("ts").desc_nulls_last()])


def merge_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = columns_except(table(spark, sf_dir, "documents"), ["doc_id"])
    return merge_frame(documents, enforce_unique=True, wide_rows=True)


def distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/lineitem.parquet"
    return distinct_rows(bag_union([spark.read.parquet(path), spark.read.parquet(path)]))


def merge_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return merge_frame(bag_union([orders, orders]))


def union_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By column name; the first input fixes the schema, further columns are dropped."""
    orders = table(spark, sf_dir, "orders")
    first = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    second = orders.select("o_orderstatus", "o_totalprice", "o_custkey", "o_orderkey")
    return bag_union([first, second])


def dedup_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_keys(table(spark, sf_dir, "orders"), [["o_orderkey"], ["o_custkey", "o_orderdate"]])


def merge_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed merge of orders with a schema applied to the result."""
    schema = parse_configured_schema(
        """{"fields": [
            {"name": "o_custkey", "datatype": "int32", "metadata": {"long_name": "Customer"}},
            {"name": "o_orderdate", "datatype": "datetime"},
            {"name": "o_orderkey", "datatype": "uint32"},
            {"name": "o_totalprice", "datatype": "float32", "metadata": {"units": "1"}},
            {"name": "o_orderstatus", "datatype": "large_string"},
            {"name": "o_orderpriority", "datatype": "string"}
        ], "metadata": {"title": "Orders"}}"""
    )
    return merge_frame(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], schema=schema)


def merge_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole merge job: find inputs, read them once each, de-duplicate, write, swap in."""
    target = scratch_path(spark, "merged")
    merge_parquet(spark, [f"{sf_dir}/lineitem.parq*", f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.none"],
                  _seed(spark, sf_dir, target), keys=LINE_KEY)
    return spark.read.parquet(target)


def _seed(spark: SparkSession, sf_dir: str, target: str) -> str:
    """An existing target: a single input is merged with it."""
    write_parquet(table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F"), target)
    return target


# ------------------------------------------------------------------------------ scans and marks


def high_water_mark_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"])


MARK_ORDERKEY, MARK_LINENUMBER, MARK_PARTKEY = 9_000, 3, 500


def keyset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = {"l_orderkey": MARK_ORDERKEY, "l_linenumber": MARK_LINENUMBER, "l_partkey": MARK_PARTKEY}
    return scan_after(table(spark, sf_dir, "lineitem"), mark)


def resumed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after the largest key of those before a date: together they are the whole table."""
    orders = table(spark, sf_dir, "orders")
    before = orders.filter(F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz"))
    return scan_after(orders, read_mark(before, ["o_orderdate", "o_orderkey"]))


def ordered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_by(table(spark, sf_dir, "lineitem"), LINE_KEY)


def exclude_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns_except(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment", "not_there"])


def dump_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract a table in four committed ranges, unique by its two keys, and publish it."""
    source = FrameSource(
        spark,
        {("public", "orders"): table(spark, sf_dir, "orders")},
        {("public", "orders"): [("PRIMARY KEY", ["o_orderkey"]), ("UNIQUE", ["o_orderdate", "o_custkey"])]},
    )
    output = scratch_path(spark, "dump")
    dump_table(source, "public", "orders", output, on_conflict=OnConflict.ERROR, slices=4)
    return spark.read.parquet(output)


def _balanced_slices(spark: SparkSession, df: DataFrame, keys: list[str], label: str, parts: int = 8) -> DataFrame:
    """How many rows the slices of a table hold, and whether none has more than twice as many as another."""
    cuts = equal_depth_cuts(df, keys, parts)
    depths = df.groupBy(range_number(cuts, df).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    return depths.agg(
        F.lit(label).alias("key"),
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("slices"),
        (F.max("n") <= 2 * F.min("n")).alias("balanced"),
    )


def equal_depth_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of equal depth of a text key, of a skewed number, and of a key of columns of which the first has three values."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    text = orders.select(F.concat(F.lit("order "), F.md5(F.col("o_orderkey").cast("string"))).alias("k"))
    # Nine tenths of the rows in the first tenth of the range.
    skewed = orders.select(F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderkey") * 10).otherwise(F.col("o_orderkey")).alias("k"))
    pair = lines.select("l_returnflag", "l_orderkey", "l_linenumber")
    found = [
        _balanced_slices(spark, text, ["k"], "text"),
        _balanced_slices(spark, skewed, ["k"], "skewed"),
        _balanced_slices(spark, pair, pair.columns, "several columns"),
    ]
    return functools.reduce(DataFrame.unionByName, found)


def dump_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose key is text, extracted in four slices of equal depth by one scan."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderkey", F.md5(F.col("o_orderkey").cast("string")))
    output = scratch_path(spark, "dump_text_key")
    source = FrameSource(spark, {("public", "orders"): orders}, {("public", "orders"): [("PRIMARY KEY", ["o_orderkey"])]})
    dump_table(source, "public", "orders", f"{output}/orders", slices=4)
    return spark.read.parquet(f"{output}/orders")


def dump_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An output one of whose files was overwritten with junk: appending leaves it out and reads its rows again."""
    orders = table(spark, sf_dir, "orders")
    output = f"{scratch_path(spark, 'dump_damaged')}/orders"
    source = FrameSource(spark, {("public", "orders"): orders}, {("public", "orders"): [("PRIMARY KEY", ["o_orderkey"])]})
    dump_table(source, "public", "orders", output, slices=2)
    storage = Storage(spark)
    storage.write_bytes(next(f.path for f in storage.children(output) if not f.is_directory), b"junk" * 64)
    dump_table(source, "public", "orders", output, on_conflict=OnConflict.APPEND, incremental=True)
    return spark.read.parquet(output)


def dump_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first extraction of finished orders, then an incremental one of the whole table."""
    orders = table(spark, sf_dir, "orders")
    keys = {("public", "orders"): [("PRIMARY KEY", ["o_orderkey"])]}
    output = scratch_path(spark, "dump")
    early = orders.filter(F.col("o_orderstatus") == "F")
    dump_table(FrameSource(spark, {("public", "orders"): early}, keys), "public", "orders", output)
    dump_table(
        FrameSource(spark, {("public", "orders"): orders}, keys),
        "public",
        "orders",
        output,
        on_conflict=OnConflict.APPEND,
    )
    return spark.read.parquet(output)


def post_process_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combine overlapping parts of an extraction, then make the rows unique by both keys."""
    events = table(spark, sf_dir, "events")
    parts = [events.filter(F.col("value") < 300), events.filter(F.col("value") >= 100)]
    return unique_by_table_keys(bag_union(parts), TableKeys((("event_id",), ("ts", "user_id"))))


# ------------------------------------------------------------------------------ types


def cast_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = parse_configured_schema(
        """{"fields": [
            {"name": "event_id", "datatype": "uint32"},
            {"name": "ts", "datatype": "TIMESTAMP", "type_arguments": {"unit": "us"}},
            {"name": "user_id", "datatype": "int"},
            {"name": "event_type", "datatype": "string"},
            {"name": "value", "datatype": "float"},
            {"name": "props", "datatype": "json"}
        ]}"""
    )
    return apply_schema(table(spark, sf_dir, "events"), schema)


def retype_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retype_columns(
        table(spark, sf_dir, "lineitem"),
        {"l_orderkey": "int", "l_linenumber": "bigint", "l_quantity": "int", "l_partkey": "double"},
    )


def retype_report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    new_types = {"event_id": "int", "event_type": "int", "props": "double", "user_id": "tinyint"}
    return retype_report(table(spark, sf_dir, "events"), new_types)


# ------------------------------------------------------------------------------ grids


def _dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))


def _event_grid(spark: SparkSession, sf_dir: str, chunk_cells: int = 64):
    """Axes and chunks of mean value by date and user; chunks are cut to show several blocks."""
    events = _dated_events(spark, sf_dir)
    axes = index_axes(events, GRID_DIMENSIONS)
    chunks = dense_chunks(pivot_mean(events, GRID_DIMENSIONS, ["value"]), axes, ["value"], chunk_cells)
    return axes, chunks


def grid_axis_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coordinate_values(table(spark, sf_dir, "lineitem"), "l_shipdate")


def grid_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    axis = index_coordinates(table(spark, sf_dir, "lineitem"), "l_partkey")
    return axis.frame.select("value", "position")


def grid_pivot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = pivot_mean(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["value", "event_id"])
    return means.select(
        "user_id", "event_type", F.round("value", 6).alias("value"), F.round("event_id", 6).alias("event_id")
    )


def grid_pivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = pivot_mean_wide(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_returnflag", "l_quantity", ["A", "N", "R"])
    return wide.select("l_suppkey", *[F.round(c, 6).alias(f"mean_{c.lower()}") for c in ("A", "N", "R")])


def grid_single_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_mean(table(spark, sf_dir, "lineitem"), ["l_shipdate"], ["l_quantity"]).select(
        "l_shipdate", F.round("l_quantity", 6).alias("l_quantity")
    )


def grid_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    axes, chunks = _event_grid(spark, sf_dir)
    cells = dense_cells(chunks, axes, ["value"], 64)
    return cells.select("event_date", "user_id", F.round("value", 6).alias("value"))


def grid_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    axes, chunks = _event_grid(spark, sf_dir)
    cells = dense_cells(chunks, axes, ["value"], 64)
    return cells.select("event_date", "user_id", pack(F.col("value"), 2).alias("packed"))


def grid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per date with the packed values of all users in order, as text."""
    _, chunks = _event_grid(spark, sf_dir, chunk_cells=8192)
    whole = row_texts(packed_arrays(chunks, ["value"], 2), "value")
    return whole.select("row_position", F.lit(0).cast("bigint").alias("block"), F.col("value").alias("packed"))


def grid_chunk_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpacked chunks in blocks of 64 cells: occupied cells of each."""
    _, chunks = _event_grid(spark, sf_dir)
    arrays = variable_arrays(chunks, ["value"])
    return arrays.select(
        "row_position",
        "block",
        F.size("value").cast("bigint").alias("cells"),
        F.size(F.filter("value", lambda v: v.isNotNull())).cast("bigint").alias("occupied"),
    )


def grid_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole conversion, written and read back: quantity and price by ship date and line."""
    output = scratch_path(spark, "grid")
    convert_to_grid(
        spark,
        f"{sf_dir}/lineitem.parquet",
        output,
        ["l_shipdate", "l_linenumber"],
        [c for c in LINE_REST if c not in ("l_quantity", "l_extendedprice", "l_shipdate")] + ["l_orderkey"],
        precision=1,
    )
    return open_grid(spark, output).values()


# ------------------------------------------------------------------------------ text and streams


def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", url_host("url").alias("host"))


def compaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of checkpoint files, compacted by a stream into one unique dataset."""
    base = scratch_path(spark, "compaction")
    lines = table(spark, sf_dir, "lineitem")
    for status in ("F", "O"):
        delivery = lines.filter(F.col("l_linestatus") == status)
        write_parquet(delivery, f"{base}/incoming", max_records_per_file=ROWS_PER_CHECKPOINT, mode="append")
    compact(spark, f"{base}/incoming", f"{base}/main", f"{base}/progress", lines.schema, LINE_KEY)
    return spark.read.parquet(f"{base}/main")


def compaction_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without keys: whole rows are unique."""
    base = scratch_path(spark, "compaction")
    texts = table(spark, sf_dir, "documents").select("text", "lang")
    write_parquet(texts, f"{base}/incoming")
    compact(spark, f"{base}/incoming", f"{base}/main", f"{base}/progress", texts.schema, wide_rows=True)
    return spark.read.parquet(f"{base}/main")


def compaction_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main in small key ranges, and a second delivery that touches the last of them only."""
    base = scratch_path(spark, "compaction")
    lines = table(spark, sf_dir, "lineitem")
    last = lines.agg(F.max("l_orderkey")).first()[0]
    is_late = F.col("l_orderkey") > last - last // 20
    options = {"file_bytes": 1 << 18}
    for delivery in (lines.filter(~is_late), lines.filter(is_late)):
        write_parquet(delivery, f"{base}/incoming", max_records_per_file=ROWS_PER_CHECKPOINT, mode="append")
        compact(spark, f"{base}/incoming", f"{base}/main", f"{base}/progress", lines.schema, LINE_KEY, **options)
    return spark.read.parquet(f"{base}/main")


def stream_distinct_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice, each passed on once, by a state that forgets what is older than a day."""
    base = scratch_path(spark, "distinct")
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    timed = stream.withColumn("at", F.col("ts").cast("timestamp"))
    twice = timed.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    found = append_distinct(spark, twice, ["event_id"], f"{base}/out", f"{base}/progress", "at", "1 day")
    return found.select("event_id", "ts", "user_id", "event_type", "value")


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a stateful stream passes on: each once."""
    base = scratch_path(spark, "distinct")
    keys = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    stream = (
        spark.readStream.schema(keys.schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    )
    return append_distinct(spark, stream, LINE_KEY, f"{base}/out", f"{base}/progress")


def _rounded(statistics: DataFrame) -> DataFrame:
    """Means and quantiles without the last digits, which depend on the order of addition."""
    kept = ["user_id", "month_nu", "day_nu", "count_nu", "earliest", "latest"]
    return statistics.select(*kept, *[F.round(c, 6).alias(c) for c in statistics.columns if c not in kept])


def stats_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(day_statistics(table(spark, sf_dir, "events"), "user_id", "ts", "value"))


def stats_daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily_means(table(spark, sf_dir, "events"), "user_id", "ts", "value")
    return _rounded(day_statistics(days, "user_id", "ts", "value"))


def stats_rolling7(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily_means(table(spark, sf_dir, "events"), "user_id", "ts", "value")
    return _rounded(day_statistics(rolling_means(days, "user_id", "ts", "value"), "user_id", "ts", "value"))


def stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state of all but the last deliveries is kept, and each later one is merged into it without the rows before."""
    events = table(spark, sf_dir, "events")
    state = None
    for part in range(3):
        delivery = events.filter(F.pmod(F.col("event_id"), F.lit(3)) == part)
        new = statistics_state(delivery, "user_id", "ts", "value")
        merged = new if state is None else merge_states(state.unionByName(new), "user_id")
        path = scratch_path(spark, "statistics")
        merged.write.parquet(path)
        state = spark.read.parquet(path)
    return _rounded(statistics_of_state(state, "user_id"))


def _published_statistics_schema() -> TableSchema:
    """The documented columns of the statistics tables, in order, with their types and metadata."""
    shares = {name: f"{round(100 * share)} % of the values are at or below" for name, share in PERCENTILES.items()}
    measured = {"max": "Largest value", "mean": "Mean", "min": "Smallest value", **shares, "std": "Standard deviation"}
    fields = [
        {"name": "location_id", "datatype": "int64", "metadata": {"long_name": "Location"}},
        {"name": "month_nu", "datatype": "uint8", "metadata": {"long_name": "Month"}},
        {"name": "day_nu", "datatype": "uint8", "metadata": {"long_name": "Day"}},
        {"name": "count_nu", "datatype": "uint16", "metadata": {"long_name": "Sample size", "units": "1"}},
        {"name": "earliest", "datatype": "datetime", "metadata": {"long_name": "Time of the first value"}},
        {"name": "latest", "datatype": "datetime", "metadata": {"long_name": "Time of the last value"}},
        *({"name": name, "datatype": "float32", "metadata": {"long_name": text}} for name, text in measured.items()),
    ]
    table_metadata = {"title": "Statistics by location and day of the year", "frequency": "P0D", "aggregation": "identity"}
    return parse_configured_schema(json.dumps({"fields": fields, "metadata": table_metadata}))


def stats_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics in their documented types, published with the metadata of table and columns."""
    schema = _published_statistics_schema()
    found = day_statistics(table(spark, sf_dir, "events"), "user_id", "ts", "value").withColumnRenamed("user_id", "location_id")
    target = f"{scratch_path(spark, 'published')}/statistics"
    publish(attach_field_metadata(apply_schema(found, schema), {f.name: f.metadata for f in schema.fields}), target, metadata=schema.metadata)
    return spark.read.parquet(target)


def dedup_nullable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose priority key is NULL never conflict; of the others one per customer and priority stays."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT"))
    )
    kept = dedup_by_key(orders, ["o_custkey", "o_orderpriority"], ["o_orderkey"], null_keys="distinct")
    return kept.select("o_orderkey", "o_custkey", "o_orderpriority")


def retype_report_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A discount has two decimals: as decimal(10,1) most values would change, so they count as failures."""
    return retype_report(table(spark, sf_dir, "lineitem"), {"l_discount": "decimal(10,1)", "l_quantity": "decimal(10,1)"})


def entry(spark: SparkSession) -> DataFrame:
    return merge_keyed(spark, "/root/testdata/sf0.001")


def _training_text() -> tuple[dict, dict]:
    """Queries and SQL of the training-text operators and their pipeline, if those are installed."""
    try:
        from tidemark.llm import registry

        import corpus_pipeline
    except ImportError as missing:
        if missing.name not in ("tidemark.llm", "tidemark.llm.registry", "corpus_pipeline"):
            raise
        return {}, {}
    found, sql = registry.queries(), registry.oracle_sql()
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | _training_text()[0]


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | _training_text()[1]


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "merge_keyed": merge_keyed,
        "merge_keyed_union": merge_keyed_union,
        "merge_keyed_sorted": merge_keyed_sorted,
        "merge_keyed_hot": merge_keyed_hot,
        "dedup_prefer_latest": dedup_prefer_latest,
        "merge_distinct": merge_distinct,
        "distinct_lines": distinct_lines,
        "merge_bag": merge_bag,
        "union_strict": union_strict,
        "dedup_multi_key": dedup_multi_key,
        "merge_cast": merge_cast,
        "merge_published": merge_published,
        "high_water_mark": high_water_mark_orders,
        "keyset_scan": keyset_scan,
        "resumed_scan": resumed_scan,
        "ordered_scan": ordered_scan,
        "exclude_columns": exclude_columns,
        "dump_table": dump_orders,
        "dump_append": dump_append,
        "dump_text_key": dump_text_key,
        "dump_damaged": dump_damaged,
        "equal_depth_slices": equal_depth_slices,
        "post_process": post_process_events,
        "cast_schema": cast_schema,
        "retype_columns": retype_lines,
        "retype_report": retype_report_events,
        "grid_axis_values": grid_axis_values,
        "grid_coordinates": grid_coordinates,
        "grid_pivot_mean": grid_pivot_mean,
        "grid_pivot_wide": grid_pivot_wide,
        "grid_single_dimension": grid_single_dimension,
        "grid_dense": grid_dense,
        "grid_packed": grid_packed,
        "grid_chunks": grid_chunks,
        "grid_chunk_values": grid_chunk_values,
        "grid_job": grid_job,
        "stats_hourly": stats_hourly,
        "stats_daily_mean": stats_daily_mean,
        "stats_rolling7": stats_rolling7,
        "stats_incremental": stats_incremental,
        "stats_published": stats_published,
        "dedup_nullable_key": dedup_nullable_key,
        "retype_report_decimal": retype_report_decimal,
        "url_host": url_hosts,
        "compaction_stream": compaction_stream,
        "compaction_ranges": compaction_ranges,
        "stream_distinct_bounded": stream_distinct_bounded,
        "compaction_stream_rows": compaction_stream_rows,
        "stream_distinct": stream_distinct,
    }


# ------------------------------------------------------------------------------ SQL counterparts


def _first_per_key(source: str, keys: list[str], order: list[str], columns: str = "*") -> str:
    ties = ", ".join(f"{c} NULLS LAST" for c in order)
    return (
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ties}) AS rn"
        f" FROM {source}) WHERE rn = 1"
    )


def _events_grid_sql() -> str:
    return (
        "WITH e AS (SELECT CAST(ts AS DATE) AS event_date, user_id, value FROM events),"
        " cells AS (SELECT event_date, user_id, avg(value) AS value FROM e GROUP BY event_date, user_id),"
        " grid AS (SELECT d.event_date, u.user_id, c.value"
        " FROM (SELECT DISTINCT event_date FROM e) d CROSS JOIN (SELECT DISTINCT user_id FROM e) u"
        " LEFT JOIN cells c ON c.event_date = d.event_date AND c.user_id = u.user_id)"
    )


def _packed_sql(value: str, scale: str) -> str:
    return f"COALESCE(CAST(round_even(CAST(CAST({value} AS FLOAT) AS DOUBLE) / {scale}, 0) AS INTEGER), -999)"


def _statistics_sql(source: str, digits: int | None = 6) -> str:
    """Statistics of ``source`` (user_id, ts, value), rounded as the query does."""

    def shown(expression: str) -> str:
        return expression if digits is None else f"round({expression}, {digits})"

    quantiles = ", ".join(f"{shown(f'quantile_cont(value, {share})')} AS {name}" for name, share in PERCENTILES.items())
    return (
        "SELECT user_id, CAST(month(ts) AS INTEGER) AS month_nu, CAST(day(ts) AS INTEGER) AS day_nu,"
        f" count(value) AS count_nu, min(ts) AS earliest, max(ts) AS latest, {shown('max(value)')} AS max,"
        f" {shown('avg(value)')} AS mean, {shown('min(value)')} AS min, {quantiles},"
        f" {shown('stddev_samp(value)')} AS std FROM ({source}) GROUP BY user_id, month(ts), day(ts)"
    )


DAILY_MEANS_SQL = (
    "SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, avg(value) AS value FROM events GROUP BY 1, 2"
)
ROLLING_MEANS_SQL = (
    "SELECT user_id, ts, avg(value) OVER (PARTITION BY user_id ORDER BY ts"
    f" RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS value FROM ({DAILY_MEANS_SQL})"
)


def core_oracle_sql() -> dict[str, str]:
    line_columns = ", ".join(LINE_KEY[:1] + LINE_REST[:2] + LINE_KEY[1:] + LINE_REST[2:])
    order_rest = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    order_columns = "o_orderkey, " + ", ".join(order_rest)
    group_key = ["l_returnflag", "l_linestatus"]
    by_line = _first_per_key("lineitem", LINE_KEY, LINE_REST, line_columns)
    after_date = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    packed = _packed_sql("value", "0.01")
    return {
        "merge_keyed": by_line,
        "merge_keyed_union": _first_per_key(
            "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')",
            LINE_KEY,
            LINE_REST,
            line_columns,
        ),
        "merge_keyed_sorted": _first_per_key(
            f"(SELECT {line_columns} FROM lineitem UNION ALL SELECT CAST(-1 AS BIGINT),"
            f" {line_columns.partition(', ')[2]} FROM lineitem WHERE l_orderkey % 3 = 0)",
            ["l_orderkey"],
            line_columns.split(", ")[1:],
            line_columns,
        ),
        "merge_keyed_hot": _first_per_key(
            "lineitem",
            group_key,
            [c for c in line_columns.split(", ") if c not in group_key],
            line_columns,
        ),
        "dedup_prefer_latest": _first_per_key(
            "events",
            ["user_id", "event_type"],
            ["ts DESC", "event_id", "value", "props"],
            "event_id, ts, user_id, event_type, value, props",
        ),
        "merge_distinct": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
        "distinct_lines": "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
        "merge_bag": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "union_strict": (
            "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
            " UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
        ),
        "dedup_multi_key": _first_per_key(
            f"({_first_per_key('orders', ['o_orderkey'], order_rest, order_columns)})",
            ["o_custkey", "o_orderdate"],
            after_date,
            order_columns,
        ),
        "merge_cast": (
            "SELECT CAST(o_custkey AS INTEGER) AS o_custkey, o_orderdate, o_orderkey,"
            " CAST(o_totalprice AS FLOAT) AS o_totalprice, o_orderstatus, o_orderpriority FROM ("
            + _first_per_key("orders", ["o_custkey", "o_orderdate"], after_date)
            + ")"
        ),
        "merge_published": by_line,
        "high_water_mark": (
            "SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate DESC NULLS LAST,"
            " o_orderkey DESC NULLS LAST LIMIT 1"
        ),
        "keyset_scan": (
            f"SELECT * FROM lineitem WHERE l_orderkey > {MARK_ORDERKEY} OR (l_orderkey = {MARK_ORDERKEY} AND"
            f" (l_linenumber > {MARK_LINENUMBER} OR (l_linenumber = {MARK_LINENUMBER} AND l_partkey > {MARK_PARTKEY})))"
        ),
        "resumed_scan": (
            "WITH mark AS (SELECT o_orderdate AS d, o_orderkey AS k FROM orders"
            " WHERE o_orderdate < TIMESTAMP '1995-06-01' ORDER BY d DESC, k DESC LIMIT 1)"
            " SELECT orders.* FROM orders, mark WHERE o_orderdate > d OR (o_orderdate = d AND o_orderkey > k)"
        ),
        "ordered_scan": "SELECT * FROM lineitem ORDER BY l_orderkey NULLS LAST, l_linenumber NULLS LAST",
        "exclude_columns": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer",
        "dump_table": _first_per_key(
            f"({_first_per_key('orders', ['o_orderkey'], order_rest, order_columns)})",
            ["o_orderdate", "o_custkey"],
            after_date,
            order_columns,
        ),
        "dump_append": _first_per_key("orders", ["o_orderkey"], order_rest, order_columns),
        "dump_text_key": (
            f"SELECT md5(CAST(o_orderkey AS VARCHAR)) AS o_orderkey, {', '.join(order_rest)}"
            f" FROM ({_first_per_key('orders', ['o_orderkey'], order_rest, order_columns)})"
        ),
        "dump_damaged": _first_per_key("orders", ["o_orderkey"], order_rest, order_columns),
        "equal_depth_slices": (
            "SELECT 'text' AS key, count(*) AS rows, CAST(8 AS BIGINT) AS slices, true AS balanced FROM orders"
            " UNION ALL SELECT 'skewed', count(*), CAST(8 AS BIGINT), true FROM orders"
            " UNION ALL SELECT 'several columns', count(*), CAST(8 AS BIGINT), true FROM lineitem"
        ),
        "post_process": "SELECT * FROM events",
        "cast_schema": (
            "SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type,"
            " CAST(value AS FLOAT) AS value, props FROM events"
        ),
        "retype_columns": (
            "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey, l_suppkey,"
            " CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,"
            " l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem"
        ),
        "retype_report": " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, '{new}' AS new_type, count({name}) AS value_count,"
            f" count(*) FILTER ({name} IS NOT NULL AND TRY_CAST({name} AS {sql}) IS NULL) AS failure_count,"
            f" count(*) FILTER ({name} IS NOT NULL AND TRY_CAST({name} AS {sql}) IS NULL) = 0 AS succeeded FROM events"
            for name, new, sql in (
                ("event_id", "int", "INTEGER"),
                ("event_type", "int", "INTEGER"),
                ("props", "double", "DOUBLE"),
                ("user_id", "tinyint", "TINYINT"),
            )
        ),
        "grid_axis_values": "SELECT DISTINCT l_shipdate FROM lineitem",
        "grid_coordinates": (
            "SELECT l_partkey AS value, ROW_NUMBER() OVER (ORDER BY l_partkey) - 1 AS position"
            " FROM (SELECT DISTINCT l_partkey FROM lineitem)"
        ),
        "grid_pivot_mean": (
            "SELECT user_id, event_type, round(avg(value), 6) AS value, round(avg(event_id), 6) AS event_id"
            " FROM events GROUP BY user_id, event_type"
        ),
        "grid_pivot_wide": "SELECT l_suppkey, "
        + ", ".join(
            f"round(avg(l_quantity) FILTER (l_returnflag = '{flag}'), 6) AS mean_{flag.lower()}" for flag in "ANR"
        )
        + " FROM lineitem GROUP BY l_suppkey",
        "grid_single_dimension": (
            "SELECT l_shipdate, round(avg(l_quantity), 6) AS l_quantity FROM lineitem GROUP BY l_shipdate"
        ),
        "grid_dense": _events_grid_sql() + " SELECT event_date, user_id, round(value, 6) AS value FROM grid",
        "grid_packed": _events_grid_sql() + f" SELECT event_date, user_id, {packed} AS packed FROM grid",
        "grid_chunks": (
            _events_grid_sql()
            + ", chunks AS (SELECT event_date,"
            + f" string_agg(CAST({packed} AS VARCHAR), ',' ORDER BY user_id) AS packed FROM grid GROUP BY event_date)"
            + " SELECT ROW_NUMBER() OVER (ORDER BY event_date) - 1 AS row_position, CAST(0 AS BIGINT) AS block, packed"
            + " FROM chunks"
        ),
        "grid_chunk_values": (
            _events_grid_sql()
            + ", placed AS (SELECT DENSE_RANK() OVER (ORDER BY event_date) - 1 AS row_position,"
            + " (DENSE_RANK() OVER (ORDER BY user_id) - 1) // 64 AS block, value FROM grid)"
            + " SELECT row_position, block, count(*) AS cells, count(value) AS occupied FROM placed GROUP BY 1, 2"
        ),
        "grid_job": (
            "WITH cells AS (SELECT l_shipdate, l_linenumber, avg(l_quantity) AS q, avg(l_extendedprice) AS p"
            " FROM lineitem GROUP BY l_shipdate, l_linenumber),"
            " grid AS (SELECT d.l_shipdate, n.l_linenumber, c.q, c.p FROM (SELECT DISTINCT l_shipdate FROM lineitem) d"
            " CROSS JOIN (SELECT DISTINCT l_linenumber FROM lineitem) n"
            " LEFT JOIN cells c ON c.l_shipdate = d.l_shipdate AND c.l_linenumber = n.l_linenumber)"
            " SELECT l_shipdate, l_linenumber,"
            + f" NULLIF({_packed_sql('q', '0.1')}, -999) * CAST(0.1 AS DOUBLE) AS l_quantity,"
            + f" NULLIF({_packed_sql('p', '0.1')}, -999) * CAST(0.1 AS DOUBLE) AS l_extendedprice FROM grid"
        ),
        "stats_hourly": _statistics_sql("SELECT user_id, ts, value FROM events"),
        "stats_incremental": _statistics_sql("SELECT user_id, ts, value FROM events"),
        "stats_published": (
            "SELECT user_id AS location_id, CAST(month_nu AS SMALLINT) AS month_nu, CAST(day_nu AS SMALLINT) AS day_nu,"
            " CAST(count_nu AS INTEGER) AS count_nu, earliest, latest, "
            + ", ".join(f"CAST({name} AS FLOAT) AS {name}" for name in ("max", "mean", "min", *PERCENTILES, "std"))
            + f" FROM ({_statistics_sql('SELECT user_id, ts, value FROM events', digits=None)})"
        ),
        "stats_daily_mean": _statistics_sql(DAILY_MEANS_SQL),
        "stats_rolling7": _statistics_sql(ROLLING_MEANS_SQL),
        "dedup_nullable_key": (
            "WITH o AS (SELECT o_orderkey, o_custkey, NULLIF(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders)"
            " SELECT * FROM o WHERE o_orderpriority IS NULL UNION ALL"
            " SELECT min(o_orderkey), o_custkey, o_orderpriority FROM o WHERE o_orderpriority IS NOT NULL"
            " GROUP BY o_custkey, o_orderpriority"
        ),
        "retype_report_decimal": " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, 'decimal(10,1)' AS new_type, count({name}) AS value_count,"
            f" count(*) FILTER (CAST(CAST({name} AS DECIMAL(10,1)) AS DOUBLE) <> {name}) AS failure_count,"
            f" count(*) FILTER (CAST(CAST({name} AS DECIMAL(10,1)) AS DOUBLE) <> {name}) = 0 AS succeeded FROM lineitem"
            for name in ("l_discount", "l_quantity")
        ),
        "url_host": f"SELECT page_id, NULLIF(regexp_extract(url, '{HOST_PATTERN}', 1), '') AS host FROM pages",
        "compaction_stream": by_line,
        "compaction_ranges": by_line,
        "stream_distinct_bounded": "SELECT event_id, ts, user_id, event_type, value FROM events",
        "compaction_stream_rows": "SELECT DISTINCT text, lang FROM documents",
        "stream_distinct": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    }

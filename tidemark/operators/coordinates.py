"""Coordinates of a grid dimension: sorted distinct values with a dense 0-based index."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import scratch_path
from tidemark.sources.storage import Storage

# An axis within both bounds is broadcast to number the cells; a larger one is joined by shuffle.
BROADCAST_VALUES = 2_000_000
BROADCAST_BYTES = 32 * 1024 * 1024

# monotonically_increasing_id() keeps the row number within a partition in its low 33 bits.
_ROW_BITS = 33


@dataclass(frozen=True)
class Coordinates:
    """``frame`` has the columns ``value`` and ``position`` (bigint); ``path`` is where it lies."""

    dimension: str
    frame: DataFrame
    size: int
    path: str
    stored_bytes: int

    @property
    def may_be_broadcast(self) -> bool:
        """Decided from the counted values and the bytes on disk."""
        return self.size <= BROADCAST_VALUES and self.stored_bytes <= BROADCAST_BYTES


def join_axis(df: DataFrame, axis: DataFrame, on: str, coordinates: Coordinates) -> DataFrame:
    """Join with a frame made from an axis, broadcast if the axis was found to be small."""
    return df.join(F.broadcast(axis) if coordinates.may_be_broadcast else axis, on)


def dimension_value(df: DataFrame, dimension: str) -> Column:
    """The dimension's column; a NULL has no place on an axis and raises."""
    column = F.col(f"`{dimension}`")
    data_type = df.schema[dimension].dataType
    message = F.lit(f"dimension '{dimension}' holds a NULL, which has no coordinate")
    return F.coalesce(column, F.raise_error(message).cast(data_type)).alias(dimension)


def coordinate_values(df: DataFrame, dimension: str) -> DataFrame:
    """Sorted distinct values of one column; reads that column only."""
    return df.select(dimension_value(df, dimension)).distinct().orderBy(dimension)


def index_coordinates(df: DataFrame, dimension: str, path: str | None = None) -> Coordinates:
    """Number the sorted distinct values without bringing them together in one task.

    The values are range-partitioned and written once, with the row number inside each partition.
    The index is that number plus the count of all earlier partitions; these counts are one row
    per partition, so both the driver's list and the offset lookup are bounded by the partition
    count.  Writing fixes the partition boundaries: a lost executor can not change a number.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, f"coordinates-{dimension}")
    ranged = (
        df.select(dimension_value(df, dimension).alias("value"))
        .distinct()
        .repartitionByRange("value")
        .sortWithinPartitions("value")
        .withColumn("ordinal", F.monotonically_increasing_id())
    )
    ranged.write.parquet(path)
    return read_coordinates(spark, path, dimension, ranged.schema)


def index_axes(df: DataFrame, dimensions: Sequence[str], directory: str | None = None) -> list[Coordinates]:
    """``index_coordinates`` for several dimensions; their jobs run at the same time."""
    directory = directory or scratch_path(df.sparkSession, "coordinates")
    with ThreadPoolExecutor(len(dimensions)) as jobs:
        return list(jobs.map(lambda d: index_coordinates(df, d, f"{directory}/{d}"), dimensions))


def read_coordinates(
    spark: SparkSession, path: str, dimension: str, schema: T.StructType | None = None
) -> Coordinates:
    """Coordinates written by ``index_coordinates``."""
    written = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    partition = F.shiftright("ordinal", _ROW_BITS)
    counts = sorted(
        (row["part"], row["n"])
        for row in written.groupBy(partition.cast("long").alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    size = sum(n for _, n in counts)
    row_in_partition = F.col("ordinal").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    if len(counts) <= 1:
        frame = written.select("value", row_in_partition.alias("position"))
    else:
        offsets, total = [], 0
        for part, n in counts:
            offsets.append((part, total))
            total += n
        offset_rows = spark.createDataFrame(offsets, "part long, start long")
        frame = (
            written.withColumn("part", partition.cast("long"))
            .join(F.broadcast(offset_rows), "part")
            .select("value", (F.col("start") + row_in_partition).alias("position"))
        )
    return Coordinates(dimension, frame, size, path, Storage(spark).size(path))


def with_position(df: DataFrame, coordinates: Coordinates, alias: str) -> DataFrame:
    """Replace the dimension's column by its index."""
    lookup = coordinates.frame.select(
        F.col("value").alias(coordinates.dimension), F.col("position").alias(alias)
    )
    return join_axis(df, lookup, coordinates.dimension, coordinates).drop(coordinates.dimension)


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))

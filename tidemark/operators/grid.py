"""Long table to dense grid: pivot-mean, dense completion, packing and chunk layout."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.packing import is_fill_collision, pack
from tidemark.operators.coordinates import (
    Coordinates,
    dimension_value,
    is_floating,
    join_axis,
    with_position,
)

MAX_DIMENSIONS = 2
# Cells of the last dimension in one chunk row.  A shorter axis lies in one chunk, a longer one is
# cut, so that a chunk stays small however long the axis grows.
CHUNK_CELLS = 8192
# Empty-chunk markers that one task makes.
MARKERS_PER_TASK = 1_000_000

ROW, BLOCK, CELLS = "row_position", "block", "cells"
_LAST = "last_position"


def check_dimensions(dimensions: Sequence[str]) -> None:
    if not 1 <= len(dimensions) <= MAX_DIMENSIONS:
        raise ValueError(f"A grid has 1 to {MAX_DIMENSIONS} dimensions, not {len(dimensions)}")
    if len(set(dimensions)) != len(dimensions):
        raise ValueError("The dimensions of a grid must differ")


def grid_variables(df: DataFrame, dimensions: Sequence[str], excluded: Sequence[str] = ()) -> list[str]:
    """Every column that is neither a dimension nor excluded; each must have a mean."""
    missing = [name for name in dimensions if name not in df.columns]
    if missing:
        raise KeyError(f"The data has no columns {missing}")
    names = [f.name for f in df.schema.fields if f.name not in set(dimensions) | set(excluded)]
    no_mean = [
        name for name in names if not isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType))
    ]
    if no_mean:
        raise TypeError(f"Columns {no_mean} are not numeric and must be excluded from the grid")
    if not names:
        raise ValueError("No column is left to be a variable of the grid")
    return names


def _mean(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    data_type = df.schema[name].dataType
    if is_floating(data_type):
        column = F.nanvl(column, F.lit(None).cast(data_type))
    elif isinstance(data_type, T.BooleanType):
        column = column.cast("int")
    elif isinstance(data_type, T.DecimalType):
        column = column.cast("double")
    return F.avg(column).alias(name)


# Chunks that share one copy of their stretch of a long axis: at the largest chunk a few hundred megabytes of cells.
CHUNKS_PER_STRETCH = 4_096


def pivot_mean(df: DataFrame, dimensions: Sequence[str], variables: Sequence[str] | None = None) -> DataFrame:
    """One row per occupied cell with the mean of each variable; NULL and NaN do not count.

    All variables share one aggregation, hence one shuffle of partial sums and counts.
    """
    check_dimensions(dimensions)
    names = list(variables) if variables is not None else grid_variables(df, dimensions)
    # Pruned before grouping, so that the scan reads the dimensions and the variables only.
    return (
        df.select(*[dimension_value(df, d) for d in dimensions], *[F.col(f"`{name}`") for name in names])
        .groupBy(*[F.col(f"`{d}`") for d in dimensions])
        .agg(*[_mean(df, name) for name in names])
    )


def pivot_mean_wide(
    df: DataFrame, row_dimension: str, column_dimension: str, variable: str, columns: Sequence[Any]
) -> DataFrame:
    """One row per value of ``row_dimension`` and one mean column per value in ``columns``.

    The caller names the values of ``column_dimension``; another value in the data raises.  A long axis
    belongs in the long or chunked form.
    """
    column = F.col(f"`{column_dimension}`")
    unlisted = F.raise_error(F.concat(F.lit(f"'{column_dimension}' has an unlisted value: "), column.cast("string")))
    listed = F.when(column.isin(list(columns)), column).otherwise(unlisted.cast(df.schema[column_dimension].dataType))
    return (
        df.select(
            dimension_value(df, row_dimension), dimension_value(df, column_dimension), F.col(f"`{variable}`")
        )
        .withColumn(column_dimension, listed)
        .groupBy(row_dimension)
        .pivot(column_dimension, list(columns))
        .agg(_mean(df, variable))
    )


def dense_chunks(
    cells: DataFrame,
    coordinates: Sequence[Coordinates],
    variables: Sequence[str],
    chunk_cells: int = CHUNK_CELLS,
    ordered: bool = False,
) -> DataFrame:
    """The full grid as chunk rows ``(row_position, block, cells)``.

    ``cells`` is an array over ``chunk_cells`` neighbouring values of the last dimension, with NULL
    where a cell is absent.  The axes are never multiplied: only occupied cells and one empty
    marker per chunk are shuffled, and the gaps are filled inside each chunk.  A chunk gathers at
    most ``chunk_cells`` means, whatever the distribution of the data.

    ``ordered``: chunks come sorted, range-partitioned by position, with the same single shuffle.
    """
    last = coordinates[-1]
    blocks = -(-last.size // chunk_cells)
    located = cells
    if len(coordinates) == 2:
        located = with_position(located, coordinates[0], ROW)
        rows = coordinates[0].frame.select(F.col("position").alias(ROW))
        marker_tasks = coordinates[0].size * blocks // MARKERS_PER_TASK
        if marker_tasks > 1:
            rows = rows.repartition(min(marker_tasks, coordinates[0].size), ROW)
    else:
        located = located.withColumn(ROW, F.lit(0).cast("long"))
        rows = cells.sparkSession.range(1).select(F.col("id").alias(ROW))
    located = with_position(located, last, _LAST)

    entry = F.struct(
        (F.col(_LAST) % chunk_cells).cast("int").alias("offset"), *[F.col(f"`{name}`") for name in variables]
    )
    occupied = located.select(
        ROW, F.floor(F.col(_LAST) / chunk_cells).cast("long").alias(BLOCK), entry.alias("entry")
    )
    entry_type = occupied.schema["entry"].dataType
    markers = rows.select(
        ROW,
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias(BLOCK),
        F.lit(None).cast(entry_type).alias("entry"),
    )
    entries = occupied.unionByName(markers)
    if ordered:
        # A range partitioning by the grouping columns also serves the aggregation below.
        entries = entries.repartitionByRange(ROW, BLOCK)
    gathered = entries.groupBy(ROW, BLOCK).agg(F.array_sort(F.collect_list("entry")).alias("present"))

    length = F.when(F.col(BLOCK) == blocks - 1, last.size - (blocks - 1) * chunk_cells).otherwise(chunk_cells)
    absent = F.lit(None).cast(entry_type)
    before_first = F.struct(
        F.lit(-1).alias("offset"), *[F.lit(None).cast(entry_type[name].dataType).alias(name) for name in variables]
    )
    # Each present cell is followed by as many NULLs as are missing up to the next one.
    filled = F.flatten(
        F.zip_with(
            F.concat(F.array(before_first), F.col("present")),
            F.concat(F.transform("present", lambda cell: cell["offset"]), F.array(length.cast("int"))),
            lambda cell, following: F.concat(
                F.array(cell), F.array_repeat(absent, following - cell["offset"] - 1)
            ),
        )
    )
    chunks = gathered.select(ROW, BLOCK, F.slice(filled, F.lit(2), length.cast("int")).alias(CELLS))
    return chunks.sortWithinPartitions(ROW, BLOCK) if ordered else chunks


def _per_cell(name: str, function: Callable[[Column], Column]) -> Column:
    return F.transform(CELLS, lambda cell: function(cell[name]))


def fill_collisions(name: str, precision: int) -> Column:
    """How many cells of a chunk hold a real value that packs to the fill value."""
    return F.size(F.filter(CELLS, lambda cell: is_fill_collision(cell[name], precision)))


def variable_arrays(chunks: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One array column of means per variable."""
    return chunks.select(
        ROW, BLOCK, *[_per_cell(name, lambda value: value).alias(name) for name in variables]
    )


def packed_arrays(chunks: DataFrame, variables: Sequence[str], precision: int = 2) -> DataFrame:
    """One array column of packed 32-bit integers per variable, the fill value where missing."""
    return chunks.select(
        ROW,
        BLOCK,
        *[_per_cell(name, lambda value: pack(value, precision)).alias(name) for name in variables],
    )


def row_texts(packed: DataFrame, variable: str, separator: str = ",") -> DataFrame:
    """One row per grid row ``(row_position, <variable>)``: the values of all its blocks in order, as one text.

    Each block is a text before it is shuffled, so a row gathers one text per block, however long the axis is.
    """
    block_text = F.array_join(F.col(f"`{variable}`").cast("array<string>"), separator)
    gathered = packed.groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct(F.col(BLOCK), block_text.alias("text")))).alias("texts")
    )
    return gathered.select(ROW, F.array_join("texts.text", separator).alias(variable))


def dense_cells(
    chunks: DataFrame,
    coordinates: Sequence[Coordinates],
    variables: Sequence[str],
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """The full grid in long form: one row per coordinate pair, NULL variables where absent.

    Coordinates are joined per chunk, not per cell: one row for a chunk's row value and one array
    for its stretch of the last axis.  Few stretches serve many chunks: of an axis too large to broadcast each is
    repeated for every ``CHUNKS_PER_STRETCH`` chunks, which are joined by stretch and a part of the rows.
    """
    last = coordinates[-1]
    axis = (
        last.frame.groupBy(F.floor(F.col("position") / chunk_cells).cast("long").alias(BLOCK))
        .agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("axis"))
        .select(BLOCK, F.col("axis.value").alias("axis"))
    )
    if last.may_be_broadcast:
        joined = join_axis(chunks, axis, BLOCK, last)
    else:
        rows = coordinates[0].size if len(coordinates) == 2 else 1
        parts = -(-rows // CHUNKS_PER_STRETCH)
        repeated = axis.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")))
        joined = chunks.withColumn("__part", F.pmod(F.col(ROW), F.lit(parts).cast("long"))).join(repeated, [BLOCK, "__part"])
    names = []
    if len(coordinates) == 2:
        first = coordinates[0]
        lookup = first.frame.select(F.col("position").alias(ROW), F.col("value").alias(first.dimension))
        joined = join_axis(joined, lookup, ROW, first)
        names.append(F.col(f"`{first.dimension}`"))
    exploded = joined.select(*names, F.explode(F.arrays_zip("axis", CELLS)).alias("cell"))
    return exploded.select(
        *names,
        F.col("cell.axis").alias(last.dimension),
        *[F.col(f"cell.{CELLS}.`{name}`").alias(name) for name in variables],
    )

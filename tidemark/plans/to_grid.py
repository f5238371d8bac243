"""Convert a long Parquet table into a dense, packed grid dataset.

Layout of the dataset::

    coordinates/<dimension>   value, ordinal: the sorted axis
    cells                     row_position, block, one array<int> per variable
    _table_metadata           dimensions, encoding, attributes and provenance as JSON
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.packing import FILL_VALUE, scale_factor, unpack
from tidemark.functions.timetext import timestamp_text
from tidemark.operators.coordinates import Coordinates, index_axes, read_coordinates
from tidemark.operators.grid import (
    BLOCK,
    CELLS,
    CHUNK_CELLS,
    ROW,
    check_dimensions,
    dense_cells,
    dense_chunks,
    fill_collisions,
    grid_variables,
    packed_arrays,
    pivot_mean,
)
from tidemark.sources.publish import read_metadata, staging_path, swap_in, write_metadata, write_parquet
from tidemark.sources.storage import Storage

# Fixed default: compression level of packed cells.
CELL_CODEC, CELL_LEVEL = "zstd", 4


def provenance(spark: SparkSession, source: str, history: str) -> DataFrame:
    """One row: where the grid came from, when, how and by whom."""
    return spark.range(1).select(
        F.lit(source).alias("source"),
        timestamp_text().alias("generation_date"),
        F.lit(history).alias("history"),
        F.lit(spark.sparkContext.sparkUser() or "unknown").alias("generated_by"),
    )


def field_attributes(df: DataFrame, names: Sequence[str]) -> dict[str, dict[str, Any]]:
    return {name: dict(df.schema[name].metadata or {}) for name in names}


def convert_to_grid(
    spark: SparkSession,
    source: str,
    output: str,
    dimensions: Sequence[str],
    excluded: Sequence[str] = (),
    precision: int = 2,
    chunk_cells: int = CHUNK_CELLS,
    history: str = "",
) -> dict[str, Any]:
    """Write the grid of ``source`` and return its metadata.

    The source is scanned once: the means of its cells are written, and the axes, whose every value has a
    cell, and the chunks are made from those.
    ``fill_collisions`` in the metadata counts real values that pack to the fill value.
    """
    check_dimensions(dimensions)
    scale = scale_factor(precision)
    data = spark.read.parquet(source)
    variables = grid_variables(data, dimensions, excluded)
    storage = Storage(spark)
    staged = staging_path(output)
    try:
        write_parquet(pivot_mean(data, dimensions, variables), f"{staged}/means", CELL_CODEC, CELL_LEVEL)
        means = spark.read.parquet(f"{staged}/means")
        coordinates = index_axes(means, dimensions, f"{staged}/coordinates")
        if any(axis.size == 0 for axis in coordinates):
            raise ValueError(f"There are no rows to grid in {source}")
        chunks = dense_chunks(means, coordinates, variables, chunk_cells, ordered=True)
        collisions = Observation("grid")
        counters = [F.sum(fill_collisions(name, precision)).alias(name) for name in variables]
        write_parquet(
            packed_arrays(chunks.observe(collisions, *counters), variables, precision),
            f"{staged}/cells",
            CELL_CODEC,
            CELL_LEVEL,
        )
        metadata = {
            "dimensions": list(dimensions),
            "chunk_cells": chunk_cells,
            "precision": precision,
            "variables": {
                name: {
                    "attributes": attributes,
                    "encoding": {
                        "dtype": "int32",
                        "scale_factor": scale,
                        "add_offset": 0.0,
                        "_FillValue": FILL_VALUE,
                    },
                }
                for name, attributes in field_attributes(data, variables).items()
            },
            "coordinates": field_attributes(data, dimensions),
            "attributes": {
                **read_metadata(spark, source),
                **provenance(spark, source, history).first().asDict(),
            },
            "fill_collisions": {name: int(count or 0) for name, count in collisions.get.items()},
        }
        write_metadata(spark, staged, metadata)
        storage.delete(f"{staged}/means")
        swap_in(storage, staged, output)
    finally:
        storage.delete(staged)
    return metadata


@dataclass(frozen=True)
class Grid:
    """A written grid: its axes, packed chunk rows and metadata."""

    coordinates: tuple[Coordinates, ...]
    chunks: DataFrame
    metadata: Mapping[str, Any]

    @property
    def variables(self) -> list[str]:
        return list(self.metadata["variables"])

    def values(self) -> DataFrame:
        """Long form with unpacked values, one row per cell, NULL where missing."""
        names = self.variables
        zipped = self.chunks.select(
            ROW, BLOCK, F.arrays_zip(*[F.col(f"`{name}`").alias(name) for name in names]).alias(CELLS)
        )
        cells = dense_cells(zipped, self.coordinates, names, self.metadata["chunk_cells"])
        precision = self.metadata["precision"]
        return cells.withColumns({name: unpack(F.col(f"`{name}`"), precision) for name in names})


def open_grid(spark: SparkSession, path: str) -> Grid:
    metadata = read_metadata(spark, path)
    axes = tuple(read_coordinates(spark, f"{path}/coordinates/{d}", d) for d in metadata["dimensions"])
    return Grid(axes, spark.read.parquet(f"{path}/cells"), metadata)

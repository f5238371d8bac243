"""Merge any number of Parquet inputs into one published dataset."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from tidemark.errors import NothingToMergeError
from tidemark.functions.casts import apply_schema
from tidemark.operators.dedup import dedup_by_key, dedup_sorted, distinct_rows, sort_order
from tidemark.schema import TableSchema
from tidemark.sources.parquet import find_inputs, scan_parquet
from tidemark.sources.publish import DEFAULT_CODEC, DEFAULT_LEVEL, publish, read_metadata
from tidemark.sources.storage import Storage

def merge_frame(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    enforce_unique: bool = False,
    schema: TableSchema | T.StructType | None = None,
    prefer: Sequence[str | Column] = (),
    many_per_key: bool = False,
    ordered: bool = False,
    wide_rows: bool = False,
) -> DataFrame:
    """Keys given: one row per key (whatever ``enforce_unique`` says); else unique rows; else all.

    ``prefer`` and ``many_per_key`` are those of ``dedup_by_key``; ``ordered`` also puts a keyed result in the order of
    its keys, without a second exchange.  ``wide_rows`` finds unique rows by digests (``distinct_rows``).  The plan is
    the same at every size.
    """
    if keys:
        unique = dedup_sorted if ordered else dedup_by_key
        merged = unique(df, keys, prefer, many_per_key=many_per_key)
    elif enforce_unique:
        merged = distinct_rows(df, wide_rows)
    else:
        merged = df
    return apply_schema(merged, schema) if schema is not None else merged


def merge_inputs(
    spark: SparkSession, inputs: Sequence[str | os.PathLike], target: str | None = None
) -> list[str]:
    """The paths to merge.  A single input is merged with the existing target."""
    found = find_inputs(spark, inputs)
    if not found:
        raise FileNotFoundError(f"No input was found at {list(inputs)}")
    if len(found) == 1:
        storage = Storage(spark)
        existing = storage.qualified(target) if target and storage.exists(target) else None
        if existing is None or existing == found[0]:
            raise NothingToMergeError(f"Only one input was found: {found[0]}")
        found = [existing, *found]
    return found


def merge_parquet(
    spark: SparkSession,
    inputs: Sequence[str | os.PathLike],
    target: str,
    enforce_unique: bool = False,
    keys: Sequence[str] | None = None,
    schema: TableSchema | T.StructType | None = None,
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
    order: str = "global",
    uniform: bool = False,
    prefer: Sequence[str | Column] = (),
    many_per_key: bool = False,
    wide_rows: bool = False,
) -> None:
    """Merge the inputs and publish the result at ``target``, which may be one of the inputs.

    A keyed merge is sorted by its keys, NULLs last.  ``order="global"`` also orders the files
    among each other, by the one exchange that also brings equal keys together (its ranges cost a pass over the
    input before); ``order="files"`` sorts inside each file only.  Of rows with one key the first by ``prefer`` stays;
    ``many_per_key`` is the faster plan where keys repeat often.
    """
    if order not in ("global", "files"):
        raise ValueError(f"Unknown order: {order}")
    paths = merge_inputs(spark, inputs, target)
    storage = Storage(spark)
    merged = merge_frame(
        scan_parquet(spark, paths, uniform), keys, enforce_unique, schema, prefer, many_per_key, order == "global", wide_rows
    )
    if keys and order == "files":
        merged = merged.sortWithinPartitions(*sort_order(keys))
    metadata = schema.metadata if isinstance(schema, TableSchema) else None
    if metadata is None and storage.is_directory(paths[0]):
        metadata = read_metadata(spark, paths[0])
    publish(merged, target, codec, level, metadata)

"""Parquet sink with staging, save-conflict policy and metadata sidecar.

A dataset is written to a hidden sibling and renamed into place.  Spark cannot overwrite a dataset
it is reading; with staging the target may be one of the inputs.  The rename is atomic on HDFS-like
file systems; on object stores it is a copy, so readers should wait for the job there.  Between the two renames
of a swap there is no target: a reader that lists it just then finds nothing, and the next run completes the swap.

There are no locks.  A writer that finds the target other than it was when it began, because another one has
published meanwhile, raises and leaves the other's dataset in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import ConflictError
from tidemark.sources.storage import Storage, name_of, parent_of

# Fixed defaults of the file format.
DEFAULT_CODEC = "zstd"
DEFAULT_LEVEL = 5
METADATA_DIR = "_table_metadata"

# Fixed names: where each codec reads its level from.
LEVEL_OPTIONS = {
    "zstd": "parquet.compression.codec.zstd.level",
    "brotli": "compression.brotli.quality",
    "gzip": "zlib.compress.level",
}


class OnConflict(Enum):
    ERROR = "error"
    APPEND = "append"
    OVERWRITE = "overwrite"


def check_conflict(storage: Storage, policy: OnConflict, *paths: str) -> None:
    """ERROR: any of the paths existing is an error.  OVERWRITE is left to the final swap."""
    if policy is OnConflict.ERROR:
        existing = [path for path in paths if storage.exists(path)]
        if existing:
            raise ConflictError(f"{existing} already exist: choose to append or to overwrite")


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
    max_records_per_file: int | None = None,
    mode: str = "errorifexists",
    commit_each_task: bool = False,
) -> None:
    """Write a Parquet dataset directory with the given codec and level.

    ``commit_each_task``: each task's files are moved into the dataset when the task ends, not when the job does, where
    the file system's committer can do that; what a job that fails has finished then stays.
    """
    writer = df.write.mode(mode).option("compression", codec)
    if commit_each_task:
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    option = LEVEL_OPTIONS.get(codec.lower())
    if option and level is not None:
        writer = writer.option(option, str(level))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(path)


def staging_path(target: str) -> str:
    return f"{parent_of(target)}/_staging_{name_of(target)}_{uuid.uuid4().hex}"


def _previous_path(target: str) -> str:
    return f"{parent_of(target)}/_previous_{name_of(target)}"


def recover(storage: Storage, target: str) -> None:
    """Undo a swap that stopped half-way: bring the previous dataset back, or drop it if replaced."""
    previous = _previous_path(target)
    if storage.exists(previous):
        if storage.exists(target):
            storage.delete(previous)
        else:
            storage.rename(previous, target)


class _Anything:
    """Stands for any state of a target."""


def swap_in(storage: Storage, staged: str, target: str, expected: object = _Anything) -> None:
    """Make the staged dataset the target; the old target is kept until the new one is in place.

    ``expected``: the target's ``Storage.state`` when the work on the staged dataset began.
    """
    recover(storage, target)
    if expected is not _Anything and storage.state(target) != expected:
        raise ConflictError(f"{target} was changed by another writer meanwhile and is left as it is")
    previous = _previous_path(target)
    replacing = storage.exists(target)
    if replacing:
        storage.rename(target, previous)
    try:
        storage.rename(staged, target)
    except Exception:
        if replacing:
            storage.rename(previous, target)
        raise
    if replacing:
        storage.delete(previous)


def publish(
    df: DataFrame,
    target: str,
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
    metadata: Mapping[str, Any] | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Write ``df`` beside ``target`` and swap it in; ``df`` may read from ``target``.

    Raises ``ConflictError`` if another writer changed the target meanwhile.
    """
    spark = df.sparkSession
    storage = Storage(spark)
    recover(storage, target)
    before = storage.state(target)
    staged = staging_path(target)
    try:
        write_parquet(df, staged, codec, level, max_records_per_file)
        if metadata:
            write_metadata(spark, staged, metadata)
        swap_in(storage, staged, target, before)
    finally:
        storage.delete(staged)


def write_metadata(spark: SparkSession, dataset: str, metadata: Mapping[str, Any]) -> None:
    """Table metadata as a one-row JSON text inside the dataset, hidden from readers of the data."""
    text = spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{dataset.rstrip('/')}/{METADATA_DIR}")


def read_metadata(spark: SparkSession, dataset: str) -> dict[str, Any]:
    """Table metadata of a dataset; empty if it carries none."""
    path = f"{dataset.rstrip('/')}/{METADATA_DIR}"
    if not Storage(spark).exists(path):
        return {}
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else {}

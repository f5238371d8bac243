"""Parquet sources: input paths, strict union of files, checkpoint files."""

from __future__ import annotations

import logging
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.dedup import bag_union
from tidemark.sources.footers import data_files, plain_path, read_footers, root_of, summarise_footers
from tidemark.sources.storage import Storage

LOGGER = logging.getLogger(__name__)

# Fixed name part of the files an extraction hands over for compaction.
CHECKPOINT_SUFFIX = ".checkpoint"


def find_inputs(spark: SparkSession, paths: Sequence[str | os.PathLike]) -> list[str]:
    """Existing files and dataset directories, globs expanded, each once, in the order given."""
    storage = Storage(spark)
    found: dict[str, None] = {}
    for raw in paths:
        if not isinstance(raw, (str, os.PathLike)):
            LOGGER.error("'%s' (%s) is not a path and is skipped", raw, type(raw).__name__)
            continue
        path = os.fspath(raw)
        if any(mark in path for mark in "*?["):
            for match in storage.glob(path):
                found[storage.qualified(match.path)] = None
        elif storage.exists(path):
            found[storage.qualified(path)] = None
        else:
            LOGGER.warning("'%s' does not exist and is not read", path)
    return list(found)


def scan_parquet(spark: SparkSession, paths: Sequence[str], uniform: bool = False) -> DataFrame:
    """All paths as one relation, matched by column name to the schema of the first file.

    Spark takes the schema of *some* file and reads a missing column as NULL.  Here the schema of every file is looked
    up, also of those inside one directory, by one job over their footers: a column the first file has and another lacks
    is an error.  If all files are alike the paths are read by one scan, else those of each schema by one.
    ``uniform=True`` skips the look-up where the caller knows that all files are alike.
    """
    if not paths:
        raise FileNotFoundError("No input path was given")
    if uniform:
        return spark.read.parquet(*paths)
    roots = {plain_path(path): place for place, path in reversed(list(enumerate(paths)))}
    files = sorted(data_files(spark, paths), key=lambda file: (root_of(file, roots), file))
    if len(files) <= 1:
        return spark.read.parquet(*paths)
    found = summarise_footers(spark, files)
    if found.broken:
        path, error = next(iter(sorted(found.broken.items())))
        raise ValueError(f"{len(found.broken)} files cannot be read; {path}: {error}")
    if len(found.examples) == 1:
        (example,) = found.examples.values()
        return spark.read.schema(spark.read.parquet(example).schema).parquet(*paths)
    kind = F.xxhash64("columns").alias("kind")
    kinds = {row["path"]: row["kind"] for row in read_footers(spark, files, found.in_tasks).select("path", kind).collect()}
    groups: dict[tuple[int, str | None], list[str]] = {}
    for file in files:
        groups.setdefault((kinds[file], _partitioned_root(file, paths, roots)), []).append(file)
    return bag_union([_scan_alike(spark, members, root) for (_, root), members in groups.items()])


def _partitioned_root(file: str, paths: Sequence[str], roots: dict[str, int]) -> str | None:
    """The dataset of a file whose directories hold column values; None for any other file."""
    place = root_of(file, roots)
    if place < len(paths) and "=" in plain_path(file)[len(plain_path(paths[place])) :].rpartition("/")[0]:
        return paths[place]
    return None


def _scan_alike(spark: SparkSession, files: Sequence[str], root: str | None) -> DataFrame:
    reader = spark.read.schema(spark.read.parquet(files[0]).schema)
    return (reader.option("basePath", root) if root else reader).parquet(*files)


def checkpoint_paths(spark: SparkSession, working_path: str) -> list[str]:
    """The committed checkpoint datasets ``<working_path>.checkpoint*`` in name order.

    A dataset without Spark's success marker was interrupted while being written and is left out.
    """
    storage = Storage(spark)
    matches = storage.glob(f"{working_path}{CHECKPOINT_SUFFIX}*")
    return [m.path for m in matches if not m.is_directory or storage.exists(f"{m.path}/_SUCCESS")]


def scan_checkpoints(spark: SparkSession, working_path: str) -> DataFrame | None:
    """All checkpoints of a working path as one relation; None if there are none.

    One extraction writes all of them with one schema.
    """
    paths = checkpoint_paths(spark, working_path)
    return scan_parquet(spark, paths, uniform=True) if paths else None

"""Extract a table into a published Parquet dataset, resuming an interrupted run."""

from __future__ import annotations

import functools
import logging
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.errors import EmptySourceError
from tidemark.functions.casts import apply_schema
from tidemark.operators.catalog import collect_keys, find_table, pick_longest, table_columns, unique_keys
from tidemark.operators.dedup import bag_union, dedup_by_key, dedup_sorted, necessary_keys, sorted_by
from tidemark.operators.marks import equal_depth_cuts, read_mark, scan_after, scan_after_or_null
from tidemark.plans.ranges import RangedCheckpoint, is_ranged, read_ranged, start_ranged
from tidemark.plans.attempts import attempt, attempt_catalog
from tidemark.schema import TableSchema, attach_field_metadata, parse_configured_schema, reflected_schema
from tidemark.sources.footers import plain_path, root_of, split_readable
from tidemark.sources.parquet import CHECKPOINT_SUFFIX, checkpoint_paths, scan_checkpoints
from tidemark.sources.publish import (
    DEFAULT_CODEC,
    DEFAULT_LEVEL,
    OnConflict,
    check_conflict,
    publish,
    recover,
    write_parquet,
)
from tidemark.sources.storage import Storage, parent_of
from tidemark.sources.tables import DEFAULT_FETCH_ROWS, TableSource, range_predicates, range_slices

LOGGER = logging.getLogger(__name__)

# Fixed cadence: a checkpoint file closes after this many fetches.
FETCHES_PER_CHECKPOINT = 150

_AGE = "__age"
_SPLITTABLE = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class TableKeys:
    """Unique keys of a table; ``nullable`` are key columns that may hold NULL."""

    keys: tuple[tuple[str, ...], ...]
    nullable: frozenset[str] = frozenset()

    @property
    def longest(self) -> tuple[str, ...] | None:
        return pick_longest(self.keys)

    def may_be_null(self, key: Sequence[str]) -> bool:
        return any(name in self.nullable for name in key)


@dataclass(frozen=True)
class Extraction:
    """What a run did: rows read in this run, the mark it resumed after, ranges written, damaged files left out."""

    rows_read: int
    resumed_after: dict[str, Any] | None
    checkpoints: int
    unreadable: tuple[str, ...] = ()


def resolve_schema(
    source: TableSource, schema_name: str, table_name: str, config_dir: str | None = None
) -> TableSchema:
    """``<config_dir>/<schema>.<table>.json`` if it exists, else the source's own types."""
    if config_dir:
        path = f"{config_dir.rstrip('/')}/{schema_name or 'public'}.{table_name}.json"
        storage = Storage(source.spark)
        if storage.exists(path):
            return parse_configured_schema(storage.read_text(path))
    if source.reflects_types:
        columns = attempt_catalog(source.columns)
        return reflected_schema(table_columns(columns, table_name, schema_name))
    return TableSchema.from_struct(source.scan(schema_name, table_name, DEFAULT_FETCH_ROWS, None).schema)


def resolve_keys(source: TableSource, schema_name: str, table_name: str) -> TableKeys:
    constraints = attempt_catalog(source.constraints)
    found = collect_keys(unique_keys(constraints, source.key_columns(), table_name, schema_name))
    # The columns of a primary key never hold NULL, whatever the catalog view says.
    primary = {name for kind, key in found if kind == "PRIMARY KEY" for name in key}
    candidates = {name for _, key in found for name in key} - primary
    nullable: set[str] = set()
    if candidates:
        rows = table_columns(source.columns(), table_name, schema_name).filter(F.col("is_nullable") == "YES")
        nullable = candidates & {row["column_name"] for row in rows.collect()}
    return TableKeys(tuple(key for _, key in found), frozenset(nullable))


def unique_by_table_keys(
    df: DataFrame, keys: TableKeys, age: str | None = None, ordered: bool = False
) -> DataFrame:
    """One row per key for every key; the lowest ``age`` survives, if such a column is named.

    ``ordered``: in the order of the longest key.  If that is the last key that still finds duplicates, one exchange
    serves both.

    Rows with a NULL in a nullable key all stay, because a database does not count them as
    conflicting either.
    """
    prefer = [age] if age else []
    necessary = necessary_keys(keys.keys)
    for place, key in enumerate(necessary, start=1):
        rule = "distinct" if keys.may_be_null(key) else "group"
        together = ordered and place == len(necessary) and key == keys.longest
        df = (dedup_sorted if together else dedup_by_key)(df, key, prefer, rule)
    if ordered and keys.longest and necessary[-1:] != [keys.longest]:
        df = sorted_by(df, keys.longest)
    return df


def _replaced(existing: DataFrame, extracted: DataFrame, keys: TableKeys) -> DataFrame:
    """Rows of ``existing`` without those that no key compares and ``extracted`` has as well.

    A row with a NULL in every key, read again, would stay twice; as often as it was read again it is
    dropped here, and rows that equal each other in the source stay as often as they are there.
    """
    necessary = necessary_keys(keys.keys)
    if not necessary or not all(keys.may_be_null(key) for key in necessary):
        return existing
    in_key = [functools.reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in key)) for key in necessary]
    unordered = functools.reduce(lambda a, b: a & b, in_key)
    return existing.filter(~unordered).unionByName(
        existing.filter(unordered).exceptAll(extracted.select(*existing.columns).filter(unordered))
    )


def post_process(
    frames: Sequence[DataFrame],
    target: str,
    keys: TableKeys,
    schema: TableSchema,
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
) -> None:
    """Union everything that was read, make it unique, sort it by the longest key and publish.

    Of two rows of one key the one from the earlier frame survives.
    """
    frames = [frames[0], *(_replaced(frame, frames[0], keys) for frame in frames[1:])]
    if len(frames) == 1:
        combined = unique_by_table_keys(frames[0], keys, ordered=True)
    else:
        aged = [frame.withColumn(_AGE, F.lit(age)) for age, frame in enumerate(frames)]
        combined = unique_by_table_keys(bag_union(aged), keys, _AGE, ordered=True).drop(_AGE)
    combined = attach_field_metadata(combined, {f.name: f.metadata for f in schema.fields if f.metadata})
    publish(combined, target, codec, level, schema.metadata)


def _write_checkpoint(
    df: DataFrame, path: str, codec: str, level: int | None, rows_per_file: int
) -> int:
    counted = Observation("extraction")
    write_parquet(
        df.observe(counted, F.count(F.lit(1)).alias("rows")), path, codec, level, rows_per_file, mode="overwrite"
    )
    return counted.get["rows"]


def dump_table(
    source: TableSource,
    schema_name: str,
    table_name: str,
    output: str,
    fetch_rows: int = DEFAULT_FETCH_ROWS,
    on_conflict: OnConflict = OnConflict.ERROR,
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
    config_dir: str | None = None,
    slices: int = 1,
    boundaries: Sequence[Any] | None = None,
    incremental: bool = False,
    keys: TableKeys | None = None,
) -> Extraction:
    """Read a table in parallel and publish it, unique by its keys and sorted by the longest one.

    The table is read in ``slices`` ranges of the longest key, of about equal size whatever its type (or of its first
    column, cut at the given ``boundaries``).  A frame is scanned once for all of them: the ranges are the tasks of
    one write, each is committed by itself, and a run that finds the ranges of an interrupted one reads only those that
    are missing.  A database is asked for one range at a time, in ascending order, one committed dataset each.  Then,
    what came after the largest committed key is read.  Without a key there is one range, so a committed checkpoint is
    the whole read and is published as it is.

    APPEND keeps the existing output's rows, but a row read again replaces its earlier state.
    ``incremental`` then also skips source rows up to the largest key of that output.  Files of an interrupted run or
    of the output that cannot be read any more are left out and reported, and what they held is read again: no mark is
    taken from an output with damaged files.

    ``keys`` are looked up in the source's catalog unless given; a database user that may only read
    does not see constraints there.
    """
    spark: SparkSession = source.spark
    storage = Storage(spark)
    recover(storage, output)
    working = f"{parent_of(output)}/{source.host}/{schema_name}.{table_name}"
    leftovers = [found.path for found in storage.glob(f"{working}{CHECKPOINT_SUFFIX}*")]
    check_conflict(storage, on_conflict, output, *leftovers)

    find_table(attempt_catalog(source.tables), table_name, schema_name)
    schema = resolve_schema(source, schema_name, table_name, config_dir)
    keys = keys or resolve_keys(source, schema_name, table_name)
    key = keys.longest

    resuming = on_conflict is OnConflict.APPEND
    existing, unreadable = _existing(spark, output, schema) if resuming else (None, [])
    start_over = not resuming or bool(unreadable and incremental)
    committed, started, damaged = ([], [], []) if start_over else _usable(spark, working, leftovers)
    unreadable += damaged
    for path in leftovers:
        if path not in committed and path not in {ranged.path for ranged in started}:
            storage.delete(path)

    rows_read, ranges_written = 0, 0
    open_ended = True
    for ranged in started:
        data = attempt(lambda: source.scan(schema_name, table_name, fetch_rows, None, (None, None)))
        part = _after(data, ranged.after, keys, bool(ranged.number))
        open_ended = open_ended and ranged.last_range_is_complete
        ranges_written += ranged.missing_ranges
        rows_read += ranged.fill(apply_schema(part, schema, missing="null", extra="drop"), codec, level)
        committed.append(ranged.path)
    committed.sort()

    mark = read_mark(scan_checkpoints(spark, working), key) if committed else None
    if mark is None and incremental and not unreadable:
        mark = read_mark(existing, key)
    complete = bool(committed) and (not key or not open_ended)
    number = 1 + max([int(path.rpartition("_")[2]) for path in committed if path.rpartition("_")[2].isdigit()], default=-1)
    path = f"{working}{CHECKPOINT_SUFFIX}_{number:05}"
    whole = key if key and not keys.may_be_null(key) else key[:1] if key else ()

    if not complete and (source.splits_reads or not key or (slices < 2 and not boundaries)):
        for place, part in enumerate(
            _parts_of_source(source, schema_name, table_name, fetch_rows, schema, keys, whole, mark, bool(committed), slices, boundaries)
        ):
            typed = apply_schema(part, schema, missing="null", extra="drop")
            path = f"{working}{CHECKPOINT_SUFFIX}_{number + place:05}"
            rows_read += _write_checkpoint(typed, path, codec, level, fetch_rows * FETCHES_PER_CHECKPOINT)
            ranges_written += 1
    elif not complete:
        data = attempt(lambda: source.scan(schema_name, table_name, fetch_rows, None, (None, None)))
        typed = apply_schema(_after(data, mark, keys, bool(committed)), schema, missing="null", extra="drop")
        if boundaries is None:
            cuts = equal_depth_cuts(typed, whole, slices)
        else:
            cuts = [{key[0]: cut} for cut in boundaries if not mark or cut > mark[key[0]]]
        ranged = start_ranged(spark, path, typed, whole, cuts, mark, number)
        rows_read += ranged.fill(typed, codec, level)
        ranges_written += len(cuts) + 1
    LOGGER.info("%d rows read from %s.%s", rows_read, schema_name, table_name)
    if rows_read == 0 and not committed:
        _clean(storage, working)
        raise EmptySourceError(f"There is nothing to read from '{schema_name}.{table_name}'")

    extracted = scan_checkpoints(spark, working)
    frames = [extracted] if existing is None else [extracted, existing]
    post_process(frames, output, keys, schema, codec, level)
    _clean(storage, working)
    return Extraction(rows_read, mark, ranges_written, tuple(unreadable))


def _after(data: DataFrame, mark: dict[str, Any] | None, keys: TableKeys, key_ranges_read: bool) -> DataFrame:
    if keys.longest and keys.may_be_null(keys.longest):
        return scan_after_or_null(data, mark, key_ranges_read)
    return scan_after(data, mark)


def _existing(spark: SparkSession, output: str, schema: TableSchema) -> tuple[DataFrame | None, list[str]]:
    """The rows of an output that can still be read, and the files that cannot."""
    if not Storage(spark).exists(output):
        return None, []
    readable, broken = split_readable(spark, [output])
    for path, error in broken.items():
        LOGGER.warning("%s cannot be read and is left out: %s", path, error)
    if not readable:
        return None, sorted(broken)
    rows = spark.read.parquet(*(readable if broken else [output]))
    return apply_schema(rows, schema, missing="null", extra="drop"), sorted(broken)


def _usable(
    spark: SparkSession, working: str, leftovers: Sequence[str]
) -> tuple[list[str], list[RangedCheckpoint], list[str]]:
    """What an interrupted run left: committed checkpoints, ranged ones with ranges missing, and damaged files.

    Ranges whose file is damaged count as missing.  After a checkpoint without ranges that is damaged nothing is
    used: its rows are read again, and so is all that was read after it.
    """
    storage = Storage(spark)
    complete = checkpoint_paths(spark, working)
    candidates = sorted(path for path in leftovers if path in complete or is_ranged(spark, path))
    if not candidates:
        return [], [], []
    _, broken = split_readable(spark, candidates)
    roots = {plain_path(path): place for place, path in enumerate(candidates)}
    damaged: dict[int, list[str]] = {}
    for path, error in broken.items():
        LOGGER.warning("%s cannot be read and is left out: %s", path, error)
        damaged.setdefault(root_of(path, roots), []).append(path)
    committed: list[str] = []
    started: list[RangedCheckpoint] = []
    for place, path in enumerate(candidates):
        ranged = is_ranged(spark, path)
        if place in damaged and not ranged:
            break
        if place in damaged or path not in complete:
            for file in damaged.get(place, ()):
                storage.delete(file)
            storage.delete(f"{path}/_SUCCESS")
            started.append(read_ranged(spark, path))
        else:
            committed.append(path)
    return committed, started, sorted(broken)


def _parts_of_source(
    source: TableSource,
    schema_name: str,
    table_name: str,
    fetch_rows: int,
    schema: TableSchema,
    keys: TableKeys,
    whole: Sequence[str],
    mark: dict[str, Any] | None,
    resumed: bool,
    slices: int,
    boundaries: Sequence[Any] | None,
) -> Iterator[DataFrame]:
    """The rows after the mark as one frame a range, each read in parallel."""
    key = keys.longest
    if not key:
        yield attempt(lambda: source.scan(schema_name, table_name, fetch_rows, None, (None, None)))
        return
    by_number = isinstance(schema.struct[key[0]].dataType, _SPLITTABLE)
    if source.splits_reads and not by_number and boundaries is None:
        # The database compares, in its own order, by conditions that it is given as text.
        cuts = source.cuts(schema_name, table_name, whole, max(slices, 1) * source.partitions)
        conditions = range_predicates(cuts)
        each = -(-len(conditions) // max(slices, 1))
        for start in range(0, len(conditions), each):
            data = attempt(lambda: source.scan_by_predicates(schema_name, table_name, conditions[start : start + each], fetch_rows))
            yield _after(data, mark, keys, resumed)
        return
    low = high = None
    if by_number and source.splits_reads:
        low, high = source.bounds(schema_name, table_name, key[0])
        if mark and low is not None:
            low = max(low, mark[key[0]])
    if boundaries is None:
        found = source.cuts(schema_name, table_name, key[:1], slices) if by_number and slices > 1 else []
        boundaries = [cut[key[0]] for cut in found]
    if mark:
        boundaries = [cut for cut in boundaries if cut > mark[key[0]]]
    edges = [low, *boundaries, high]
    for number in range(len(boundaries) + 1):
        # The parallel split covers the range that is read, not the whole table.
        split_range = (edges[number], edges[number + 1])
        data = attempt(lambda: source.scan(schema_name, table_name, fetch_rows, key[0] if by_number else None, split_range))
        part = _after(data, mark, keys, resumed)
        if boundaries:
            part = part.filter(range_slices(key[0], boundaries, data.schema[key[0]].dataType)[number])
        yield part


def _clean(storage: Storage, working: str) -> None:
    """Drop the run's checkpoints, and the working directory once nothing else is in it."""
    for found in storage.glob(f"{working}{CHECKPOINT_SUFFIX}*"):
        storage.delete(found.path)
    if not storage.children(parent_of(working)):
        storage.delete(parent_of(working))

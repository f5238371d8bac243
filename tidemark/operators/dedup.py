"""Keyed de-duplication, whole-row distinct and bag union."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.casts import strict_cast
from tidemark.session import scratch_path

_OWN_NUMBER = "__own_number"
_KEY_HASH = "__key_hash"
# Distinct keys that are followed while frequent ones are looked for: a key with more than about one in half as
# many rows is found.
TRACKED_KEYS = 8_192
# A key counts as frequent from this share of an even partition on.
FREQUENT_SHARE = 0.25
# Digests of repeated rows that are broadcast, at most: 16 bytes each, and as much again for looking them up.
BROADCAST_DIGESTS = 1 << 20


def is_orderable(data_type: T.DataType) -> bool:
    """Whether Spark can compare and hash values of the type."""
    if isinstance(data_type, T.ArrayType):
        return is_orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(is_orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _tie_order(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if not is_orderable(field.dataType):
        column = F.xxhash64(F.to_json(F.struct(column)))
    return column.asc_nulls_last()


def sort_order(keys: Sequence[str]) -> list[Column]:
    """Ascending on every key, NULLs last."""
    return [F.col(f"`{key}`").asc_nulls_last() for key in keys]


def sorted_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*sort_order(keys))


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str | Column] = (),
    null_keys: str = "group",
    many_per_key: bool = False,
) -> DataFrame:
    """Exactly one row per key.

    The survivor is the first row by ``prefer`` and then by all other columns ascending, NULLs
    last: a total order over the row, so the result does not depend on the order of arrival.
    Either plan below reduces each scan task's rows to one per key *before* the shuffle, so of a key
    that holds a large share of all rows only one row per task is sent.

    ``many_per_key`` chooses the plan, not the result: by default rows are ranked, which is the
    faster one where most keys are unique; with many rows per key a minimum is, because it sorts by
    the keys only.

    ``null_keys``: with ``"group"`` rows with equal keys form one group even where a key part is
    NULL; with ``"distinct"`` (the rule of an SQL UNIQUE constraint) such rows never conflict and all
    stay, equal ones too.  They are told apart by a number of their own beside the keys, so there is
    one scan and one shuffle however many rows have a NULL.
    """
    if not keys:
        raise ValueError("De-duplication by key needs at least one key column")
    if null_keys not in ("group", "distinct"):
        raise ValueError(f"Unknown rule for NULL keys: {null_keys}")
    if null_keys == "distinct" and any(df.schema[key].nullable for key in keys):
        has_null = functools.reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in keys))
        own = F.when(has_null, F.monotonically_increasing_id())
        numbered = df.withColumn(_OWN_NUMBER, own)
        return dedup_by_key(numbered, [*keys, _OWN_NUMBER], prefer, many_per_key=many_per_key).drop(_OWN_NUMBER)

    ties = [f for f in df.schema.fields if f.name not in set(keys)]
    by_minimum = all(isinstance(p, str) for p in prefer) and all(is_orderable(f.dataType) for f in ties)
    if many_per_key and ties and by_minimum:
        return _smallest_row(df, keys, prefer)
    return _first_ranked_row(df, keys, [_as_order(p) for p in prefer], ties)


@dataclass(frozen=True)
class KeyProfile:
    """Hashes of frequent keys, and the key columns that hold a NULL."""

    frequent: tuple[int, ...]
    with_null: frozenset[str]


def profile_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> KeyProfile:
    """Which keys hold more than ``FREQUENT_SHARE`` of an even share of the rows over ``partitions``, and which are NULL.

    One pass over the key columns only, with a frequent-items sketch in each task; its size, and so the list, is
    bounded by ``TRACKED_KEYS``.  The sketch over-estimates by less than a row in ``TRACKED_KEYS / 2``: keys too many cost a
    little time, and keys rarer than that cannot unbalance fewer partitions than so many.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = min(TRACKED_KEYS // 2, max(1, int(partitions / FREQUENT_SHARE)))
    nullable = [key for key in keys if df.schema[key].nullable]
    row = (
        df.select(_key_hash(keys).alias(_KEY_HASH), *[F.col(f"`{key}`").isNull().alias(f"{k}") for k, key in enumerate(nullable)])
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"approx_top_k({_KEY_HASH}, {listed}, {TRACKED_KEYS})").alias("top"),
            *[F.max(f"{k}").alias(f"null{k}") for k in range(len(nullable))],
        )
        .first()
    )
    least = max(FREQUENT_SHARE * row["rows"] / partitions, 2 * row["rows"] / TRACKED_KEYS, 2)
    return KeyProfile(
        tuple(found["item"] for found in row["top"] or [] if found["count"] > least),
        frozenset(key for k, key in enumerate(nullable) if row[f"null{k}"]),
    )


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{key}`") for key in keys])


def dedup_sorted(
    df: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str | Column] = (),
    null_keys: str = "group",
    many_per_key: bool = False,
) -> DataFrame:
    """``dedup_by_key`` in the order of ``sorted_by(keys)``, also from one partition to the next.

    Rows are exchanged once: ranges of the keys bring equal keys together as well as hashes do, so the exchange that
    orders the result also serves the choice of the survivor.  Rows of frequent keys, which one range would
    gather, are reduced in their scan tasks first; they are found by ``profile_keys``.

    ``many_per_key`` is the plan for keys that mostly repeat: all rows are reduced in their scan tasks, and only the
    unique ones are put in order.
    """
    if many_per_key:
        return sorted_by(dedup_by_key(df, keys, prefer, null_keys, many_per_key), keys)
    if not keys:
        raise ValueError("De-duplication by key needs at least one key column")
    if null_keys not in ("group", "distinct"):
        raise ValueError(f"Unknown rule for NULL keys: {null_keys}")
    profile = profile_keys(df, keys)
    if profile.frequent:
        is_frequent = _key_hash(keys).isin(*profile.frequent)
        reduced = dedup_by_key(df.filter(is_frequent), keys, prefer, null_keys)
        df = df.filter(~is_frequent).unionByName(reduced)

    order: list[str] = []
    # A flag before a key that has NULLs puts them last; the window sorts by flag and key, so it leaves that order.
    for place, key in enumerate(keys):
        if key in profile.with_null:
            order.append(f"__absent{place}")
        order.append(key)
    flags = {f"__absent{place}": F.col(f"`{key}`").isNull() for place, key in enumerate(keys) if key in profile.with_null}
    flagged = df.withColumns(flags) if flags else df
    columns = [F.col(f"`{name}`") for name in order]
    own: list[Column] = []
    if null_keys == "distinct" and flags:
        has_null = functools.reduce(lambda a, b: a | b, (F.col(name) for name in flags))
        flagged = flagged.withColumn(_OWN_NUMBER, F.when(has_null, F.monotonically_increasing_id()))
        own = [F.col(_OWN_NUMBER)]
    ties = [f for f in df.schema.fields if f.name not in set(keys)]
    ranked = [_as_order(p) for p in prefer] + [_tie_order(f) for f in ties] or sort_order(keys)
    window = Window.partitionBy(*columns, *own).orderBy(*ranked)
    first = (
        flagged.repartitionByRange(*columns)
        .withColumn("__rank", F.row_number().over(window))
        .filter(F.col("__rank") == 1)
        .sortWithinPartitions(*columns)
    )
    return first.select(*[F.col(f"`{name}`") for name in df.columns])


def _smallest_row(df: DataFrame, keys: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """The minimum of all other columns as one struct: partial and final aggregation, sorted by the
    keys only.  A struct puts NULLs first, hence the flag before each column that may be NULL."""
    by_name = {f.name: f for f in df.schema.fields}
    order = [*prefer, *[name for name in df.columns if name not in {*keys, *prefer}]]
    parts = []
    for position, name in enumerate(order):
        if by_name[name].nullable:
            parts.append(F.col(f"`{name}`").isNull().alias(f"absent{position}"))
        parts.append(F.col(f"`{name}`").alias(f"value{position}"))
    smallest = df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(F.min(F.struct(*parts)).alias("__row"))
    source = {name: f"__row.value{position}" for position, name in enumerate(order)}
    return smallest.select(
        *[
            F.col(source.get(f.name, f"`{f.name}`")).alias(f.name, metadata=f.metadata or {})
            for f in df.schema.fields
        ]
    )


def _first_ranked_row(
    df: DataFrame, keys: Sequence[str], preferred: list[Column], ties: list[T.StructField]
) -> DataFrame:
    """``row_number() = 1``, which Catalyst turns into a group limit on both sides of the shuffle."""
    rank = "__rank"
    # A table of key columns only still needs some order.
    order = preferred + [_tie_order(f) for f in ties] or sort_order(keys)
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _as_order(preference: str | Column) -> Column:
    return preference if isinstance(preference, Column) else F.col(f"`{preference}`").asc_nulls_last()


def necessary_keys(key_sets: Sequence[Sequence[str]]) -> list[tuple[str, ...]]:
    """Key sets that can still find duplicates when applied in the given order.

    Rows unique by a key are unique by any larger set of columns, so a later superset of an
    earlier key is skipped, and with it a shuffle of the whole table.
    """
    kept: list[tuple[str, ...]] = []
    for key_set in key_sets:
        if key_set and not any(set(earlier) <= set(key_set) for earlier in kept):
            kept.append(tuple(key_set))
    return kept


def dedup_by_keys(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    prefer: Sequence[str | Column] = (),
    null_keys: str = "group",
) -> DataFrame:
    """One row per key for each key set in turn, each applied to the result of the one before."""
    return functools.reduce(
        lambda d, keys: dedup_by_key(d, keys, prefer, null_keys), necessary_keys(key_sets), df
    )


def distinct_rows(df: DataFrame, wide: bool = False) -> DataFrame:
    """Each distinct row once.

    ``wide``: for rows with long texts or values.  Only a digest of 128 bits of each row is shuffled, to find the digests
    that occur again; a row whose digest is alone has no equal and stays where it is, and rows of the others are
    compared whole.  ``df`` is read twice more.  The digests are broadcast as long as they are at most
    ``BROADCAST_DIGESTS``; beyond that most rows repeat, and all are shuffled as without ``wide``.
    """
    if not wide:
        return df.distinct()
    columns = [F.col(f"`{name}`") for name in df.columns]
    digest = {f"__digest{seed}": F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)}
    names = list(digest)
    counted = df.select(*[column.alias(name) for name, column in digest.items()]).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(df.sparkSession, "digests")
    counted.where("n > 1").drop("n").write.parquet(path)
    repeated = df.sparkSession.read.schema("__digest1 long, __digest2 long").parquet(path)
    found = repeated.count()
    if found > BROADCAST_DIGESTS:
        return df.distinct()
    if not found:
        return df
    marked = df.withColumns(digest)
    alone = marked.join(F.broadcast(repeated), names, "left_anti").drop(*names)
    again = marked.join(F.broadcast(repeated), names, "left_semi").drop(*names)
    return alone.unionByName(again.distinct())


def bag_union(frames: Sequence[DataFrame], strict: bool = True) -> DataFrame:
    """All rows of all frames, matched by column name.

    Strict: the first frame fixes columns and types, further columns are dropped and a missing
    one, or a value that does not fit the first frame's type, is an error.  Otherwise missing columns become NULL and further ones are kept.
    """
    if not frames:
        raise ValueError("A union needs at least one input")
    first = frames[0]
    if not strict:
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    aligned = [first]
    for position, frame in enumerate(frames[1:], start=2):
        missing = [name for name in first.columns if name not in frame.columns]
        if missing:
            raise ValueError(f"Input {position} lacks the columns {missing}")
        types = {f.name: f.dataType for f in frame.schema.fields}
        aligned.append(
            frame.select(
                *[strict_cast(f.name, types[f.name], f.dataType).alias(f.name) for f in first.schema.fields]
            )
        )
    return functools.reduce(DataFrame.unionByName, aligned)

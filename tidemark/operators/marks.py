"""High-water marks and keyset scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keyset import after_mark, at_or_after, typed_literal

# Keys drawn to place cuts: with so many a part, a part's size is off by some per cent.
KEYS_PER_PART = 400
LEAST_SAMPLE = 20_000


def high_water_mark(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The lexicographically largest key tuple as a frame of at most one row.

    Only the key columns are read, and each task keeps one row (top-1), so nothing is shuffled.
    A NULL key part sorts below every value.
    """
    order = [F.col(f"`{key}`").desc_nulls_last() for key in keys]
    return df.select(*[F.col(f"`{key}`") for key in keys]).orderBy(*order).limit(1)


def read_mark(df: DataFrame | None, keys: Sequence[str] | None) -> dict[str, Any] | None:
    """The mark as ``{key: value}``; None without data, without keys or without rows."""
    if df is None or not keys:
        return None
    row = high_water_mark(df, keys).first()
    return None if row is None else {key: row[key] for key in keys}


def scan_after(df: DataFrame, mark: Mapping[str, Any] | None) -> DataFrame:
    """Rows after ``mark``; all rows if there is no mark."""
    return df if not mark else df.filter(after_mark(mark, df.schema))


def scan_after_or_null(
    df: DataFrame, mark: Mapping[str, Any] | None, key_ranges_read: bool = False
) -> DataFrame:
    """Rows after ``mark`` and those the mark cannot order because a key part is NULL.

    ``key_ranges_read``: whole ranges of the first key column up to the mark were read, NULLs of that
    column with the first range.  Then only NULLs in later parts beyond the mark's first value are left.
    """
    if not mark:
        return df
    predicate = after_mark(mark, df.schema)
    first, *rest = mark
    for key in rest if key_ranges_read else mark:
        unordered = F.col(f"`{key}`").isNull()
        if key_ranges_read:
            unordered = unordered & (F.col(f"`{first}`") > typed_literal(mark[first], df.schema[first].dataType))
        predicate = predicate | unordered
    return df.filter(predicate)


def equal_depth_cuts(df: DataFrame, keys: Sequence[str], parts: int) -> list[dict[str, Any]]:
    """Ascending key tuples that cut the rows into at most ``parts`` ranges of about equal size, whatever the keys' types.

    The cuts are quantiles of a random sample of the keys: one pass over the key columns, in which each task keeps as
    many rows as the whole sample has, and a sort of the sample.  With fewer rows than that they are exact.  Keys
    that begin with NULL are before all cuts.
    """
    if parts < 2:
        return []
    columns = [F.col(f"`{key}`") for key in keys]
    drawn = df.select(*columns).where(columns[0].isNotNull()).orderBy(F.rand(17)).limit(max(LEAST_SAMPLE, KEYS_PER_PART * parts))
    found = [tuple(row) for row in drawn.orderBy(*[c.asc_nulls_first() for c in columns]).collect()]
    cuts: list[tuple] = []
    for part in range(1, parts):
        at = len(found) * part // parts
        if at and found[at] != found[0] and None not in found[at] and (not cuts or found[at] != cuts[-1]):
            cuts.append(found[at])
    return [dict(zip(keys, cut)) for cut in cuts]


def range_number(cuts: Sequence[Mapping[str, Any]], df: DataFrame) -> Column:
    """How many of the ascending cuts a row is at or after: a binary search, written out as an expression."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at_or_after(cuts[middle], df.schema), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(cuts))


def in_ranges(df: DataFrame, cuts: Sequence[Mapping[str, Any]], chosen: Sequence[int]) -> DataFrame:
    """Rows of the ranges with these numbers, as one condition on the first key column that sources can evaluate, and an exact one."""
    chosen = sorted(set(chosen))
    if len(chosen) == len(cuts) + 1:
        return df
    first = next(iter(cuts[0]))
    key, data_type = F.col(f"`{first}`"), df.schema[first].dataType
    coarse: Column = F.lit(False)
    for number in chosen:
        bound = F.lit(True)
        if number:
            bound = bound & (key >= typed_literal(cuts[number - 1][first], data_type))
        if number < len(cuts):
            below = key <= typed_literal(cuts[number][first], data_type)
            bound = bound & (below if number else below | key.isNull())
        coarse = coarse | bound
    return df.where(coarse & range_number(cuts, df).isin(*chosen))

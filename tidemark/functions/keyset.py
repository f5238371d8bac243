"""Keyset predicate: rows that come after a given key tuple."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, functions as F, types as T


def typed_literal(value: Any, data_type: T.DataType | None) -> Column:
    """A literal of exactly the column's type, so that the comparison needs no cast on the column.

    A cast around the column would keep the predicate from reaching the source.  Times without zone
    go through text: a Python ``datetime`` literal would be shifted by the process's own zone.
    """
    if data_type is None:
        return F.lit(value)
    if isinstance(data_type, T.TimestampNTZType) and isinstance(value, datetime.datetime):
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)


def after_mark(mark: Mapping[str, Any], schema: T.StructType | None = None) -> Column:
    """``(k1, …, kn) > (v1, …, vn)`` as comparisons of single columns.

    Written as ``k1 >= v1 AND (k1 > v1 OR (k1 = v1 AND …))``: unlike a struct comparison every part
    is pushed into the scan, and the leading range lets a database use its key index and Parquet
    skip row groups.  A NULL key part makes the predicate NULL, as in SQL.
    """
    if not mark:
        raise ValueError("A keyset predicate needs at least one key column")
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    predicate: Column | None = None
    for name in reversed(list(mark)):
        column = F.col(f"`{name}`")
        value = typed_literal(mark[name], types.get(name))
        if predicate is None:
            predicate = column > value
        else:
            predicate = (column >= value) & ((column > value) | ((column == value) & predicate))
    return predicate


def at_or_after(cut: Mapping[str, Any], schema: T.StructType | None = None) -> Column:
    """``(k1, …, kn) >= (v1, …, vn)``; never NULL: a row that a NULL key part leaves open counts as before the cut."""
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    predicate: Column | None = None
    for name in reversed(list(cut)):
        column, value = F.col(f"`{name}`"), typed_literal(cut[name], types.get(name))
        predicate = column >= value if predicate is None else (column > value) | ((column == value) & predicate)
    return F.coalesce(predicate, F.lit(False))

"""Provenance time stamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed format: minutes and numeric zone offset.
STAMP_FORMAT = "yyyy-MM-dd HH:mmZ"


def timestamp_text(moment: Column | None = None) -> Column:
    """``moment`` (now, if absent) as text in the session's time zone."""
    return F.date_format(F.current_timestamp() if moment is None else moment, STAMP_FORMAT)

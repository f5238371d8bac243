"""Fixed-point packing of floating values into 32-bit integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the integer that stands for a missing cell.
FILL_VALUE = -999


def scale_factor(precision: int = 2) -> float:
    """The value of one packed step."""
    if precision < 0:
        raise ValueError("The precision must be 0 or more")
    return float(10**-precision)


def _steps(value: Column, precision: int) -> Column:
    # Narrow first: the stored precision is that of a 32-bit float.  rint rounds halves to even.
    return F.rint(value.cast("float").cast("double") / F.lit(scale_factor(precision)))


def _missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def pack(value: Column, precision: int = 2) -> Column:
    """Number of ``10**-precision`` steps as an int; missing (NULL or NaN) becomes ``FILL_VALUE``.

    A value beyond the 32-bit range raises, whatever the session's ANSI setting.
    """
    steps = _steps(value, precision)
    fits = (steps >= F.lit(-(2.0**31))) & (steps < F.lit(2.0**31))
    overflow = F.raise_error(
        F.concat(F.lit("value does not fit a packed 32-bit cell: "), value.cast("string"))
    ).cast("int")
    return F.when(_missing(value), F.lit(FILL_VALUE)).when(fits, steps.cast("int")).otherwise(overflow)


def is_fill_collision(value: Column, precision: int = 2) -> Column:
    """True where a real value packs to the fill value and would read back as missing."""
    return F.coalesce(~_missing(value) & (_steps(value, precision) == F.lit(float(FILL_VALUE))), F.lit(False))


def unpack(packed: Column, precision: int = 2) -> Column:
    """The double a packed cell stands for; the fill value becomes NULL."""
    return F.when(packed != F.lit(FILL_VALUE), packed * F.lit(scale_factor(precision)))

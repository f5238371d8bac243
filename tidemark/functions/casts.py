"""Casts that fail instead of changing a value."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.schema import TableSchema, TypedField

_EXACT_WIDENINGS: dict[type, tuple[type, ...]] = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampType, T.TimestampNTZType),
}
# Every text that parses as a number starts like this; "inf" and "NaN" are fractional numbers.
_INTEGER_START = r"^[\x00-\x20]*[-+.0-9]"
_NUMBER_START = r"^[\x00-\x20]*[-+.0-9iInN]"
_INFINITE_TEXT = r"^[\x00-\x20]*[-+]?inf"
_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_MICROS_PER_UNIT = {"s": 1_000_000, "ms": 1_000, "us": 1}


def _always_safe(source: T.DataType, target: T.DataType) -> bool:
    if source == target or (isinstance(target, T.StringType) and not isinstance(source, T.BinaryType)):
        return True
    return isinstance(target, _EXACT_WIDENINGS.get(type(source), ()))


def _needs_round_trip(source: T.DataType, target: T.DataType) -> bool:
    """Every cast that can change a value silently: all but exact widenings and reading text.

    Text is parsed, and many texts mean one value, so it does not come back as it was.  A double may lose
    digits as a float; that is accepted.
    """
    if isinstance(source, T.StringType) or (isinstance(source, T.DoubleType) and isinstance(target, T.FloatType)):
        return False
    return source != target and not isinstance(target, _EXACT_WIDENINGS.get(type(source), ()))


def _comes_back(source: T.DataType, target: T.DataType) -> bool:
    """Whether the target can be cast to the source again; intervals are made from numbers by their unit."""
    atomic = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if not (isinstance(source, atomic) and isinstance(target, atomic)):
        return False
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(source, times) == isinstance(target, times)


def _becomes_infinite(column: Column, casted: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """True where a finite value is beyond the range of a float or double; None where that cannot be."""
    if not isinstance(target, (T.FloatType, T.DoubleType)):
        return None
    infinite = F.abs(casted) == F.lit(float("inf"))
    if isinstance(source, T.StringType):
        return infinite & ~F.lower(column).rlike(_INFINITE_TEXT)
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return infinite & (F.abs(column) != F.lit(float("inf")))
    return infinite


def _raw_cast(column: Column, source: T.DataType, field: TypedField) -> Column:
    target = field.data_type
    if isinstance(target, T.DayTimeIntervalType) and isinstance(source, T.IntegralType):
        unit = field.arguments.get("unit", "us")
        if unit == "ns":
            seconds = column.cast("decimal(20,0)") / F.lit(1_000_000_000).cast("decimal(10,0)")
        else:
            seconds = (column * F.lit(_MICROS_PER_UNIT[unit])).cast("decimal(20,0)") / F.lit(1_000_000).cast(
                "decimal(7,0)"
            )
        return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    if field.time_of_day and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.extract(F.lit("SECOND"), column)
        return (seconds * 1_000_000).cast("long")
    if source == target:
        return column
    # A failing try_cast throws and catches inside the JVM, which is slow where many values fail, so
    # values that cannot succeed are kept from it.
    if isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        start = _INTEGER_START if isinstance(target, T.IntegralType) else _NUMBER_START
        return F.when(column.rlike(start), column.try_cast(target))
    if isinstance(source, T.NumericType) and isinstance(target, T.IntegralType):
        limit = 2 ** (_INTEGER_BITS[type(target)] - 1)
        if isinstance(source, (T.FloatType, T.DoubleType)):
            fits = (column >= F.lit(float(-limit))) & (column < F.lit(float(limit)))
        else:
            fits = column.between(F.lit(-limit), F.lit(limit - 1))
        return F.when(fits, column.try_cast(target))
    return column.try_cast(target)


def failed_cast(column: Column, source: T.DataType, target: T.DataType | TypedField) -> Column:
    """True where a non-NULL value has no equal value in the target type (never NULL)."""
    field = target if isinstance(target, TypedField) else TypedField("", target)
    if _always_safe(source, field.data_type) and field.valid_range is None:
        return F.lit(False)
    casted = _raw_cast(column, source, field)
    failed = casted.isNull()
    if isinstance(source, T.BinaryType) and isinstance(field.data_type, T.StringType):
        failed = failed | ~F.is_valid_utf8(casted)
    elif not field.time_of_day and _needs_round_trip(source, field.data_type) and _comes_back(source, field.data_type):
        # NaN equals itself in Spark; a boolean comes back as 0 or 1.
        failed = failed | ~F.coalesce(casted.try_cast(source) == column, F.lit(False))
    infinite = _becomes_infinite(column, casted, source, field.data_type)
    if infinite is not None:
        failed = failed | F.coalesce(infinite, F.lit(False))
    if field.valid_range is not None:
        low, high = field.valid_range
        failed = failed | ~F.coalesce(casted.between(F.lit(Decimal(low)), F.lit(Decimal(high))), F.lit(False))
    return column.isNotNull() & failed


def strict_cast(name: str, source: T.DataType, target: T.DataType | TypedField) -> Column:
    """Column ``name`` in the target type; a value that does not fit raises, naming the column.

    The check is part of the expression, so it holds under any ANSI setting and in one pass.
    """
    field = target if isinstance(target, TypedField) else TypedField(name, target)
    column = F.col(f"`{name}`")
    result = _raw_cast(column, source, field)
    if not (_always_safe(source, field.data_type) and field.valid_range is None):
        message = F.concat(
            F.lit(f"column '{name}': "),
            F.coalesce(column.cast("string"), F.lit("NULL")),
            F.lit(f" is not a valid {field.type_name}"),
        )
        result = F.when(failed_cast(column, source, field), F.raise_error(message).cast(field.data_type)).otherwise(
            result
        )
    if not field.nullable:
        missing = F.raise_error(F.lit(f"column '{name}' holds NULL but is declared not nullable"))
        result = F.coalesce(result, missing.cast(field.data_type))
    return result


def apply_schema(
    df: DataFrame, schema: TableSchema | T.StructType, missing: str = "error", extra: str = "error"
) -> DataFrame:
    """All columns of ``schema``, in its order and types, with its field metadata attached.

    ``missing="null"`` fills absent columns with NULL; ``extra="drop"`` drops unnamed ones.
    """
    table_schema = schema if isinstance(schema, TableSchema) else TableSchema.from_struct(schema)
    present = {f.name: f.dataType for f in df.schema.fields}
    absent = [f.name for f in table_schema.fields if f.name not in present]
    surplus = [name for name in present if name not in {f.name for f in table_schema.fields}]
    if absent and missing != "null":
        raise ValueError(f"The schema names columns that the data lacks: {absent}")
    if surplus and extra != "drop":
        raise ValueError(f"The data has columns that the schema lacks: {surplus}")

    columns = []
    for field in table_schema.fields:
        if field.name in present:
            column = strict_cast(field.name, present[field.name], field)
        elif field.nullable:
            column = F.lit(None).cast(field.data_type)
        else:
            raise ValueError(f"Column '{field.name}' is not nullable but the data lacks it")
        columns.append(column.alias(field.name, metadata=field.metadata or {}))
    return df.select(*columns)

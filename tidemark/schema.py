"""Table schemas: configured by a JSON file, or reflected from a database catalog."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field as dataclass_field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.errors import UnsupportedTypeError

MAX_DECIMAL_PRECISION = 38


@dataclass(frozen=True)
class TypedField:
    """One column: Spark type, plus what a Spark type cannot say (value range, unit)."""

    name: str
    data_type: T.DataType
    nullable: bool = True
    metadata: dict[str, Any] | None = None
    valid_range: tuple[int, int] | None = None
    time_of_day: bool = False
    configured_name: str | None = None
    arguments: Mapping[str, Any] = dataclass_field(default_factory=dict)

    @property
    def type_name(self) -> str:
        return self.configured_name or self.data_type.simpleString()


@dataclass(frozen=True)
class TableSchema:
    fields: tuple[TypedField, ...]
    metadata: dict[str, Any] | None = None

    @classmethod
    def from_struct(cls, struct: T.StructType, metadata: dict[str, Any] | None = None) -> TableSchema:
        return cls(
            tuple(TypedField(f.name, f.dataType, f.nullable, dict(f.metadata or {}) or None) for f in struct.fields),
            metadata,
        )

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type, f.nullable, f.metadata) for f in self.fields])


# --------------------------------------------------------------------------- configured types


def _plain(data_type: T.DataType, **extra: Any) -> Callable[[Mapping[str, Any]], dict[str, Any]]:
    return lambda arguments: {"data_type": data_type, **extra}


def _decimal(arguments: Mapping[str, Any]) -> dict[str, Any]:
    if "precision" not in arguments:
        raise ValueError("A decimal type needs a precision")
    precision, scale = int(arguments["precision"]), int(arguments.get("scale", 0))
    if precision > MAX_DECIMAL_PRECISION:
        raise UnsupportedTypeError(f"decimal({precision},{scale}) has more than {MAX_DECIMAL_PRECISION} digits")
    return {"data_type": T.DecimalType(precision, scale)}


def _timestamp(arguments: Mapping[str, Any]) -> dict[str, Any]:
    return {"data_type": T.TimestampType() if arguments.get("tz") else T.TimestampNTZType()}


# Fixed names: the type names a schema file may use.
CONFIGURED_TYPES: dict[str, Callable[[Mapping[str, Any]], dict[str, Any]]] = {
    "bool": _plain(T.BooleanType()),
    "boolean": _plain(T.BooleanType()),
    "byte": _plain(T.ByteType()),
    "int8": _plain(T.ByteType()),
    "short": _plain(T.ShortType()),
    "int16": _plain(T.ShortType()),
    "int": _plain(T.IntegerType()),
    "integer": _plain(T.IntegerType()),
    "int32": _plain(T.IntegerType()),
    "long": _plain(T.LongType()),
    "int64": _plain(T.LongType()),
    "uint8": _plain(T.ShortType(), valid_range=(0, 2**8 - 1)),
    "uint16": _plain(T.IntegerType(), valid_range=(0, 2**16 - 1)),
    "uint32": _plain(T.LongType(), valid_range=(0, 2**32 - 1)),
    "uint64": _plain(T.DecimalType(20, 0), valid_range=(0, 2**64 - 1)),
    "float16": _plain(T.FloatType()),
    "float": _plain(T.FloatType()),
    "float32": _plain(T.FloatType()),
    "float64": _plain(T.DoubleType()),
    "decimal32": _decimal,
    "decimal64": _decimal,
    "decimal128": _decimal,
    "decimal256": _decimal,
    "date": _plain(T.DateType()),
    "date32": _plain(T.DateType()),
    "date64": _plain(T.DateType()),
    "datetime": _timestamp,
    "timestamp": _timestamp,
    "time": _plain(T.LongType(), time_of_day=True),
    "time32": _plain(T.LongType(), time_of_day=True),
    "time64": _plain(T.LongType(), time_of_day=True),
    "duration": _plain(T.DayTimeIntervalType()),
    "string": _plain(T.StringType()),
    "large_string": _plain(T.StringType()),
    "json": _plain(T.StringType()),
    "binary": _plain(T.BinaryType()),
    "large_binary": _plain(T.BinaryType()),
}


def configured_field(definition: Mapping[str, Any]) -> TypedField:
    type_name = str(definition["datatype"]).lower()
    if type_name not in CONFIGURED_TYPES:
        raise KeyError(f"'{definition['datatype']}' is not a known column type")
    arguments = definition.get("type_arguments") or {}
    return TypedField(
        name=definition["name"],
        nullable=definition.get("nullable", True),
        metadata=definition.get("metadata"),
        configured_name=type_name,
        arguments=arguments,
        **CONFIGURED_TYPES[type_name](arguments),
    )


def parse_configured_schema(text: str) -> TableSchema:
    document = json.loads(text)
    return TableSchema(tuple(configured_field(f) for f in document["fields"]), document.get("metadata"))


# --------------------------------------------------------------------------- reflected types

# Fixed names: database catalog type name -> Spark type.
REFLECTED_TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "integer": T.IntegerType(),
    "int4": T.IntegerType(),
    "smallint": T.ShortType(),
    "int2": T.ShortType(),
    "double precision": T.DoubleType(),
    "float8": T.DoubleType(),
    "float": T.DoubleType(),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampNTZType(),
    "timestamptz": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
    "time": T.TimestampNTZType(),
    "time without time zone": T.TimestampNTZType(),
    "time with time zone": T.TimestampNTZType(),
    "timetz": T.TimestampNTZType(),
    "bytea": T.BinaryType(),
    "uuid": T.StringType(),
    "json": T.StringType(),
    "jsonb": T.StringType(),
    "character": T.StringType(),
    "bpchar": T.StringType(),
    "char": T.StringType(),
    "character varying": T.StringType(),
    "varchar": T.StringType(),
    "text": T.StringType(),
}


def reflected_type(
    column_name: str,
    type_name: str,
    element_name: str | None = None,
    length: int | None = None,
    precision: int | None = None,
    scale: int | None = None,
) -> T.DataType:
    """The Spark type of a catalog column; ``element_name`` is an array's element type."""
    name = type_name.lower()
    if name == "array":
        if not element_name:
            raise UnsupportedTypeError(f"Column '{column_name}' is an array of unknown elements")
        element = element_name.lower().lstrip("_")
        return T.ArrayType(reflected_type(column_name, element, precision=precision, scale=scale))
    if name in ("bit", "bit varying"):
        if name == "bit" and (length or 1) == 1:
            return T.BooleanType()
        raise UnsupportedTypeError(f"Column '{column_name}' holds more than one bit")
    if name in ("numeric", "decimal"):
        if precision is None or precision > MAX_DECIMAL_PRECISION:
            raise UnsupportedTypeError(f"Column '{column_name}' is a numeric without a precision up to 38")
        return T.DecimalType(precision, scale or 0)
    if name not in REFLECTED_TYPES:
        raise UnsupportedTypeError(f"Column '{column_name}' has the unsupported type '{type_name}'")
    return REFLECTED_TYPES[name]


def reflected_schema(catalog_columns: DataFrame) -> TableSchema:
    """Schema of one table from its catalog rows (as ``information_schema.columns`` names them).

    Collects one row per column of a single table, which is bounded by the table's width.
    """
    rows = catalog_columns.orderBy("ordinal_position").collect()
    return TableSchema(
        tuple(
            TypedField(
                row["column_name"],
                reflected_type(
                    row["column_name"],
                    row["data_type"],
                    row["udt_name"],
                    row["character_maximum_length"],
                    row["numeric_precision"],
                    row["numeric_scale"],
                ),
            )
            for row in rows
        )
    )


def schema_report(spark: SparkSession, schema: TableSchema | T.StructType) -> DataFrame:
    """One row per column: position, name, type, nullability and metadata as JSON text."""
    table_schema = schema if isinstance(schema, TableSchema) else TableSchema.from_struct(schema)
    rows = [
        (position, f.name, f.data_type.simpleString(), f.nullable, json.dumps(f.metadata or {}, sort_keys=True))
        for position, f in enumerate(table_schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean, metadata string")


def attach_field_metadata(df: DataFrame, metadata: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Set the metadata of the named columns; it is stored with the column in Parquet."""
    for name, values in metadata.items():
        df = df.withMetadata(name, dict(values))
    return df


def columns_except(df: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """All columns but the named ones; a name the data lacks is ignored."""
    kept = [F.col(f"`{name}`") for name in df.columns if name not in set(excluded)]
    return df.select(*kept)

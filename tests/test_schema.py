import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from helpers import error_text, rows
from tidemark.errors import UnsupportedTypeError
from tidemark.functions.casts import apply_schema, failed_cast, strict_cast
from tidemark.schema import (
    CONFIGURED_TYPES,
    TableSchema,
    TypedField,
    attach_field_metadata,
    columns_except,
    configured_field,
    parse_configured_schema,
    reflected_schema,
    reflected_type,
    schema_report,
)
from tidemark.sources.tables import COLUMNS_COLUMNS

CONFIG = """{
  "fields": [
    {"name": "station", "datatype": "int64", "metadata": {"long_name": "Station"}},
    {"name": "month", "datatype": "UINT8", "metadata": {"minimum": 1, "maximum": 12}},
    {"name": "samples", "datatype": "uint16", "nullable": false},
    {"name": "first", "datatype": "datetime", "type_arguments": {"unit": "s"}},
    {"name": "last", "datatype": "datetime"},
    {"name": "mean", "datatype": "float32", "metadata": {"cell_methods": "time: mean", "unit": "m3 s-1"}}
  ],
  "metadata": {"title": "Statistics", "Conventions": "CF-1.8"}
}"""


def test_all_configured_names_are_known():
    assert len(CONFIGURED_TYPES) == 37
    for name in CONFIGURED_TYPES:
        arguments = {"precision": 9, "scale": 2} if name.startswith("decimal") else {}
        field = configured_field({"name": "x", "datatype": name.upper(), "type_arguments": arguments})
        assert isinstance(field.data_type, T.DataType)


def test_configured_schema():
    schema = parse_configured_schema(CONFIG)
    types = {f.name: f.dataType for f in schema.struct.fields}
    assert types["station"] == T.LongType() and types["month"] == T.ShortType()
    assert types["first"] == types["last"] == T.TimestampNTZType()
    assert schema.struct["month"].metadata == {"minimum": 1, "maximum": 12}
    assert not schema.struct["samples"].nullable
    assert schema.metadata["Conventions"] == "CF-1.8"


def test_type_arguments():
    zoned = configured_field({"name": "t", "datatype": "timestamp", "type_arguments": {"unit": "us", "tz": "UTC"}})
    assert zoned.data_type == T.TimestampType()
    with pytest.raises(KeyError):
        configured_field({"name": "x", "datatype": "complex64"})
    with pytest.raises(UnsupportedTypeError):
        configured_field({"name": "x", "datatype": "decimal256", "type_arguments": {"precision": 50, "scale": 2}})


@pytest.mark.parametrize(
    ("name", "extra", "expected"),
    [
        ("BIGINT", {}, T.LongType()),
        ("smallint", {}, T.ShortType()),
        ("real", {}, T.FloatType()),
        ("double precision", {}, T.DoubleType()),
        ("bit", {"length": 1}, T.BooleanType()),
        ("timestamp with time zone", {}, T.TimestampNTZType()),
        ("time without time zone", {}, T.TimestampNTZType()),
        ("numeric", {"precision": 12, "scale": 3}, T.DecimalType(12, 3)),
        ("uuid", {}, T.StringType()),
        ("jsonb", {}, T.StringType()),
        ("text", {}, T.StringType()),
        ("bytea", {}, T.BinaryType()),
        ("ARRAY", {"element_name": "_int4"}, T.ArrayType(T.IntegerType())),
    ],
)
def test_reflected_types(name, extra, expected):
    assert reflected_type("c", name, **extra) == expected


@pytest.mark.parametrize(
    ("name", "extra"),
    [("interval", {}), ("bit", {"length": 8}), ("numeric", {}), ("numeric", {"precision": 50}), ("ARRAY", {})],
)
def test_unsupported_types_name_the_column(name, extra):
    with pytest.raises(UnsupportedTypeError, match="'c'"):
        reflected_type("c", name, **extra)


def test_reflected_schema_is_in_catalog_order(spark):
    catalog = spark.createDataFrame(
        [
            ("s", "t", "b", 2, "character varying", "varchar", 20, None, None, "YES"),
            ("s", "t", "a", 1, "numeric", "numeric", None, 10, 2, "NO"),
        ],
        COLUMNS_COLUMNS,
    )
    assert [(f.name, f.data_type.simpleString()) for f in reflected_schema(catalog).fields] == [
        ("a", "decimal(10,2)"),
        ("b", "string"),
    ]


def test_schema_report(spark):
    report = schema_report(spark, parse_configured_schema(CONFIG)).orderBy("ordinal").collect()
    assert report[1].asDict() == {
        "ordinal": 2,
        "name": "month",
        "type": "smallint",
        "nullable": True,
        "metadata": '{"maximum": 12, "minimum": 1}',
    }
    assert report[2]["nullable"] is False and len(report) == 6


def test_apply_schema_casts_and_attaches_metadata(spark):
    df = spark.createDataFrame(
        [(7, 12, 3, "2020-01-02 03:04:05", None, 1.5)],
        "station int, month int, samples bigint, first string, last timestamp_ntz, mean double",
    )
    typed = apply_schema(df, parse_configured_schema(CONFIG))
    assert [f.dataType for f in typed.schema.fields] == [
        f.data_type for f in parse_configured_schema(CONFIG).fields
    ]
    assert typed.schema["mean"].metadata["unit"] == "m3 s-1"
    assert typed.first()["first"] == datetime.datetime(2020, 1, 2, 3, 4, 5)


def test_apply_schema_column_rules(spark):
    schema = TableSchema((TypedField("a", T.LongType()), TypedField("b", T.StringType())))
    df = spark.createDataFrame([(1, 2)], "a int, c int")
    with pytest.raises(ValueError, match="lacks: .*'b'"):
        apply_schema(df, schema, extra="drop")
    with pytest.raises(ValueError, match="'c'"):
        apply_schema(df, schema, missing="null")
    assert rows(apply_schema(df, schema, missing="null", extra="drop")) == [(1, None)]
    with pytest.raises(ValueError, match="not nullable"):
        apply_schema(df, TableSchema((TypedField("b", T.StringType(), nullable=False),)), "null", "drop")


FAILS = [
    ("bigint", 2**31, "int"),
    ("bigint", 2**53 + 1, "double"),
    ("int", 2**24 + 1, "float"),
    ("double", 1.5, "int"),
    ("double", float("nan"), "int"),
    ("double", 1e30, "bigint"),
    ("double", 2.0**63, "bigint"),
    ("string", "x1", "int"),
    ("string", "", "int"),
    ("string", "1.2.3", "double"),
    ("string", "abc", "double"),
    ("string", "2020-13-01", "date"),
    ("decimal(10,3)", Decimal("1.234"), "decimal(10,2)"),
    ("decimal(10,3)", Decimal("1.5"), "int"),
]
FITS = [
    ("bigint", 2**31 - 1, "int", 2**31 - 1),
    ("bigint", -(2**31), "int", -(2**31)),
    ("double", -2.0, "int", -2),
    ("double", -(2.0**63), "bigint", -(2**63)),
    ("double", 0.1, "float", pytest.approx(0.1)),
    ("string", " 12 ", "int", 12),
    ("string", "-1.5e3", "double", -1500.0),
    ("string", "inf", "double", float("inf")),
    ("string", "-Infinity", "double", float("-inf")),
    ("string", ".5", "decimal(5,2)", Decimal("0.50")),
    ("decimal(10,3)", Decimal("1.230"), "decimal(10,2)", Decimal("1.23")),
    ("int", 5, "string", "5"),
    ("string", "2020-02-03", "date", datetime.date(2020, 2, 3)),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_casts(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for source, value, target in FAILS:
            df = spark.createDataFrame([(value,), (None,)], f"c {source}")
            wanted = T.DataType.fromDDL(target)
            flags = df.select(failed_cast(F.col("c"), df.schema["c"].dataType, wanted)).collect()
            assert [r[0] for r in flags] == [True, False], (source, value, target)
            with pytest.raises(Exception) as caught:
                df.select(strict_cast("c", df.schema["c"].dataType, wanted)).collect()
            assert "column 'c'" in error_text(caught)
        for source, value, target, expected in FITS:
            df = spark.createDataFrame([(value,)], f"c {source}")
            wanted = T.DataType.fromDDL(target)
            row = df.select(
                strict_cast("c", df.schema["c"].dataType, wanted),
                failed_cast(F.col("c"), df.schema["c"].dataType, wanted),
            ).first()
            assert row[0] == expected and row[1] is False, (source, value, target)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize(
    ("name", "good", "bad"),
    [("uint8", 200, 256), ("uint16", 65535, 65536), ("uint32", 2**32 - 1, -1), ("uint64", 2**64 - 1, 2**64)],
)
def test_unsigned_ranges(spark, name, good, bad):
    schema = TableSchema((configured_field({"name": "c", "datatype": name}),))
    df = spark.createDataFrame([(Decimal(good),)], "c decimal(38,0)")
    assert int(apply_schema(df, schema).first()[0]) == good
    with pytest.raises(Exception) as caught:
        apply_schema(spark.createDataFrame([(Decimal(bad),)], "c decimal(38,0)"), schema).collect()
    assert name in error_text(caught)


def test_null_in_a_column_declared_not_nullable(spark):
    schema = TableSchema((TypedField("c", T.IntegerType(), nullable=False),))
    with pytest.raises(Exception) as caught:
        apply_schema(spark.createDataFrame([(None,)], "c int"), schema).collect()
    assert "not nullable" in error_text(caught)


def test_duration_and_time_of_day(spark):
    schema = TableSchema(
        (
            configured_field({"name": "d", "datatype": "duration", "type_arguments": {"unit": "ms"}}),
            configured_field({"name": "n", "datatype": "duration", "type_arguments": {"unit": "ns"}}),
            configured_field({"name": "t", "datatype": "time64", "type_arguments": {"unit": "us"}}),
        )
    )
    df = spark.sql("SELECT 1500L AS d, 2000000L AS n, TIMESTAMP_NTZ'1970-01-01 01:00:00.25' AS t")
    row = apply_schema(df, schema).first()
    assert row["d"] == datetime.timedelta(milliseconds=1500)
    assert row["n"] == datetime.timedelta(milliseconds=2)
    assert row["t"] == 3_600_250_000


def test_metadata_survives_parquet(spark, tmp_path):
    df = attach_field_metadata(spark.range(3).toDF("a"), {"a": {"units": "m", "minimum": 1}})
    df.write.parquet(str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).schema["a"].metadata == {"units": "m", "minimum": 1}


def test_columns_except(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns_except(df, ["b", "nothing"]).columns == ["a", "c"]
    plan = columns_except(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"), ["c_name"])
    assert "c_name" not in plan._jdf.queryExecution().executedPlan().toString()

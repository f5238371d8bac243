import datetime

import pytest

from helpers import rows
from tidemark.operators.retype import retype_columns, retype_report
from tidemark.plans.retype import all_succeeded, retype_dataset

DDL = "a bigint, b string, c string"
VALUES = [(1, "1", "x"), (2, None, "2"), (3, " 3", None)]


def test_report(spark):
    report = {
        r["column_name"]: (r["new_type"], r["value_count"], r["failure_count"], r["succeeded"])
        for r in retype_report(
            spark.createDataFrame(VALUES, DDL), {"a": "int", "b": "int", "c": "double"}
        ).collect()
    }
    assert report == {"a": ("int", 3, 0, True), "b": ("int", 2, 0, True), "c": ("double", 2, 1, False)}


def test_retype(spark):
    df = retype_columns(spark.createDataFrame(VALUES, DDL), {"a": "smallint", "b": "int"})
    assert df.dtypes == [("a", "smallint"), ("b", "int"), ("c", "string")]
    assert rows(df)[2] == (3, 3, None)
    with pytest.raises(KeyError):
        retype_columns(df, {"nope": "int"})


def test_dataset_job(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame(VALUES, DDL).write.parquet(path)
    results = retype_dataset(spark, path, "int", ["a", "b", "c", "nope"])
    assert [(r.column, r.succeeded, r.attempts) for r in results] == [
        ("a", True, 1),
        ("b", True, 1),
        ("c", False, 1),
        ("nope", False, 0),
    ]
    assert "1 values" in results[2].message and not all_succeeded(results)
    assert spark.read.parquet(path).dtypes == [("a", "int"), ("b", "int"), ("c", "string")]
    assert all_succeeded(retype_dataset(spark, path, "bigint", ["a"])) and not all_succeeded([])


LOSSY = [
    ("double", 1.239, "decimal(10,2)"),
    ("int", 5, "boolean"),
    ("timestamp", datetime.datetime(2024, 1, 1, 10, 30), "date"),
    ("string", "1e400", "double"),
    ("double", 1e300, "float"),
    ("binary", b"\xff", "string"),
    ("long", 2**53 + 1, "double"),
]
EXACT = [
    ("double", 1.25, "decimal(10,2)"),
    ("int", 1, "boolean"),
    ("timestamp", datetime.datetime(2024, 1, 1), "date"),
    ("string", "inf", "double"),
    ("double", float("nan"), "float"),
    ("double", float("inf"), "float"),
    ("double", 0.1, "float"),
    ("binary", "é".encode(), "string"),
    ("date", datetime.date(2024, 1, 1), "timestamp"),
]


@pytest.mark.parametrize("fails,case", [(True, c) for c in LOSSY] + [(False, c) for c in EXACT])
def test_casts_that_change_a_value_fail(spark, fails, case):
    source, value, target = case
    df = spark.createDataFrame([(value,), (None,)], f"v {source}")
    report = retype_report(df, {"v": target}).first()
    assert (report["failure_count"], report["succeeded"]) == (int(fails), not fails)
    if fails:
        with pytest.raises(Exception, match="column 'v'"):
            retype_columns(df, {"v": target}).collect()
    else:
        assert retype_columns(df, {"v": target}).filter("v is null").count() == 1

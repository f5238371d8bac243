"""Every registered query against its SQL, run by DuckDB on the same files."""

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(registry.core_oracle_sql()) == set(registry.core_queries())


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.core_queries()))
def test_query_agrees_with_sql(spark, database, name):
    frame = registry.core_queries()[name](spark, SF_DIR)
    found = rows_of(frame.columns, frame.collect())
    cursor = database.execute(registry.core_oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    assert sorted(frame.columns) == sorted(names)
    assert sum(found.values()) == sum(expected.values())
    assert found - expected == expected - found == Counter()

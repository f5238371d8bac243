"""Tables to extract from: a database over JDBC, or Spark DataFrames with declared keys."""

from __future__ import annotations

import decimal
import math
from collections.abc import Mapping, Sequence
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.errors import MissingTableError
from tidemark.functions.hosts import url_host
from tidemark.functions.keyset import typed_literal
from tidemark.operators.marks import equal_depth_cuts

DEFAULT_FETCH_ROWS = 50_000

TABLES_COLUMNS = "table_schema string, table_name string"
COLUMNS_COLUMNS = (
    "table_schema string, table_name string, column_name string, ordinal_position int, data_type string,"
    " udt_name string, character_maximum_length int, numeric_precision int, numeric_scale int,"
    " is_nullable string"
)
CONSTRAINTS_COLUMNS = (
    "constraint_schema string, constraint_name string, table_schema string, table_name string,"
    " constraint_type string"
)
KEY_COLUMNS_COLUMNS = (
    "constraint_schema string, constraint_name string, table_schema string, table_name string,"
    " column_name string, ordinal_position int"
)


def column_names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


class TableSource(Protocol):
    """What an extraction needs to know about its source."""

    spark: SparkSession
    host: str
    reflects_types: bool
    splits_reads: bool

    def tables(self) -> DataFrame: ...

    def columns(self) -> DataFrame: ...

    def constraints(self) -> DataFrame: ...

    def key_columns(self) -> DataFrame: ...

    def scan(
        self,
        schema_name: str,
        table_name: str,
        fetch_rows: int,
        split_on: str | None,
        split_range: tuple[Any, Any],
    ) -> DataFrame: ...

    def bounds(self, schema_name: str, table_name: str, column: str) -> tuple[Any, Any]: ...

    def cuts(
        self, schema_name: str, table_name: str, columns: Sequence[str], parts: int
    ) -> list[dict[str, Any]]: ...


def quote_identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def qualified_name(schema_name: str, table_name: str) -> str:
    return f"{quote_identifier(schema_name)}.{quote_identifier(table_name)}"


class JdbcSource:
    """A database reached over JDBC.

    The read is split into parallel range queries over one key column; every further predicate and
    the column selection reach the database through Spark's own push-down.
    """

    reflects_types = True
    splits_reads = True

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str] | None = None,
        partitions: int = 16,
        catalog_schema: str = "information_schema",
    ):
        self.spark = spark
        self.url = url
        self.partitions = partitions
        self._properties = dict(properties or {})
        self._catalog = catalog_schema

    @property
    def host(self) -> str:
        """Host part of the URL without ``jdbc:``, for naming the working directory."""
        row = (
            self.spark.createDataFrame([(self.url.removeprefix("jdbc:"),)], "url string")
            .select(url_host("url").alias("host"))
            .first()
        )
        if row["host"] is None:
            raise ValueError("No host name was found in the connection URL")
        return row["host"]

    def options(self, relation: str, fetch_rows: int = DEFAULT_FETCH_ROWS) -> dict[str, str]:
        """Reader options for a table name or a parenthesised query with an alias."""
        return {
            **self._properties,
            "url": self.url,
            "dbtable": relation,
            "fetchsize": str(fetch_rows),
            "pushDownPredicate": "true",
            "preferTimestampNTZ": "true",
        }

    def split_options(self, column: str, low: Any, high: Any) -> dict[str, str]:
        """Range split of the read; rows with a NULL in ``column`` come with the first range."""
        return {
            "partitionColumn": quote_identifier(column),
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(self.partitions),
        }

    def _read(self, options: Mapping[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()

    def _catalog_view(self, view: str, ddl: str) -> DataFrame:
        frame = self._read(self.options(f"{self._catalog}.{view}"))
        names = {name.lower(): name for name in frame.columns}
        return frame.select(*[F.col(f"`{names[name]}`").alias(name) for name in column_names(ddl)])

    def tables(self) -> DataFrame:
        return self._catalog_view("tables", TABLES_COLUMNS)

    def columns(self) -> DataFrame:
        return self._catalog_view("columns", COLUMNS_COLUMNS)

    def constraints(self) -> DataFrame:
        return self._catalog_view("table_constraints", CONSTRAINTS_COLUMNS)

    def key_columns(self) -> DataFrame:
        return self._catalog_view("key_column_usage", KEY_COLUMNS_COLUMNS)

    def bounds_query(self, schema_name: str, table_name: str, column: str) -> str:
        """Computed by the database: Spark would fetch the whole column for a minimum."""
        quoted = quote_identifier(column)
        return (
            f"(SELECT MIN({quoted}) AS low, MAX({quoted}) AS high"
            f" FROM {qualified_name(schema_name, table_name)}) bounds"
        )

    def bounds(self, schema_name: str, table_name: str, column: str) -> tuple[Any, Any]:
        row = self._read(self.options(self.bounds_query(schema_name, table_name, column))).first()
        return row[0], row[1]

    def scan_options(
        self,
        schema_name: str,
        table_name: str,
        fetch_rows: int = DEFAULT_FETCH_ROWS,
        split_on: str | None = None,
        split_range: tuple[Any, Any] = (None, None),
    ) -> dict[str, str]:
        options = self.options(qualified_name(schema_name, table_name), fetch_rows)
        low, high = split_range
        if split_on and low is not None and high is not None and low <= high:
            options |= self.split_options(split_on, low, high)
        return options

    def scan(
        self,
        schema_name: str,
        table_name: str,
        fetch_rows: int = DEFAULT_FETCH_ROWS,
        split_on: str | None = None,
        split_range: tuple[Any, Any] = (None, None),
    ) -> DataFrame:
        """The table, read by ``partitions`` range queries over ``split_range`` of ``split_on``."""
        return self._read(self.scan_options(schema_name, table_name, fetch_rows, split_on, split_range))

    def cuts_query(self, schema_name: str, table_name: str, columns: Sequence[str], parts: int) -> str:
        """Key tuples that cut the table into ``parts`` ranges of equal size, found by the database from its key index."""
        quoted = ", ".join(quote_identifier(column) for column in columns)
        present = " AND ".join(f"{quote_identifier(column)} IS NOT NULL" for column in columns)
        tile = f"FLOOR({{place}} * {parts}.0 / total)"
        return (
            f"(SELECT {quoted} FROM (SELECT {quoted}, ROW_NUMBER() OVER (ORDER BY {quoted}) AS place, COUNT(*) OVER () AS total"
            f" FROM {qualified_name(schema_name, table_name)} WHERE {present}) numbered"
            f" WHERE place > 1 AND {tile.format(place='(place - 1)')} > {tile.format(place='(place - 2)')}) cuts"
        )

    def cuts(self, schema_name: str, table_name: str, columns: Sequence[str], parts: int) -> list[dict[str, Any]]:
        """The cuts, in the database's own order, which is also the one that compares keys with them."""
        found = self._read(self.options(self.cuts_query(schema_name, table_name, columns, parts)))
        return [row.asDict() for row in found.collect()] if parts > 1 else []

    def scan_ranges(
        self,
        schema_name: str,
        table_name: str,
        cuts: Sequence[Mapping[str, Any]],
        fetch_rows: int = DEFAULT_FETCH_ROWS,
    ) -> DataFrame:
        """One task per range between the ascending ``cuts``, for keys of any type; the database compares."""
        return self.scan_by_predicates(schema_name, table_name, range_predicates(cuts), fetch_rows)

    def scan_by_predicates(
        self,
        schema_name: str,
        table_name: str,
        predicates: Sequence[str],
        fetch_rows: int = DEFAULT_FETCH_ROWS,
    ) -> DataFrame:
        """One task per predicate, for keys that are neither numbers nor times.

        The predicates are the caller's: they must not overlap and must cover every row.
        """
        options = self.options(qualified_name(schema_name, table_name), fetch_rows)
        url, relation = options.pop("url"), options.pop("dbtable")
        return self.spark.read.jdbc(url, relation, predicates=list(predicates), properties=options)


class FrameSource:
    """DataFrames as tables, e.g. Parquet datasets or catalog tables that Spark can already read."""

    reflects_types = False
    splits_reads = False

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[tuple[str, str], DataFrame],
        keys: Mapping[tuple[str, str], Sequence[tuple[str, Sequence[str]]]] | None = None,
        host: str = "local",
    ):
        """``keys``: per table a list of (constraint type, columns)."""
        self.spark = spark
        self.host = host
        self._tables = dict(tables)
        self._keys = dict(keys or {})

    def tables(self) -> DataFrame:
        return self.spark.createDataFrame(sorted(self._tables), TABLES_COLUMNS)

    def columns(self) -> DataFrame:
        rows = [
            (schema, table, f.name, position, f.dataType.simpleString(), None, None, None, None,
             "YES" if f.nullable else "NO")
            for (schema, table), frame in self._tables.items()
            for position, f in enumerate(frame.schema.fields, start=1)
        ]
        return self.spark.createDataFrame(rows, COLUMNS_COLUMNS)

    def _named_keys(self) -> list[tuple[str, str, str, str, Sequence[str]]]:
        return [
            (schema, table, f"{table}_{position:03}", kind, columns)
            for (schema, table), keys in self._keys.items()
            for position, (kind, columns) in enumerate(keys)
        ]

    def constraints(self) -> DataFrame:
        rows = [(schema, name, schema, table, kind) for schema, table, name, kind, _ in self._named_keys()]
        return self.spark.createDataFrame(rows, CONSTRAINTS_COLUMNS)

    def key_columns(self) -> DataFrame:
        rows = [
            (schema, name, schema, table, column, position)
            for schema, table, name, _, columns in self._named_keys()
            for position, column in enumerate(columns, start=1)
        ]
        return self.spark.createDataFrame(rows, KEY_COLUMNS_COLUMNS)

    def _frame(self, schema_name: str, table_name: str) -> DataFrame:
        if (schema_name, table_name) not in self._tables:
            raise MissingTableError(f"No table '{schema_name}.{table_name}' was given")
        return self._tables[schema_name, table_name]

    def bounds(self, schema_name: str, table_name: str, column: str) -> tuple[Any, Any]:
        row = self._frame(schema_name, table_name).agg(F.min(column), F.max(column)).first()
        return row[0], row[1]

    def cuts(self, schema_name: str, table_name: str, columns: Sequence[str], parts: int) -> list[dict[str, Any]]:
        return equal_depth_cuts(self._frame(schema_name, table_name), columns, parts)

    def scan(
        self,
        schema_name: str,
        table_name: str,
        fetch_rows: int = DEFAULT_FETCH_ROWS,
        split_on: str | None = None,
        split_range: tuple[Any, Any] = (None, None),
    ) -> DataFrame:
        """The frame as it is: Spark splits its files."""
        return self._frame(schema_name, table_name)


def sql_literal(value: Any) -> str:
    """A value as SQL text; a database gives untyped text the type of the column it is compared with."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(cuts: Sequence[Mapping[str, Any]]) -> list[str]:
    """Disjoint and complete conditions, in SQL: before the first cut, from each cut to the next, and from the last on.

    The cuts ascend in the database's order.  Rows with a NULL in a key part that decides are in the first range of those they
    could be in.
    """
    if not cuts:
        return ["1 = 1"]

    def from_cut(cut: Mapping[str, Any]) -> str:
        names = list(cut)
        text = f"{quote_identifier(names[-1])} >= {sql_literal(cut[names[-1]])}"
        for name in reversed(names[:-1]):
            quoted, value = quote_identifier(name), sql_literal(cut[name])
            text = f"{quoted} > {value} OR ({quoted} = {value} AND ({text}))"
        return f"({text})"

    # A comparison that is unknown counts as before the cut.
    after = [from_cut(cut) for cut in cuts]
    before = [f"({text} IS NOT TRUE)" for text in after]
    return [before[0], *(f"({low} AND {high})" for low, high in zip(after, before[1:])), after[-1]]


def range_slices(column: str, boundaries: Sequence[Any], data_type: T.DataType) -> list[Column | None]:
    """Consecutive, disjoint and complete ranges of ``column`` cut at the ascending boundaries.

    NULLs belong to the first range.
    """
    if not boundaries:
        return [None]
    key = F.col(f"`{column}`")
    cuts = [typed_literal(boundary, data_type) for boundary in boundaries]
    slices: list[Column | None] = [(key < cuts[0]) | key.isNull()]
    for low, high in zip(cuts, cuts[1:]):
        slices.append((key >= low) & (key < high))
    slices.append(key >= cuts[-1])
    return slices


def even_boundaries(low: Any, high: Any, slices: int) -> list[Any]:
    """Cuts that divide a numeric, date or time range into equal parts."""
    if low is None or slices < 2 or low == high:
        return []
    cuts = [low + (high - low) * part / slices for part in range(1, slices)]
    if isinstance(low, int):
        cuts = [math.ceil(low + (high - low) * part / slices) for part in range(1, slices)]
    return sorted(set(cuts))

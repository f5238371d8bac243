"""Table lookup and key discovery over database catalog frames.

The frames have the columns of the SQL standard's ``information_schema`` views, whatever the
source they were read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.errors import MissingTableError

# The constraint types that promise uniqueness.
UNIQUE_CONSTRAINTS = ("PRIMARY KEY", "UNIQUE")


def _of_table(table_name: str, schema_name: str | None) -> Column:
    condition = F.col("table_name") == table_name
    return condition if schema_name is None else condition & (F.col("table_schema") == schema_name)


def find_table(tables: DataFrame, table_name: str, schema_name: str | None = None) -> tuple[str, str]:
    """``(schema, table)`` of the first match in schema order."""
    row = tables.filter(_of_table(table_name, schema_name)).orderBy("table_schema").first()
    if row is None:
        qualified = table_name if schema_name is None else f"{schema_name}.{table_name}"
        raise MissingTableError(f"No table '{qualified}' was found in the source")
    return row["table_schema"], row["table_name"]


def table_columns(columns: DataFrame, table_name: str, schema_name: str | None = None) -> DataFrame:
    return columns.filter(_of_table(table_name, schema_name)).orderBy("ordinal_position")


def unique_keys(
    constraints: DataFrame, key_columns: DataFrame, table_name: str, schema_name: str | None = None
) -> DataFrame:
    """One row per PRIMARY KEY or UNIQUE constraint: position, name, type and ordered columns.

    Foreign keys and checks also name columns but say nothing about uniqueness.  The primary key
    comes first, then the others by name.
    """
    wanted = constraints.filter(
        _of_table(table_name, schema_name) & F.col("constraint_type").isin(*UNIQUE_CONSTRAINTS)
    ).select("constraint_schema", "constraint_name", "constraint_type", "table_schema", "table_name")
    ordered = (
        wanted.join(
            key_columns.select(
                "constraint_schema",
                "constraint_name",
                "table_schema",
                "table_name",
                "column_name",
                "ordinal_position",
            ),
            ["constraint_schema", "constraint_name", "table_schema", "table_name"],
        )
        .groupBy("constraint_schema", "constraint_name", "constraint_type")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal_position", "column_name"))).alias("parts"))
    )
    return ordered.select(
        (F.col("constraint_type") != "PRIMARY KEY").cast("int").alias("position"),
        "constraint_name",
        "constraint_type",
        F.col("parts.column_name").alias("columns"),
    )


def collect_keys(keys: DataFrame) -> list[tuple[str, tuple[str, ...]]]:
    """(constraint type, columns) of one table's keys on the driver: one row per constraint."""
    rows = keys.collect()
    rows.sort(key=lambda row: (row["position"], row["constraint_name"]))
    return [(row["constraint_type"], tuple(row["columns"])) for row in rows]


def pick_longest(keys: Sequence[tuple[str, ...]]) -> tuple[str, ...] | None:
    return max(keys, key=len) if keys else None

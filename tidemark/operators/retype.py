"""Change the type of columns, with a report per column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.casts import failed_cast, strict_cast


def _target_types(df: DataFrame, new_types: Mapping[str, str | T.DataType]) -> dict[str, T.DataType]:
    unknown = [name for name in new_types if name not in df.columns]
    if unknown:
        raise KeyError(f"The data has no columns {unknown}")
    return {
        name: T.DataType.fromDDL(target) if isinstance(target, str) else target for name, target in new_types.items()
    }


def retype_columns(df: DataFrame, new_types: Mapping[str, str | T.DataType]) -> DataFrame:
    """The same rows with the named columns in their new types; a value that does not fit raises."""
    targets = _target_types(df, new_types)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({name: strict_cast(name, types[name], target) for name, target in targets.items()})


def retype_report(df: DataFrame, new_types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Per column: target type, values, values that do not fit, and whether the change succeeds.

    One pass for all columns: one aggregate row of counters, unpivoted by ``stack``.
    """
    targets = _target_types(df, new_types)
    types = {f.name: f.dataType for f in df.schema.fields}
    counters = []
    for position, (name, target) in enumerate(targets.items()):
        counters.append(F.count(F.col(f"`{name}`")).alias(f"v{position}"))
        counters.append(F.count_if(failed_cast(F.col(f"`{name}`"), types[name], target)).alias(f"f{position}"))
    entries = []
    for position, (name, target) in enumerate(targets.items()):
        entries += [F.lit(name), F.lit(target.simpleString()), F.col(f"v{position}"), F.col(f"f{position}")]
    unpivoted = df.agg(*counters).select(
        F.stack(F.lit(len(targets)), *entries).alias("column_name", "new_type", "value_count", "failure_count")
    )
    return unpivoted.withColumn("succeeded", F.col("failure_count") == 0)

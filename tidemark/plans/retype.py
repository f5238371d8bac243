"""Retype columns of a Parquet dataset in place."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.operators.retype import retype_columns, retype_report
from tidemark.plans.attempts import QUERY_ATTEMPTS, attempt
from tidemark.sources.publish import DEFAULT_CODEC, DEFAULT_LEVEL, publish, read_metadata, recover
from tidemark.sources.storage import Storage


@dataclass(frozen=True)
class RetypeResult:
    name: str
    column: str
    succeeded: bool
    attempts: int
    message: str | None = None


def retype_dataset(
    spark: SparkSession,
    path: str,
    new_type: str,
    columns: Sequence[str],
    codec: str = DEFAULT_CODEC,
    level: int | None = DEFAULT_LEVEL,
    maximum_attempts: int = QUERY_ATTEMPTS,
) -> list[RetypeResult]:
    """Set the type of the columns whose values all fit, with one rewrite for all of them.

    A column with a value that does not fit, or that does not exist, keeps its type and is
    reported; the others are not held up by it.
    """
    recover(Storage(spark), path)
    data = spark.read.parquet(path)
    present = [name for name in columns if name in data.columns]
    report = {}
    if present:
        targets = {name: new_type for name in present}
        # One row per requested column.
        report = {row["column_name"]: row for row in retype_report(data, targets).collect()}
    fitting = [name for name in present if report[name]["succeeded"]]
    tries, failure = 0, None

    def rewrite() -> None:
        nonlocal tries
        tries += 1
        changed = retype_columns(data, {name: new_type for name in fitting})
        publish(changed, path, codec, level, read_metadata(spark, path))

    if fitting:
        try:
            attempt(rewrite, maximum_attempts)
        except Exception as error:
            failure = str(error)

    results = []
    for name in columns:
        if name not in present:
            results.append(RetypeResult(path, name, False, 0, "the column does not exist"))
        elif name not in fitting:
            count = report[name]["failure_count"]
            results.append(RetypeResult(path, name, False, 1, f"{count} values are not a valid {new_type}"))
        else:
            results.append(RetypeResult(path, name, failure is None, tries, failure))
    return results


def all_succeeded(results: Sequence[RetypeResult]) -> bool:
    """True if at least one column was changed and none failed."""
    return bool(results) and all(result.succeeded for result in results)

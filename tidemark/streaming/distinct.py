"""Stateful de-duplication of a stream, for outputs that can only be appended to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def first_per_key(
    stream: DataFrame, keys: Sequence[str], event_time: str | None = None, horizon: str | None = None
) -> DataFrame:
    """Pass on the first arriving row of each key, over all micro-batches.

    The state holds one entry per distinct key and is hash-partitioned by key, so a frequent key
    does not add state.  Which of several rows arrives first is up to the source.

    Without ``horizon`` every key is remembered for ever: exact, and the state only grows.  With it, a key is forgotten
    once the largest ``event_time`` seen is more than ``horizon`` after its row's, and rows that old which still arrive are
    dropped as late: copies that arrive within the horizon are found, and the state holds no more keys than that.
    """
    if horizon is None:
        return stream.dropDuplicates(list(keys))
    if event_time is None:
        raise ValueError("A horizon needs a column with the time of each row")
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


def append_distinct(
    spark: SparkSession,
    stream: DataFrame,
    keys: Sequence[str],
    output: str,
    progress: str,
    event_time: str | None = None,
    horizon: str | None = None,
) -> DataFrame:
    """Append the first row of each key to ``output`` until the available input is drained."""
    query = (
        first_per_key(stream, keys, event_time, horizon)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(output)

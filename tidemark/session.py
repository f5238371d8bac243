"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# A row written by an extraction is read back at least once (dedup, publish), so partitions are
# sized for a sort that stays in executor memory rather than for the smallest task count.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024

BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming dedup state grows with the number of distinct keys: keep it off the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle partitions so that one holds about ``SHUFFLE_PARTITION_BYTES`` of input.

    Used as the *initial* number: adaptive execution merges small partitions, it does not split
    large ones of an aggregation, so the start has to be high enough.
    """
    return max(cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in BASE_SETTINGS.items():
        builder = builder.config(name, value)
    if input_bytes is not None and cores is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes, cores))
        )
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster session without
    it is an error, because a machine-local folder would lose data with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"

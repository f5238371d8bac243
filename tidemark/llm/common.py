"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path
from tidemark.sources.storage import Storage

# The ASCII white space that separates words, and the ASCII capitals that are lowered.
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
ASCII_SPACE_CLASS = r"[\x20\x09-\x0D]"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_024
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that operators write in this scope are deleted at its end, whether it ends well or not.

    Results are read from such tables, so whatever is to stay has to be written, or counted, inside the scope.  Scopes
    nest; without one the tables stay in the shared folder.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        storage = Storage(spark)
        for path in paths:
            storage.delete(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, deleted with the scope."""
    path = scratch_path(spark, label)
    held = _SCOPE.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Batches of at most ``rows`` rows between Spark and Python for what runs in this scope; then as many as before.

    Each task holds a batch outside the heap, and its Python process holds it too: of whole texts Spark's 10,000 are much.
    """
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: lost executors cannot change it.

    With a ``path`` of the caller's the table is the caller's, and no scope deletes it.
    """
    spark = df.sparkSession
    path = path or scratch(spark, label)
    with short_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_REMEMBERED: dict[Hashable, Any] = {}


def remembered(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a process keeps between tasks under ``key``; made, and what it kept under other keys given up, if it has none.

    Processes are used again by the tasks of the next operator, which would else run beside the words of the one before.
    """
    if key not in _REMEMBERED:
        forget()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def forget() -> None:
    """Give up what the process keeps: for tasks that keep nothing themselves."""
    _REMEMBERED.clear()


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the decimal text of ``doc_id``, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def blobs(column: pa.Array) -> list[bytes | None]:
    """The values of a string or binary Arrow column as bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def small(batches: Iterator[pa.RecordBatch], rows: int = 256, most_bytes: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, so that what a task makes of a batch stays small beside it.

    With ``most_bytes`` slices are halved down to so many bytes, or one row.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            waiting = [batch.slice(at, rows)]
            while waiting:
                part = waiting.pop()
                if most_bytes is not None and part.num_rows > 1 and part.nbytes > most_bytes:
                    half = part.num_rows // 2
                    waiting += [part.slice(half), part.slice(0, half)]
                else:
                    yield part

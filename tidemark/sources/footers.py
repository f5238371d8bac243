"""Footers of many Parquet files, read by tasks: what schema each has, how many rows, and whether it can be read."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession, functions as F

FILES_PER_TASK = 256
_DRIVER_READERS = 16
_COLUMNS = "path string, columns string, rows long, error string, reached boolean"


def data_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """All data files under the paths; Spark lists them, in a job where there are many paths."""
    return [unquote(file) for file in spark.read.schema("any string").parquet(*paths).inputFiles()] if paths else []


def plain_path(path: str) -> str:
    """One spelling for a local path, with or without a scheme."""
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path.rstrip("/")


def root_of(file: str, roots: dict[str, int]) -> int:
    """The number of the path (as ``plain_path``) that a data file is, or lies under."""
    at = plain_path(file)
    while at not in roots and "/" in at.rstrip("/"):
        at = at.rpartition("/")[0]
    return roots.get(at, len(roots))


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    scheme, separator, rest = path.partition(":")
    if not separator or "/" in scheme:
        return pyarrow.fs.LocalFileSystem(), path
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            try:
                file_system, inner = _file_system(path)
                with file_system.open_input_file(inner) as file:
                    try:
                        metadata = pyarrow.parquet.read_metadata(file)
                        fields = metadata.schema.to_arrow_schema()
                        columns = json.dumps([[f.name, str(f.type)] for f in fields])
                        found.append((path, columns, metadata.num_rows, None, True))
                    except (pa.ArrowException, OSError) as damage:
                        found.append((path, None, None, str(damage), True))
            except (pa.ArrowException, OSError, ImportError) as closed:
                found.append((path, None, None, str(closed), False))
        names = ["path", "columns", "rows", "error", "reached"]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)


def _read_through_driver(spark: SparkSession, files: Sequence[str]) -> list[tuple]:
    """For file systems that only the JVM can open: a few footers at a time, without their row groups' columns."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def read(path: str) -> tuple:
        try:
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
            try:
                schema = reader.getFooter().getFileMetaData().getSchema()
                columns = [[f.getName(), f.toString()] for f in schema.getFields()]
                return path, json.dumps(columns), reader.getRecordCount(), None, True
            finally:
                reader.close()
        except Exception as damage:  # what a damaged footer raises depends on what stands in its place
            return path, None, None, str(damage).split("\n")[0], True

    with ThreadPoolExecutor(_DRIVER_READERS) as readers:
        return list(readers.map(read, files))


def read_footers(spark: SparkSession, files: Sequence[str], in_tasks: bool = True) -> DataFrame:
    """One row a file: ``path``, ``columns`` (JSON of names and types in order), ``rows``, and ``error`` instead where it is damaged.

    A job with ``FILES_PER_TASK`` files a task that reads nothing but footers.  ``reached`` is false for files that tasks
    cannot open, as in a store for which there is only a Java client; with ``in_tasks=False`` the driver's JVM
    reads all, a few at a time.
    """
    if not in_tasks:
        return spark.createDataFrame(_read_through_driver(spark, files), _COLUMNS)
    listed = spark.createDataFrame([(path,) for path in files], "path string")
    return listed.repartition(max(1, -(-len(files) // FILES_PER_TASK))).mapInArrow(_read, _COLUMNS)


@dataclass(frozen=True)
class FooterSummary:
    """Of all files: an example of each kind of ``columns``, the damaged ones, and where the rest was read."""

    examples: dict[str, str]
    broken: dict[str, str]
    in_tasks: bool


def summarise_footers(spark: SparkSession, files: Sequence[str], in_tasks: bool = True) -> FooterSummary:
    """One job over the footers; a second one, through the driver, only where tasks cannot open the files."""
    alone = F.when(F.col("columns").isNull(), F.col("path"))
    rows = (
        read_footers(spark, files, in_tasks)
        .groupBy("columns", alone.alias("alone"), "reached")
        .agg(F.min("path").alias("example"), F.min("error").alias("error"))
        .collect()
    )
    if in_tasks and any(not row["reached"] for row in rows):
        return summarise_footers(spark, files, in_tasks=False)
    return FooterSummary(
        {row["columns"]: row["example"] for row in rows if row["columns"] is not None},
        {row["example"]: row["error"] for row in rows if row["columns"] is None},
        in_tasks,
    )


def split_readable(spark: SparkSession, paths: Sequence[str], in_tasks: bool = True) -> tuple[list[str], dict[str, str]]:
    """The data files under ``paths`` that can be read, and those whose footer is damaged, with the reason."""
    files = data_files(spark, paths)
    broken = summarise_footers(spark, files, in_tasks).broken if files else {}
    return [path for path in files if path not in broken], broken

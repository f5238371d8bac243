"""Continuous compaction: arriving Parquet files are merged into one main dataset.

A micro-batch is written, already unique, as a *run* beside the main dataset.  Runs are merged into
main once they weigh ``rewrite_ratio`` times as much as main and at least ``rewrite_bytes``, and when
the stream is drained.  So a row is rewritten a logarithmic number of times instead of once per
arriving file.

With keys, main is a set of files of one key range each, and the cuts between the ranges lie beside them: a later merge
reads and rewrites only the ranges that a run has rows of.  Which files it adds and removes is written down first, so one
that was interrupted is completed by the next; until then a reader may see both states of a range, which the keys
tell apart.

``foreachBatch`` may repeat a batch.  That is harmless: a repeated batch overwrites its own run, and
merging the same rows twice gives the same result, both by key and by whole row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.dedup import sort_order
from tidemark.operators.marks import equal_depth_cuts
from tidemark.plans.merge import merge_frame
from tidemark.plans.ranges import RangedCheckpoint, is_ranged, part_number, read_ranged, start_ranged
from tidemark.schema import TableSchema
from tidemark.sources.parquet import scan_parquet
from tidemark.sources.publish import (
    DEFAULT_CODEC,
    DEFAULT_LEVEL,
    publish,
    recover,
    staging_path,
    swap_in,
    write_metadata,
    write_parquet,
)
from tidemark.sources.storage import Storage, name_of, parent_of

POLL_INTERVAL = "2 seconds"
# Ranges of main, at most; larger mains have several files a range.
MOST_RANGES = 256


@dataclass(frozen=True)
class Compaction:
    """Files arriving in ``incoming`` become part of ``main``; ``progress`` holds the stream's state."""

    spark: SparkSession
    incoming: str
    main: str
    progress: str
    arriving_schema: T.StructType
    keys: tuple[str, ...] = ()
    schema: TableSchema | T.StructType | None = None
    codec: str = DEFAULT_CODEC
    level: int | None = DEFAULT_LEVEL
    files_per_batch: int = 1000
    rewrite_ratio: float = 1.0
    rewrite_bytes: int = 1 << 30
    delete_merged: bool = False
    file_bytes: int = 256 << 20
    wide_rows: bool = False

    @property
    def runs(self) -> str:
        return f"{parent_of(self.main)}/_runs_{name_of(self.main)}"

    def arrivals(self) -> DataFrame:
        """The stream of rows in arriving files."""
        return (
            self.spark.readStream.schema(self.arriving_schema)
            .option("maxFilesPerTrigger", str(self.files_per_batch))
            .option("cleanSource", "delete" if self.delete_merged else "off")
            .parquet(self.incoming)
        )

    def _write_run(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        unique = merge_frame(batch, self.keys, enforce_unique=True, schema=self.schema, wide_rows=self.wide_rows)
        if self.keys:
            unique = unique.sortWithinPartitions(*sort_order(self.keys))
        write_parquet(unique, f"{self.runs}/run_{batch_id:09}", self.codec, self.level, mode="overwrite")
        storage = Storage(self.spark)
        main_bytes = storage.size(self.main) if storage.exists(self.main) else 0
        if storage.size(self.runs) >= max(self.rewrite_bytes, self.rewrite_ratio * main_bytes):
            self.fold()

    def pending(self) -> list[str]:
        """Complete runs that are not yet part of main."""
        storage = Storage(self.spark)
        return [run.path for run in storage.children(self.runs) if storage.exists(f"{run.path}/_SUCCESS")]

    def fold(self) -> None:
        """Merge all runs with main, which is always an input.

        Main is sorted inside each file, like every run, however many runs were folded.  A single run without a main
        is already unique and is moved into place.  Where main has key ranges that are not much larger than when they
        were cut, only those that runs have rows of are rewritten; else main is, by a staged swap.
        """
        storage = Storage(self.spark)
        recover(storage, self.main)
        self._complete_fold()
        runs = self.pending()
        if not runs:
            return
        metadata = self.schema.metadata if isinstance(self.schema, TableSchema) else None
        if len(runs) == 1 and not storage.exists(self.main):
            if metadata:
                write_metadata(self.spark, runs[0], metadata)
            swap_in(storage, runs[0], self.main)
            return
        paths = ([self.main] if storage.exists(self.main) else []) + runs
        if not self.keys:
            merged = merge_frame(scan_parquet(self.spark, paths), enforce_unique=True, wide_rows=self.wide_rows)
            publish(merged, self.main, self.codec, self.level, metadata)
        elif self._ranges_fit(storage, runs):
            self._fold_ranges(storage, runs)
        else:
            self._cut_anew(storage, paths, metadata)
        for run in runs:
            storage.delete(run)

    def _ranges_fit(self, storage: Storage, runs: Sequence[str]) -> bool:
        if not storage.exists(self.main) or not is_ranged(self.spark, self.main):
            return False
        held = storage.size(self.main) + sum(map(storage.size, runs))
        return held <= 2 * self.file_bytes * read_ranged(self.spark, self.main).units

    def _write_ranges(self, rows: DataFrame, ranged: RangedCheckpoint, path: str) -> None:
        """One row per key, those of each range, or part of one, in a file of their number, in order.

        A key's rows lie in one range, so the exchange that deals the rows to their files also brings equal keys together:
        rows travel once.  Runs and what was made of them are unique, so no key is frequent here.
        """
        dealt = rows.withColumn("__unit", ranged.unit(rows)).repartitionById(ranged.units, F.col("__unit"))
        merged = merge_frame(dealt, ["__unit", *self.keys]).drop("__unit")
        write_parquet(merged.sortWithinPartitions(*sort_order(self.keys)), path, self.codec, self.level, mode="append")

    def _cut_anew(self, storage: Storage, paths: Sequence[str], metadata: dict | None) -> None:
        """Rewrite all of main in ranges of equal depth."""
        rows = scan_parquet(self.spark, paths)
        files = max(1, -(-sum(map(storage.size, paths)) // self.file_bytes))
        cuts = equal_depth_cuts(rows, self.keys, min(files, MOST_RANGES))
        splits = -(-files // (len(cuts) + 1))
        staged = staging_path(self.main)
        try:
            ranged = start_ranged(self.spark, staged, rows, self.keys, cuts, None, 0, splits)
            self._write_ranges(rows, ranged, staged)
            if metadata:
                write_metadata(self.spark, staged, metadata)
            swap_in(storage, staged, self.main)
        finally:
            storage.delete(staged)

    def _fold_ranges(self, storage: Storage, runs: Sequence[str]) -> None:
        """Rewrite the ranges that the runs have rows of."""
        ranged = read_ranged(self.spark, self.main)
        arrived = scan_parquet(self.spark, runs)
        units = {row[0] for row in arrived.select(ranged.unit(arrived)).distinct().collect()}
        old = [file.path for file in storage.children(self.main) if part_number(file.path) in units]
        staged = staging_path(self.main)
        self._write_ranges(scan_parquet(self.spark, [*old, *runs]), ranged, staged)
        # The first task writes an empty file where it has no rows.
        new = [file.path for file in storage.children(staged) if part_number(file.path) in units]
        storage.write_bytes(f"{self._journal}.new", json.dumps({"staged": staged, "add": new, "remove": old}).encode())
        storage.rename(f"{self._journal}.new", self._journal)
        self._complete_fold()

    @property
    def _journal(self) -> str:
        return f"{parent_of(self.main)}/_fold_{name_of(self.main)}.json"

    def _complete_fold(self) -> None:
        """Do what is left of a fold that was written down; each step may have been done before."""
        storage = Storage(self.spark)
        if not storage.exists(self._journal):
            return
        steps = json.loads(storage.read_bytes(self._journal))
        for path in steps["add"]:
            if storage.exists(path):
                storage.rename(path, f"{self.main}/{name_of(path)}")
        for path in steps["remove"]:
            storage.delete(path)
        storage.delete(steps["staged"])
        storage.delete(self._journal)

    def current(self) -> DataFrame:
        """Everything compacted so far, including runs that are not yet part of main."""
        storage = Storage(self.spark)
        paths = ([self.main] if storage.exists(self.main) else []) + self.pending()
        return merge_frame(scan_parquet(self.spark, paths), self.keys, enforce_unique=True)

    def _start(self, **trigger) -> StreamingQuery:
        # Runs of an earlier query are merged first, so that batch numbers can start over.
        self.fold()
        return (
            self.arrivals()
            .writeStream.foreachBatch(self._write_run)
            .option("checkpointLocation", self.progress)
            .trigger(**trigger)
            .start()
        )

    def start(self, interval: str = POLL_INTERVAL) -> StreamingQuery:
        """Compact until the query is stopped; call ``finish`` with it to stop and drain."""
        return self._start(processingTime=interval)

    def finish(self, query: StreamingQuery) -> None:
        """Process what has arrived, stop the query and merge the remaining runs."""
        query.processAllAvailable()
        query.stop()
        self.fold()

    def drain(self) -> None:
        """Compact everything that has arrived so far and return."""
        self._start(availableNow=True).awaitTermination()
        self.fold()


def compact(
    spark: SparkSession,
    incoming: str,
    main: str,
    progress: str,
    arriving_schema: T.StructType,
    keys: Sequence[str] = (),
    **options,
) -> Compaction:
    """Drain all arrived files into main."""
    compaction = Compaction(spark, incoming, main, progress, arriving_schema, tuple(keys), **options)
    compaction.drain()
    return compaction

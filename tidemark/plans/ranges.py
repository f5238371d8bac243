"""A checkpoint written by one job whose tasks commit one range of the key each.

Rows go to the task of their range (and, for more tasks than ranges, of a hash within it), and each task writes one file
that is moved into the dataset as soon as it is complete.  The cuts are written first, so a later run knows which
ranges the files that are there hold, and reads only the others.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.marks import in_ranges, range_number
from tidemark.sources.publish import write_parquet
from tidemark.sources.storage import Storage, name_of

MANIFEST = "_ranges"
_PART = re.compile(r"part-([0-9]+)-")
_UNIT = "__unit"


@dataclass(frozen=True)
class RangedCheckpoint:
    """``cuts`` make ranges, each dealt to ``splits`` tasks; ``done`` are the tasks' numbers whose file is there."""

    spark: SparkSession
    path: str
    cuts: tuple[dict[str, Any], ...]
    after: dict[str, Any] | None
    splits: int
    key: tuple[str, ...]
    number: int
    done: frozenset[int]

    @property
    def units(self) -> int:
        return (len(self.cuts) + 1) * self.splits

    @property
    def missing(self) -> list[int]:
        return [unit for unit in range(self.units) if unit not in self.done]

    @property
    def missing_ranges(self) -> int:
        return len({unit // self.splits for unit in self.missing})

    @property
    def last_range_is_complete(self) -> bool:
        return all(unit in self.done for unit in range(self.units - self.splits, self.units))

    def unit(self, df: DataFrame) -> Column:
        """The number of the task that a row is dealt to."""
        within = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in self.key]), F.lit(self.splits)).cast("int")
        return range_number(self.cuts, df) * self.splits + within

    def fill(self, df: DataFrame, codec: str, level: int | None) -> int:
        """Read what is missing from ``df``, by one scan, and commit it range by range; the number of rows."""
        missing = self.missing
        part = in_ranges(df, self.cuts, [unit // self.splits for unit in missing]) if self.cuts else df
        dealt = part.withColumn(_UNIT, self.unit(df))
        if self.done:
            dealt = dealt.where(F.col(_UNIT).isin(missing))
        by_range = dealt.repartitionById(self.units, F.col(_UNIT)).drop(_UNIT)
        storage = Storage(self.spark)
        before = {file.path for file in storage.children(self.path)}
        write_parquet(by_range, self.path, codec, level, mode="append", commit_each_task=True)
        new = [file.path for file in storage.children(self.path) if file.path not in before]
        # Counted in the footers of what was written.
        return self.spark.read.schema(df.schema).parquet(*new).count() if new else 0


def write_cuts(
    df: DataFrame,
    path: str,
    key: Sequence[str],
    cuts: Sequence[Mapping[str, Any]],
    splits: int,
    after: Mapping[str, Any] | None = None,
) -> None:
    """Keep the cuts of a dataset inside it, hidden from readers of the data, with the types of ``df``."""
    fields = [T.StructField(name, df.schema[name].dataType) for name in dict.fromkeys([*key, *(after or {})])]
    schema = T.StructType([T.StructField("__place", T.IntegerType()), T.StructField("__splits", T.IntegerType()), *fields])
    # Place -1 is the dataset itself, -2 the mark it starts after.
    rows: list[tuple] = [(-1, splits, *[None] * len(fields))]
    if after:
        rows.append((-2, splits, *[after.get(field.name) for field in fields]))
    rows += [(place, splits, *[cut.get(field.name) for field in fields]) for place, cut in enumerate(cuts)]
    df.sparkSession.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def part_number(path: str) -> int | None:
    """The number of the task that wrote a file, from its name."""
    match = _PART.match(name_of(path))
    return int(match.group(1)) if match else None


def is_ranged(spark: SparkSession, path: str) -> bool:
    return Storage(spark).exists(f"{path}/{MANIFEST}/_SUCCESS")


def start_ranged(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    key: Sequence[str],
    cuts: Sequence[Mapping[str, Any]],
    after: Mapping[str, Any] | None,
    number: int,
    splits: int | None = None,
) -> RangedCheckpoint:
    """Write the cuts of a checkpoint that is about to be filled from ``df``; ranges are split up to the number of shuffle partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = splits or max(1, -(-partitions // (len(cuts) + 1)))
    write_cuts(df, path, key, cuts, splits, after)
    return RangedCheckpoint(
        spark, path, tuple(dict(cut) for cut in cuts), dict(after) if after else None, splits, tuple(key), number, frozenset()
    )


def read_ranged(spark: SparkSession, path: str) -> RangedCheckpoint:
    """A checkpoint that an interrupted run began; files that could not be read have to be gone."""
    rows = spark.read.parquet(f"{path}/{MANIFEST}").orderBy("__place").collect()
    names = [name for name in rows[0].asDict() if not name.startswith("__")]
    cuts = [{n: row[n] for n in names if row[n] is not None} for row in rows if row["__place"] >= 0]
    marks = [{n: row[n] for n in names} for row in rows if row["__place"] == -2]
    key = tuple(cuts[0]) if cuts else tuple(names)
    done = {part_number(file.path) for file in Storage(spark).children(path)} - {None}
    tail = path.rpartition("_")[2]
    number = int(tail) if tail.isdigit() else 0
    return RangedCheckpoint(spark, path, tuple(cuts), marks[0] if marks else None, rows[0]["__splits"], key, number, frozenset(done))

"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text gives a short vector of transformed statistics.  Each class is a Gaussian whose covariance is
shrunk towards the pooled one and its diagonal; the score is the logistic of the difference of the two
log densities, from Mahalanobis distances by Cholesky factors made once and sent with the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import blobs, forget, remainder, small, written

BROADCAST_LABELS = 1 << 20  # ids of 8 bytes

# Classes of bytes counted in a text.
SPACE, UPPER, LOWER, DIGIT, SYMBOL, OTHER = range(6)
_CLASS = np.full(256, OTHER, np.uint8)
for _low, _high, _kind in ((33, 126, SYMBOL), (65, 90, UPPER), (97, 122, LOWER), (48, 57, DIGIT), (9, 13, SPACE), (32, 32, SPACE)):
    _CLASS[_low : _high + 1] = _kind
_UPPER_BYTES = bytes(range(65, 91))
_SYMBOL_BYTES = bytes(b for b in range(33, 127) if _CLASS[b] == SYMBOL)
_SYMBOL_END = re.compile(rb"[!-/:-@\[-`{-~]{2,}(?![^\x20\x09-\x0D])")
_SYMBOL_WORD = re.compile(rb"(?<![^\x20\x09-\x0D])[!-/:-@\[-`{-~]+(?![^\x20\x09-\x0D])")

STATISTICS = (
    "log_bytes log_words word_length upper digit symbol other symbol_end symbol_word repeated distinct"
    " line_upper line_symbol line_repeated words_per_line sentence_length"
).split()


def statistics(text: bytes) -> list[float]:
    """The statistics of one whole text; shares go through a square root, sizes through a logarithm."""
    size = len(text)
    counts = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=6)
    letters = max(1, int(counts[UPPER] + counts[LOWER] + counts[OTHER]))
    seen = max(1, size - int(counts[SPACE]))
    words = text.split()
    n = max(1, len(words))
    lines = text.split(b"\n")
    line_upper = line_symbol = line_repeated = 0.0
    for line in lines:
        length = len(line)
        if length >= 40:  # shorter lines say little
            line_upper = max(line_upper, (length - len(line.translate(None, _UPPER_BYTES))) / length)
            line_symbol = max(line_symbol, (length - len(line.translate(None, _SYMBOL_BYTES))) / length)
            parts = line.split()
            line_repeated = max(line_repeated, sum(map(eq, parts, parts[1:])) / len(parts)) if parts else line_repeated
    return [
        np.log1p(size),
        np.log1p(len(words)),
        np.log1p(seen / n),
        *np.sqrt(
            [
                counts[UPPER] / letters,
                counts[DIGIT] / seen,
                counts[SYMBOL] / seen,
                counts[OTHER] / seen,
                len(_SYMBOL_END.findall(text)) / n,
                len(_SYMBOL_WORD.findall(text)) / n,
                sum(map(eq, words, words[1:])) / n,
            ]
        ),
        len(set(words)) ** 0.5 / n**0.5,
        *np.sqrt([line_upper, line_symbol, line_repeated]),
        np.log1p(n / len(lines)),
        np.log1p(n / (1 + text.count(b"."))),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``x``, the statistics of every whole text; a NULL text counts as empty."""
    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small(batches):
            values = np.array([statistics(text or b"") for text in blobs(batch.column(1))]).ravel()
            offsets = np.arange(batch.num_rows + 1) * len(STATISTICS)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "x"])

    return source.mapInArrow(measure, "id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Log prior ratio and, of each class, mean, inverse Cholesky factor and half log determinant."""

    log_ratio: float
    classes: tuple[tuple[np.ndarray, np.ndarray, float], ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1; with one class learned it is that class, with none 1/2."""
        if len(self.classes) < 2:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_ratio)))
        densities = [
            -0.5 * np.square((x - mean) @ inverse.T).sum(axis=1) - half_log for mean, inverse, half_log in self.classes
        ]
        return 1 / (1 + np.exp(-np.clip(densities[1] - densities[0] + self.log_ratio, -700, 700)))


def class_moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Of each class in ``label``: number of rows, sum of ``x``, sum of its outer products.

    Each task sends one row per class and moment, which Spark adds up; the driver gets
    2 * (1 + d + d * d) numbers however many rows there are.
    """
    size = len(STATISTICS)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            wide = np.hstack([np.ones((len(x), 1)), x])
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for label in np.unique(labels):
                of = wide[labels == label]
                sums[int(label)] = sums.get(int(label), 0) + of.T @ of
        for label, total in sums.items():
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(flat), label, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                ["label", "place", "value"],
            )

    parts = labelled.select(F.col("label").cast("int"), "x").mapInArrow(add_up, "label int, place int, value double")
    tables: dict[int, np.ndarray] = {}
    for row in parts.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        tables.setdefault(row["label"], np.zeros((size + 1) ** 2))[row["place"]] = row["value"]
    found = {}
    for label, flat in tables.items():
        table = flat.reshape(size + 1, size + 1)
        found[label] = (table[0, 0], table[0, 1:], table[1:, 1:])
    return found


def fit_discriminant(labelled: DataFrame, shrink_pooled: float = 0.2, shrink_diagonal: float = 0.1) -> Discriminant:
    """Learn from all rows of ``labelled`` (``label`` 0 or 1, ``x``).

    A class covariance moves by ``shrink_pooled`` towards the pooled one and then by
    ``shrink_diagonal`` towards the diagonal of that; a small ridge keeps constant statistics invertible.
    """
    moments = {label: m for label, m in class_moments(labelled).items() if label in (0, 1)}
    ratio = np.log((moments.get(1, (0,))[0] + 0.5) / (moments.get(0, (0,))[0] + 0.5))
    if len(moments) < 2:
        return Discriminant(float(ratio), ())
    scatter = {label: outer - np.outer(total, total) / n for label, (n, total, outer) in moments.items()}
    pooled = (scatter[0] + scatter[1]) / (moments[0][0] + moments[1][0])
    classes = []
    for label in (0, 1):
        n, total, _ = moments[label]
        mixed = (1 - shrink_pooled) * scatter[label] / n + shrink_pooled * pooled
        shrunk = (1 - shrink_diagonal) * mixed + shrink_diagonal * np.diag(np.diag(pooled)) + 1e-5 * np.eye(len(total))
        factor = np.linalg.cholesky(shrunk)
        classes.append((total / n, np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())))
    return Discriminant(float(ratio), tuple(classes))


def taught_discriminant(table: DataFrame, labels: DataFrame, folds: int, held_fold: int) -> Discriminant:
    """Learned from the rows of ``table`` (id, x) outside the held fold that ``labels`` (doc_id, quality) has."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    taught = table.where(remainder(F.col("id"), folds) != held_fold)
    return fit_discriminant(taught.join(marks, "id").select("label", "x"))


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_fold: int = 0, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, with all their columns.

    Statistics of all rows are computed once, to score them; before, those of labelled rows only.  No row is moved as
    long as the labels' ids can be broadcast (``BROADCAST_LABELS``).
    """
    named = labels.select(F.col("doc_id").cast("long").alias("label_id")).distinct()
    few = named.count() <= BROADCAST_LABELS
    labelled = docs.join(F.broadcast(named) if few else named, docs["doc_id"].cast("long") == F.col("label_id"), "left_semi")
    model = taught_discriminant(document_statistics(labelled, text_col=text_col), labels, folds, held_fold)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small(batches):
            x = np.array([statistics(text or b"") for text in blobs(batch.column(place))]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.scores(x) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_fold: int = 0
) -> DataFrame:
    """Every document's probability of good quality, learned from labelled ones outside the held fold.

    ``labels`` (doc_id, quality) teaches by rows whose crc32(doc_id) modulo ``folds`` is not
    ``held_fold``; a document labelled more than once takes its largest label, NULL labels and
    NULL ids teach nothing.  Returns doc_id, held_out (NULL for a NULL id), score, predicted for every row,
    repeated ones too.  A NULL text counts as empty and is scored.  Without labels of both classes the
    score is the share of label 1 (1/2 without any).  Other columns are not looked at.
    """
    table = written(document_statistics(docs), "statistics")
    held = remainder(F.col("id"), folds) == held_fold
    model = taught_discriminant(table, labels, folds, held_fold)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["id", "score"])

    return table.mapInArrow(score, "id long, score double").select(
        F.col("id").alias("doc_id"),
        held.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

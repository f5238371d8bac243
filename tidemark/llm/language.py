"""Language by error-correcting output codes.

Each language has a codeword; each bit is a binary classifier, a naive Bayes over hashed byte trigrams
that tells the languages whose bit is 1 from the others.  Decoding takes the codeword with the smallest
weighted logistic loss, a bit counting for a language as much as it has learned about it, and flags texts
whose two best codewords are close.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import blobs, remainder

FEATURE_BITS = 13
FEATURES = 1 << FEATURE_BITS
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
# ASCII letters are lowered and all other ASCII is a space: digits and signs say nothing of a language.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def trigram_counts(text: bytes) -> np.ndarray:
    """How often each hashed trigram occurs in the whole text, its borders counted as spaces."""
    folded = b" " + b" ".join(text.translate(_FOLD).split()) + b" "
    b = np.frombuffer(folded, np.uint8).astype(np.uint32)
    codes = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return np.bincount((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS), minlength=FEATURES)


def codewords(languages: int) -> np.ndarray:
    """Codewords of -1 and 1, a row a language: every split up to 7 languages, seeded random ones beyond."""
    if languages <= 7:
        splits = np.arange(1, 1 << max(0, languages - 1))
        bits = (splits[None, :] >> np.arange(languages)[:, None]) & 1
        return np.where(bits == 1, 1, -1)
    length = int(16 * np.ceil(np.log2(languages)))
    draws = np.random.default_rng(languages)
    best, distance = None, -1
    for _ in range(50):  # of some drawn codes the one whose nearest words are farthest apart
        words = draws.choice([-1, 1], size=(languages, length))
        nearest = ((length - words @ words.T) // 2 + length * np.eye(languages, dtype=int)).min()
        if nearest > distance:
            best, distance = words, nearest
    return best


@dataclass(frozen=True)
class LanguageCode:
    languages: tuple[str, ...]
    words: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Weighted loss of each language's codeword for one text."""
        margins = np.clip(counts @ self.weights / 2, -60, 60)
        return (self.bit_weights * np.logaddexp(0, -self.words * margins)).sum(axis=1)


def fit_language_code(counts: dict[str, np.ndarray], smoothing: float = 0.5) -> LanguageCode:
    """Learn all bits from the trigram counts of each language."""
    languages = tuple(sorted(lang for lang, c in counts.items() if c.sum()))
    if not languages:
        return LanguageCode((), np.zeros((0, 0)), np.zeros((FEATURES, 0)), np.zeros((0, 0)))
    table = np.array([counts[lang] for lang in languages], dtype=float)
    shares = (table + smoothing) / (table.sum(axis=1, keepdims=True) + smoothing * FEATURES)
    words = codewords(len(languages))
    weights = np.empty((FEATURES, words.shape[1]))
    for bit in range(words.shape[1]):
        # Languages count alike, however many documents each has.
        weights[:, bit] = np.log(shares[words[:, bit] == 1].mean(axis=0)) - np.log(shares[words[:, bit] == -1].mean(axis=0))
    learned = np.maximum((shares @ weights) * words, 1e-6)
    return LanguageCode(languages, words, weights, learned / learned.sum(axis=1, keepdims=True) if words.size else learned)


def language_counts(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Trigram counts of each language over all rows of ``labelled`` (``lang``, ``text``).

    Each task adds up its own rows; Spark adds up the tasks; the driver gets ``FEATURES`` rows a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), blobs(batch.column(1))):
                found = trigram_counts(text)
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, total in sums.items():
            features = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(features), pa.string()), pa.array(features.astype(np.int32)), pa.array(total[features].astype(np.int64))],
                ["lang", "feature", "n"],
            )

    parts = labelled.select("lang", "text").mapInArrow(count, "lang string, feature int, n long")
    tables: dict[str, np.ndarray] = {}
    for row in parts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).collect():
        tables.setdefault(row["lang"], np.zeros(FEATURES))[row["feature"]] = row["n"]
    return tables


def identify_language(docs: DataFrame, folds: int = 3, held_fold: int = 1, ambiguous_below: float = 0.75) -> DataFrame:
    """The language of every whole text, learned from documents outside the held fold.

    Teaching rows have a text, a ``lang``, and crc32(doc_id) modulo ``folds`` other than ``held_fold``.  Returns
    doc_id, held_out (NULL for a NULL id), lang_pred, score (the chosen codeword's share, 0 to 1) and
    ambiguous (score under ``ambiguous_below``), a row for each row.  A NULL text, one without a letter,
    and any text when nothing was learned give ``und`` with score 0.  Ties go to the first language in
    order of its name.  Only the texts decide; no other column enters a prediction.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    held = remainder(F.col("id"), folds) == held_fold
    taught = source.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull())
    code = fit_language_code(language_counts(taught))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, scores = [], []
            for text in blobs(batch.column(1)):
                if text is None or not code.languages or not _LETTER.search(text.decode("utf-8", "replace")):
                    chosen.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                losses = code.losses(trigram_counts(text))
                best = int(np.argmin(losses))
                chosen.append(code.languages[best])
                scores.append(float(1 / np.exp(losses[best] - losses).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chosen, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
            )

    return source.select("id", "text").mapInArrow(predict, "id long, lang_pred string, score double").select(
        F.col("id").alias("doc_id"),
        held.alias("held_out"),
        "lang_pred",
        "score",
        (F.col("score") < ambiguous_below).alias("ambiguous"),
    )

"""Packing documents into sequences, shortest pack first over the histogram of lengths.

Documents are cut at every ``size`` tokens, so only one piece of each is shorter.  The pieces' lengths
are placed longest first, all pieces of a length at once: they go to the packing pattern with the most
room left, as many as it has sequences, then to the next; what fits nowhere opens new sequences.
A pattern is kept as a range of sequence numbers with the same filling, so each step is one row
``(length, first rank, count, first sequence, offset)`` and a piece finds its place by its rank among
the pieces of its length.  Only the histogram, at most ``size`` rows, comes to the driver.
"""

from __future__ import annotations

import heapq
import itertools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer

from tidemark.llm.common import blobs, remembered, small, written

CACHED_WORDS = 1 << 20  # words a process remembers, at most
PLACE_SCHEMA = "length long, first_rank long, n long, first_sequence long, offset long"


class WordTokenizer:
    """Ids, as little-endian unsigned 32-bit integers, of words and of the pieces the tokenizer makes of them.

    The tokenizer drops white space and joins nothing across it, so words are encoded one by one and
    each distinct word once; likewise, of a Latin word its pieces in lower case.  With ``added_tokens`` the
    tokenizer's own added tokens, as "<|endoftext|>", have their ids wherever a text holds them, as by default in the
    tokenizer; without, they are text as any other.
    """

    # The tokenizer's own split, and the end of the scripts that Python lowers as it does.
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
    LATIN_END = "\u0370"

    def __init__(self, path: str, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.added: dict[bytes, bytes] = {}
        for token_id, token in self.tokenizer.get_added_tokens_decoder().items() if added_tokens else ():
            if token.normalized or token.single_word or token.lstrip or token.rstrip:
                raise ValueError("an added token that is not matched as it is written")
            self.added[token.content.encode()] = token_id.to_bytes(4, "little")
        self.added_places = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.words: dict[bytes, bytes] = dict(self.added)
        self.pieces: dict[str, bytes] = {}

    def forget(self) -> None:
        self.words, self.pieces = dict(self.added), {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.words) > CACHED_WORDS:
            self.forget()
        known, new = self.words, set()
        if self.added_places:  # a word of its own, also inside another
            texts = [self.added_places.sub(rb" \g<0> ", text) for text in texts]
        split = [text.split() for text in texts]
        for words in split:
            new.update(itertools.filterfalse(known.__contains__, words))
        self._learn(new)
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _learn(self, new: set[bytes]) -> None:
        split, others = [], []
        for word in new:
            text = word.decode("utf-8", "replace")
            if max(text) >= self.LATIN_END:
                others.append((word, text))
                continue
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            text = text.lower()
            split.append((word, (text,) if text.isalpha() else self.SPLIT.findall(text)))
        distinct = {piece for _, pieces in split for piece in pieces}
        self._learn_pieces([piece for piece in distinct if piece not in self.pieces])
        of = self.pieces.__getitem__
        for word, pieces in split:
            self.words[word] = of(pieces[0]) if len(pieces) == 1 else b"".join(map(of, pieces))
        found = self.tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
        for (word, _), encoding in zip(others, found):
            self.words[word] = np.array(encoding.ids, "<u4").tobytes()

    def _learn_pieces(self, ordered: list[str]) -> None:
        """Encode the pieces in one go: each ends with its one token that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(ordered)], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(ordered):
            raise ValueError("the tokenizer does not split words as expected")
        data, at = ids.tobytes(), 0
        for piece, stop in zip(ordered, stops):
            self.pieces[piece] = data[at:stop]
            at = stop


def token_bytes(path: str, texts: list[bytes], added_tokens: bool = False) -> list[bytes]:
    """Ids of each text, each id as a little-endian unsigned 32-bit integer.

    The words a process has met stay known to its later packing tasks, which learning them anew would cost a third more.
    """
    return remembered((WordTokenizer, path, added_tokens), lambda: WordTokenizer(path, added_tokens)).encode(texts)


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    size: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``size`` token ids of every whole text, its end id included.

    Returns ``id_col``, ``start`` (ids of the document before the piece), ``length``, ``ids`` (binary:
    little-endian unsigned 32-bit; with ``keep_ids``, else they do not leave the task), ``doc_tokens`` and
    ``ids_crc32``.  A NULL text counts as empty: one piece that holds the end id.  NULL ids and repeated rows are kept, other columns are not looked at.
    """
    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    end, step = end_id.to_bytes(4, "little"), 4 * size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 32):
            rows: list[tuple] = []
            texts = [text or b"" for text in blobs(batch.column(1))]
            for doc_id, ids in zip(batch.column(0).to_pylist(), token_bytes(tokenizer_path, texts, added_tokens)):
                ids += end
                total = len(ids) // 4
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    rows.append((doc_id, at // 4, len(part) // 4, total, zlib.crc32(part), part if keep_ids else None))
            if rows:
                columns = list(zip(*rows))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                    ["id", "start", "length", "doc_tokens", "ids_crc32", "ids"],
                )

    found = source.mapInArrow(cut, "id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary")
    found = found.select("id", "start", "length", *["ids"] * keep_ids, "doc_tokens", "ids_crc32")
    return found.withColumnRenamed("id", id_col)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Places ``(length, first rank, count, first sequence, offset)`` for ``histogram[length]`` pieces each.

    ``packs`` is a heap of patterns ``(filling, first sequence, count)``: the shortest pack is its head.
    """
    packs: list[tuple[int, int, int]] = []
    places, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and packs[0][0] + length <= size:
                filling, first, count = heapq.heappop(packs)
                used = min(count, left)
                if used < count:
                    heapq.heappush(packs, (filling, first + used, count - used))
            else:
                filling, first, used = 0, sequences, left
                sequences += used
            places.append((length, rank, used, first, filling))
            if filling + length < size:
                heapq.heappush(packs, (filling + length, first, used))
            rank, left = rank + used, left - used
    return places


def place_pieces(pieces: DataFrame, size: int = 4096, rank_buckets: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: its sequence, and the ids there before it.

    ``pieces`` needs ``length`` (1 to ``size``) and may hold any other columns but those two; it has to
    give the same rows whenever it is read (a written table), since it is numbered.  Ranks of a
    length are numbered by hash buckets with offsets from their counts, so that a length that a third
    of all pieces have is spread over ``rank_buckets`` groups.  An empty table stays empty; which of
    two equal pieces gets which place has no meaning.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    bucket = F.pmod(F.xxhash64(*columns), F.lit(rank_buckets))
    bucketed = pieces.withColumn("_bucket", bucket)
    counts = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("length", "_bucket").orderBy(*columns)
    ranked = (
        bucketed.withColumn("_row", F.row_number().over(within) - 1)
        .join(first, ["length", "_bucket"])
        .withColumn("_rank", F.col("_row") + F.col("_before"))
    )
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    places = spark.createDataFrame(shortest_pack_first(histogram, size), T._parse_datatype_string(PLACE_SCHEMA))
    here = (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("first_rank") + F.col("n"))
    return ranked.join(
        places.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & here
    ).select(
        *columns,
        (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )


def sequence_tokens(placed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``n_tokens`` and ``ids`` in order of their offsets."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, size: int = 4096, keep_ids: bool = True, added_tokens: bool = False
) -> DataFrame:
    """Every token id of every document in one place of a sequence of at most ``size`` ids.

    Returns doc_id, start, length, ids (with ``keep_ids``), ids_crc32, doc_tokens, sequence_id and
    offset.  Cases are those of ``WordTokenizer``, ``cut_documents`` and ``place_pieces``.
    """
    pieces = cut_documents(docs, tokenizer_path, end_id, size, added_tokens=added_tokens, keep_ids=keep_ids)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    return place_pieces(written(pieces.select(*columns), "pieces"), size)

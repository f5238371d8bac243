"""Exact de-duplication by recipes of content-defined chunks.

Texts are cut where a rolling hash of their own bytes says so.  Chunks with one digest meet once per
map task, their bytes are compared, and each distinct content gets a verified identifier.  Two texts
are equal exactly if their ordered identifier lists are; long documents are never moved whole again.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import ASCII_SPACE, blobs, forget, small, written

# Texts that are cut together: what a task makes of their bytes is several times as large.
TEXTS_AT_ONCE = 256
# Row numbers that are broadcast, at most (16 bytes each in the table that tasks look them up in).
BROADCAST_ROWS = 1 << 20
# A cut follows each byte where the hash of the last WINDOW bytes has its CUT_BITS low bits zero.
WINDOW, CUT_BITS = 16, 11
SHORTEST, LONGEST = 512, 16_384
_MULTIPLIER = 0x9E3779B1
_BYTE_HASH = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def cut_places(data: bytes) -> np.ndarray:
    """Offsets after which the content asks for a cut, before lengths are bounded."""
    sums = _BYTE_HASH[np.frombuffer(data, np.uint8)]
    width, factor = 1, _MULTIPLIER
    while width < WINDOW:  # sums of 1, 2, 4, ... bytes: each from two of the width before
        wider = sums.copy()
        wider[width:] += sums[:-width] * np.uint32(factor)
        sums, width, factor = wider, 2 * width, factor * factor & 0xFFFFFFFF
    sums ^= sums >> np.uint32(15)
    sums *= np.uint32(0x85EBCA77)
    return np.flatnonzero((sums >> np.uint32(32 - CUT_BITS)) == 0) + 1


def chunk_ends(places: np.ndarray, start: int, stop: int) -> list[int]:
    """Ends of the chunks of ``[start, stop)``: each at a place, between the two bounds in length.

    Places whose window reaches into the text before are not used, so the cuts of a text do not
    depend on where it stands.
    """
    ends, at = [], start
    for place in places[np.searchsorted(places, start + WINDOW) : np.searchsorted(places, stop)].tolist():
        while place - at > LONGEST:
            at += LONGEST
            ends.append(at)
        if place - at >= SHORTEST:
            ends.append(place)
            at = place
    while stop - at > LONGEST:
        at += LONGEST
        ends.append(at)
    return ends + [stop]


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (``digest`` random, ``content`` NULL) and of the distinct chunks of some texts."""
    forget()
    for batch in small(batches, TEXTS_AT_ONCE):
        rows = batch.column(2).to_pylist()
        texts = [(text or b"").translate(None, ASCII_SPACE) for text in blobs(batch.column(1))]
        places = cut_places(b"".join(texts))
        chunks: dict[bytes, tuple[bytes, list[int], list[int]]] = {}
        variants: list[tuple[bytes, bytes, list[int], list[int]]] = []
        hashes, start = [], 0
        for row_id, text in zip(rows, texts):
            hashes.append(hashlib.sha256(text).digest())
            at = start
            for order, end in enumerate(chunk_ends(places, start, start + len(text))):
                content = text[at - start : end - start]
                digest = hashlib.blake2b(content, digest_size=16).digest()
                held = chunks.get(digest)
                if held is None:
                    held = chunks[digest] = (content, [], [])
                elif held[0] != content:  # another content with that digest: a row of its own
                    variants.append((digest, content, [row_id], [order]))
                    at = end
                    continue
                held[1].append(row_id)
                held[2].append(order)
                at = end
            start += len(text)
        found = [(digest, *held) for digest, held in chunks.items()] + variants
        none = [None] * len(found)
        spread = [struct.pack("<Q", row_id * 0x9E3779B97F4A7C15 % 2**64) for row_id in rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(spread + [f[0] for f in found], pa.binary()),
                pa.array([None] * len(texts) + [f[1] for f in found], pa.binary()),
                pa.array([[row_id] for row_id in rows] + [f[2] for f in found], pa.list_(pa.int64())),
                pa.array([None] * len(texts) + [f[3] for f in found], pa.list_(pa.int32())),
                pa.array(batch.column(0).to_pylist() + none, pa.int64()),
                pa.array(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist() + none, pa.int64()),
                pa.array(hashes + none, pa.binary()),
            ],
            ["digest", "content", "row_ids", "orders", "id", "code_points", "sha256"],
        )


def _verify_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by digest in; for every chunk of a document its verified identifier out."""
    last, contents = None, []
    for batch in batches:
        identifiers = []
        for digest, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if content is None:
                identifiers.append(None)
                continue
            if digest != last:
                last, contents = digest, []
            if content not in contents:
                contents.append(content)
            identifiers.append(digest + struct.pack("<H", contents.index(content)))
        counts = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        of = pa.array(np.repeat(np.arange(batch.num_rows), counts))
        orders = pc.if_else(pc.is_null(batch.column(3)), pa.scalar([None], pa.list_(pa.int32())), batch.column(3))
        yield pa.RecordBatch.from_arrays(
            [
                pc.list_flatten(batch.column(2)),
                pc.list_flatten(orders),
                pa.array(identifiers, pa.binary()).take(of),
                *(batch.column(k).take(of) for k in (4, 5, 6)),
            ],
            ["row_id", "order", "chunk", "id", "code_points", "sha256"],
        )


def document_recipes(source: DataFrame) -> DataFrame:
    """Per row of ``source`` (id, text, row_id): ``id``, ``row_id``, ``code_points``, ``sha256`` (binary), ``recipe``.

    ``recipe`` is the list of (place, verified chunk identifier) of the text without ASCII white space;
    equal texts have equal recipes and others have not.  The table is written before it is returned.
    """
    cut = source.select("id", "text", "row_id").mapInArrow(
        _cut_texts,
        "digest binary, content binary, row_ids array<long>, orders array<int>, id long, code_points long, sha256 binary",
    )
    chunks = written(
        cut.repartition("digest")
        .sortWithinPartitions("digest")
        .mapInArrow(
            _verify_chunks, "row_id long, order int, chunk binary, id long, code_points long, sha256 binary"
        ),
        "chunks",
    )
    listed = F.when(F.col("order").isNotNull(), F.struct("order", "chunk"))
    return chunks.groupBy("row_id").agg(
        F.max("id").alias("id"),
        F.max("code_points").alias("code_points"),
        F.max("sha256").alias("sha256"),
        F.sort_array(F.collect_list(listed)).alias("recipe"),
    )


def exact_groups(source: DataFrame) -> DataFrame:
    """Per row of ``source`` (id, text, row_id): ``id``, ``row_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    recipes = document_recipes(source)
    best = F.max(
        F.struct(
            "code_points",
            F.col("id").isNotNull().alias("named"),
            F.bitwise_not("id").alias("id"),
            F.bitwise_not("row_id").alias("row"),
        )
    )
    # Written, so that both sides of the join are plain shuffles and a recipe that many rows have can be split.
    counted = recipes.groupBy("recipe").agg(best.alias("best"), F.count("*").alias("group_size"))
    groups = written(counted.where("group_size > 1"), "groups")
    alone = F.col("group_size").isNull()
    return recipes.join(groups, "recipe", "left").select(
        "id",
        "row_id",
        F.when(alone, F.col("id")).otherwise(F.bitwise_not(F.col("best.id"))).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.bitwise_not(F.col("best.row")) == F.col("row_id"))).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def keep_distinct_texts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, by the rule of ``dedup_exact``, with all their columns.

    ``docs`` has to be read the same way twice (a table), since its rows are numbered.  Texts stay where they are
    as long as the numbers of the rows that go can be broadcast; beyond ``BROADCAST_ROWS`` they are shuffled.
    """
    numbered = docs.select(F.struct(*(docs[name] for name in docs.columns)).alias("doc"), F.monotonically_increasing_id().alias("row_id"))
    source = numbered.select(
        F.col("doc")[id_col].cast("long").alias("id"), F.col("doc")[text_col].cast("string").alias("text"), "row_id"
    )
    gone = written(exact_groups(source).where("not kept").select("row_id"), "gone")
    few = gone.count() <= BROADCAST_ROWS
    return numbered.join(F.broadcast(gone) if few else gone, "row_id", "left_anti").select(*(F.col("doc")[name].alias(name) for name in docs.columns))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which of the rows with equal texts, white space apart, stays.

    Of equal texts the row with the most code points in its original text stays, then the smallest id (a
    NULL id last), then the first of repeated rows.  Returns one row per row of ``docs``: ``id_col``,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (of the text without white space).  NULL
    text counts as empty and all empty texts are equal; an empty table gives an empty one; other
    columns are not looked at.  A group's best row comes from a partial aggregate, is written and
    joins back; the rows of a text that a third of all have are then a skewed join key, which adaptive execution splits.
    """
    source = docs.select(
        docs[id_col].cast("long").alias("id"),
        docs[text_col].cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    return exact_groups(source).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256"
    )

"""Language-model scores of whole texts by context-tree weighting over bytes.

A byte is eight binary decisions, each seen in the contexts of the 0 to ``depth`` bytes before it.  A node keeps a
Krichevsky-Trofimov estimate from its own two counts; the weighted probability of a node is half its own
estimate and half the product of those of its children, so all depths are mixed by how well each explains the
training texts.  The tree is built level by level with ordinary aggregations, from the leaves up, and the mixed
probability of each context comes from the root down.

Nothing of the model is broadcast.  Each scan partition (block) asks only for the n-grams and words that
occur in it: requests and counts travel packed, meet by bucket of their key, and the answers return to the block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import LOWER_ASCII, blobs, remainder, small, written
from tidemark.llm.ngram_join import CACHED_WORDS, _mix, _word_hashes, hashes_of

BORDER = 255  # never a byte of UTF-8: stands before and after each text
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a whole text, capitals lowered."""
    words, known = text.translate(LOWER_ASCII).split(), _word_hashes()
    if len(known) > CACHED_WORDS:
        known.clear()
    return hashes_of(words, known)


def byte_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams (``depth`` bytes before, then the byte) of all texts with their ends, and where each text's begin.

    A text of n bytes has n + 1 grams; the last one is its end.
    """
    border = bytes([BORDER]) * depth
    joined = np.frombuffer(border + border.join(texts) + border, np.uint8)
    grams = np.zeros(len(joined) - depth, np.uint64)
    for back in range(depth + 1):
        grams = (grams << np.uint64(8)) | joined[back : back + len(grams)]
    lengths = np.array([len(text) + 1 for text in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # Between two texts stand depth borders: one is the end of the first, the others begin no gram.
    place = np.arange(starts[-1]) + np.repeat(np.arange(len(texts)) * (depth - 1), lengths)
    return grams[place], starts[:-1]


class _Counter:
    """Counts of 64-bit keys, kept sorted; a key may have count 0."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counted: bool) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.parts.append((found, counts if counted else np.zeros(len(found), np.int64)))
        self.waiting += len(found)
        if self.waiting > 2_000_000:
            self.parts = [self.total()]
            self.waiting = 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return _added(self.parts)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(side) for side in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _by_bucket(keys: np.ndarray, counts: np.ndarray, buckets: int) -> dict[int, tuple[bytes, bytes]]:
    bucket = (_mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, counts = bucket[order], keys[order], counts[order]
    bounds = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
    return {
        b: (keys[low:high].tobytes(), counts[low:high].tobytes())
        for b, (low, high) in enumerate(zip(bounds, bounds[1:]))
        if low < high
    }


ITEMS = "bucket int, block int, word_keys binary, word_counts binary, gram_keys binary, gram_counts binary"


def _count_items(depth: int, buckets: int):
    """For each bucket one row of the task: its distinct words and grams with their counts in training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, grams = TaskContext.get().partitionId(), _Counter(), _Counter()
        for batch in small(batches, 1_024):
            taught = batch.column(1).to_pylist()
            texts = [text or b"" for text in blobs(batch.column(2))]
            for train in (True, False):
                some = [text for text, flag in zip(texts, taught) if bool(flag) == train]
                if some:
                    words.add(np.concatenate([word_hashes(text) for text in some]), train)
                    grams.add(byte_grams(some, depth)[0], train)
        word_rows, gram_rows = _by_bucket(*words.total(), buckets), _by_bucket(*grams.total(), buckets)
        for bucket in sorted({*word_rows, *gram_rows}):
            values = [*word_rows.get(bucket, (b"", b"")), *gram_rows.get(bucket, (b"", b""))]
            columns = [pa.array([bucket], pa.int32()), pa.array([block], pa.int32()), *(pa.array([v], pa.binary()) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, [name.split()[0] for name in ITEMS.split(", ")])

    return count


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each value of the first column, which they are sorted by."""
    current, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row[batch.schema.names[0]]
            if held and key != current:
                yield current, held
                held = []
            current = key
            held.append(row)
    if held:
        yield current, held


MERGED = "kind string, bucket int, block int, keys binary, counts binary, gram long, n long, known long"


def _merge_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: answers with total counts to the blocks' words, the grams' totals, and sums over words."""
    names = [name.split()[0] for name in MERGED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def batch_of(rows: int, **values) -> pa.RecordBatch:
        arrays = [pa.array(values[n], k) if n in values else pa.nulls(rows, k) for n, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for bucket, rows in _grouped(batches):
        parts = {
            kind: [(np.frombuffer(r[f"{kind}_keys"], np.uint64), np.frombuffer(r[f"{kind}_counts"], np.int64)) for r in rows]
            for kind in ("word", "gram")
        }
        keys, counts = _added(parts["word"])
        for row, (asked, _) in zip(rows, parts["word"]):
            if len(asked):
                answer = counts[np.searchsorted(keys, asked)]
                yield batch_of(1, kind=["word"], block=[row["block"]], keys=[asked.tobytes()], counts=[answer.tobytes()])
        yield batch_of(1, kind=["sum"], n=[int(counts.sum())], known=[int((counts > 0).sum())])
        keys, counts = _added(parts["gram"])
        if len(keys):
            yield batch_of(len(keys), kind=["gram"] * len(keys), bucket=[bucket] * len(keys), gram=keys.astype(np.int64), n=counts)


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) by Stirling's series at x + 7."""
    z, low = x + 7, x
    for k in range(1, 7):
        low = low * (x + k)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(low)


def _log_kt(a: Column, b: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones in any order."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)


def _log_gamma_of(x: np.ndarray) -> np.ndarray:
    z = x + 7
    low = np.prod([x + k for k in range(7)], axis=0)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(low)


class _Subtrees:
    """Levels ``depth`` to ``top`` of the tree over grams whose last ``top`` bytes of context are all here.

    A node's place is its context and, in the low byte, the decisions made so far.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, top: int):
        steps = np.arange(8, dtype=np.uint64)[:, None]
        symbol, context = grams & np.uint64(255), grams >> np.uint64(8)
        nodes = (np.uint64(1) << steps) | (symbol >> (np.uint64(8) - steps))
        self.bits = ((symbol >> (np.uint64(7) - steps)) & np.uint64(1)).astype(np.float64)
        places, self.of = np.unique((context << np.uint64(8)) | nodes, return_inverse=True)
        self.of = self.of.reshape(8, -1)
        ones = np.bincount(self.of.ravel(), (self.bits * counts).ravel(), len(places))
        zeros = np.bincount(self.of.ravel(), ((1 - self.bits) * counts).ravel(), len(places))
        below, self.levels = None, []
        for k in range(depth, top - 1, -1):
            if below is not None:
                short = (places & np.uint64(255)) | (((places >> np.uint64(8)) & np.uint64((1 << (8 * k)) - 1)) << np.uint64(8))
                places, parent = np.unique(short, return_inverse=True)
                zeros, ones, below = (np.bincount(parent, v, len(places)) for v in (zeros, ones, log_w))
                self.levels[-1]["parent"] = parent
            own = _log_gamma_of(zeros + 0.5) + _log_gamma_of(ones + 0.5) - _log_gamma_of(zeros + ones + 1) - math.log(math.pi)
            log_w = own if below is None else math.log(0.5) + np.logaddexp(own, below)
            beta = np.ones(len(own)) if below is None else 1 / (1 + np.exp(np.minimum(below - own, 700)))
            below = log_w
            self.levels.append({"places": places, "a": zeros, "b": ones, "log_w": log_w, "beta": beta})

    def log10_p(self, top_places: np.ndarray, p: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Of each gram, given the mixture down to the top level."""
        at = np.searchsorted(top_places, self.levels[-1]["places"])
        p, left = p[at], left[at]
        for level in self.levels[-2::-1]:
            p, left = p[level["parent"]], left[level["parent"]]
            p = p + left * level["beta"] * (level["b"] + 0.5) / (level["a"] + level["b"] + 1)
            left = left * (1 - level["beta"])
        one = p[self.of]
        return np.log10(np.where(self.bits == 1, one, 1 - one)).sum(axis=0)


def _all_rows(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [batch for batch in batches if batch.num_rows]
    return pa.Table.from_batches(held) if held else None


def weighted_grams(grams: DataFrame, depth: int, top: int = 3) -> DataFrame:
    """``grams`` (bucket, gram, n) with ``log10_p``: the weighted probability of the gram's byte in its context.

    Levels below ``top`` are made in tasks that hold all grams of their last ``top`` bytes of context, which
    are at most 256 ** (depth - top + 1); the levels above are aggregations and joins of their nodes.
    """
    top = min(top, depth)
    suffix = F.shiftright("gram", 8).bitwiseAND((1 << (8 * top)) - 1)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _all_rows(batches)
        if table is None:
            return
        level = _Subtrees(table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy(), depth, top).levels[-1]
        context, node = (level["places"] >> np.uint64(8)).astype(np.int64), (level["places"] & np.uint64(255)).astype(np.int64)
        values = [context, node, level["a"], level["b"], level["log_w"], level["beta"]]
        yield from pa.table(dict(zip(("context", "node", "a", "b", "log_w", "beta"), values))).to_batches(100_000)

    own = _log_kt(F.col("a"), F.col("b"))
    placed = grams.withColumn("suffix", suffix).repartition("suffix").select("bucket", "gram", "n")
    level = written(placed.mapInArrow(up, "context long, node long, a double, b double, log_w double, beta double"), "level")
    levels = [level]
    for k in range(top - 1, -1, -1):
        shorter = F.col("context").bitwiseAND((1 << (8 * k)) - 1).alias("context")
        children = level.groupBy(shorter, "node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("log_w").alias("below"))
        apart = F.col("below") - own
        level = written(
            children.select(
                "context",
                "node",
                "a",
                "b",
                # ln(e^own / 2 + e^below / 2), by the larger of the two
                (math.log(0.5) + F.greatest(own, F.col("below")) + F.log1p(F.exp(-F.abs(apart)))).alias("log_w"),
                (1 / (1 + F.exp(F.least(apart, F.lit(700.0))))).alias("beta"),
            ),
            "level",
        )
        levels.append(level)
    one = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    mixed = levels[-1].select("context", "node", (F.col("beta") * one).alias("p"), (1 - F.col("beta")).alias("left"))
    for k in range(1, top + 1):
        parents = mixed.select(F.col("context").alias("parent"), "node", "p", "left")
        joined = levels[top - k].withColumn("parent", F.col("context").bitwiseAND((1 << (8 * (k - 1))) - 1)).join(parents, ["parent", "node"])
        mixed = joined.select(
            "context", "node", (F.col("p") + F.col("left") * F.col("beta") * one).alias("p"), (F.col("left") * (1 - F.col("beta"))).alias("left")
        )

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _all_rows(batches)
        if table is None:
            return
        is_gram = table["gram"].is_valid()
        rows, nodes = table.filter(is_gram), table.filter(pc.invert(is_gram))
        places = (nodes["suffix"].to_numpy() << 8 | nodes["node"].to_numpy()).astype(np.uint64)
        order = np.argsort(places)
        p, left = nodes["p"].to_numpy()[order], nodes["left"].to_numpy()[order]
        tree = _Subtrees(rows["gram"].to_numpy().astype(np.uint64), rows["n"].to_numpy(), depth, top)
        found = tree.log10_p(places[order], p, left)
        yield from pa.table({"bucket": rows["bucket"], "gram": rows["gram"], "log10_p": found}).to_batches(100_000)

    nothing = F.lit(None)
    of_grams = grams.select(
        suffix.alias("suffix"), "bucket", "gram", "n", *(nothing.cast(t).alias(c) for c, t in (("node", "long"), ("p", "double"), ("left", "double")))
    )
    of_nodes = mixed.select(
        F.col("context").alias("suffix"), *(nothing.cast(t).alias(c) for c, t in (("bucket", "int"), ("gram", "long"), ("n", "long"))), "node", "p", "left"
    )
    return of_grams.union(of_nodes).repartition("suffix").mapInArrow(down, "bucket int, gram long, log10_p double")


def _answer_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: the model's rows and the blocks' requests in, answers out."""
    for _, rows in _grouped(batches):
        model = [(r["gram"], r["log10_p"]) for r in rows if r["gram"] is not None]
        keys, values = np.array([m[0] for m in model], np.uint64), np.array([m[1] for m in model])
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        for row in rows:
            if row["gram"] is None:
                found = values[np.searchsorted(keys, np.frombuffer(row["keys"], np.uint64))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int32()), pa.array([row["keys"]], pa.binary()), pa.array([found.tobytes()], pa.binary())],
                    ["block", "keys", "counts"],
                )


class _Table:
    """Values of 64-bit keys: a direct-mapped table, and a binary search for keys that lost their slot."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        keys, values = (np.concatenate(side) for side in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(4, int(len(keys)).bit_length() + 1))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _GOLDEN) >> self.shift

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0)
        place = self.slots[self._slot(keys)]
        lost = np.flatnonzero(self.keys[place] != keys)
        place[lost] = np.searchsorted(self.keys, keys[lost])
        if len(lost) and (self.keys[np.minimum(place[lost], len(self.keys) - 1)] != keys[lost]).any():
            raise ValueError("the documents were not read the same way twice")
        return self.values[place]


def _score_blocks(depth: int, total: int, distinct: int, texts_taught: int):
    """Rows of a block in: answers for words, for grams, then documents; scores out."""
    divisor = total + distinct + 1
    end = math.log10((texts_taught + 1) / divisor)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, tables = None, {}, None
        for batch in small(batches):
            blocks, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, counts, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist(), blobs(batch.column(4))
            ids, at = batch.column(5).to_pylist(), 0
            while at < len(blocks):
                if blocks[at] != block:
                    block, held, tables = blocks[at], {0: [], 1: []}, None
                if kinds[at] < 2:
                    kind = np.int64 if kinds[at] == 0 else np.float64
                    held[kinds[at]].append((np.frombuffer(keys[at], np.uint64), np.frombuffer(counts[at], kind)))
                    at += 1
                    continue
                tables = tables or (_Table(held[0]), _Table(held[1]))
                stop = at
                while stop < len(blocks) and blocks[stop] == block:
                    stop += 1
                some = [text or b"" for text in texts[at:stop]]
                words = [word_hashes(text) for text in some]
                found = tables[0][np.concatenate(words)] if words else np.zeros(0)
                logs = np.log10((found + 1) / divisor)
                bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).tolist()
                grams, starts = byte_grams(some, depth)
                scores = np.add.reduceat(tables[1][grams], starts)
                rows = [
                    (i, len(w) + 1, int((found[a:b] > 0).sum()) + (texts_taught > 0), float(logs[a:b].sum()) + end, s, -s / math.log10(2) / (len(t) + 1))
                    for i, w, a, b, s, t in zip(ids[at:stop], words, bounds, bounds[1:], scores.tolist(), some)
                ]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*rows), types)],
                    ["id", "n_tokens", "n_known", "base_score", "score", "bits_per_byte"],
                )
                at = stop

    return score


def score_texts(
    docs: DataFrame, depth: int = 5, folds: int = 7, held_fold: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Log probabilities of every whole text, learned from all texts outside the held fold.

    Training texts are those whose crc32(id) modulo ``folds`` is not ``held_fold``.  Returns for each row ``id_col``,
    held_out, n_tokens (words and one end), n_known, train_tokens, base_score (log10 by add-one
    counts of words), score (log10 by the context tree, end included) and bits_per_byte (the code length).
    A NULL text counts as empty: it has an end.  A NULL id is scored and teaches nothing, held_out is NULL.
    Repeated rows teach and score as often as they are there; an empty table gives an empty one; other columns
    are not looked at.  ``docs`` has to be read the same way twice (a table): its scan partitions are the blocks.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    taught = F.coalesce(remainder(F.col("id"), folds) != held_fold, F.lit(False))
    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    flagged = source.select("id", taught.alias("taught"), "text")
    items = written(flagged.mapInArrow(_count_items(depth, buckets), ITEMS), "items")
    merged = written(items.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge_items, MERGED), "counts")
    sums = merged.where("kind = 'sum'").agg(F.sum("n"), F.sum("known")).first()
    texts_taught = flagged.where("taught").count()
    total, distinct = (sums[0] or 0) + texts_taught, (sums[1] or 0) + (texts_taught > 0)

    grams = merged.where("kind = 'gram'").select("bucket", "gram", "n")
    nothing = F.lit(None)
    requests = items.where(F.octet_length("gram_keys") > 0).select(
        "bucket", "block", F.col("gram_keys").alias("keys"), nothing.cast("long").alias("gram"), nothing.cast("double").alias("log10_p")
    )
    model = weighted_grams(grams, depth).select(
        "bucket", nothing.cast("int").alias("block"), nothing.cast("binary").alias("keys"), "gram", "log10_p"
    )
    answers = requests.union(model).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answer_grams, "block int, keys binary, counts binary")

    empty = {"keys": "binary", "counts": "binary", "text": "string", "id": "long"}

    def rows_of(df: DataFrame, kind: int) -> DataFrame:
        values = [F.col(name) if name in df.columns else nothing.cast(t).alias(name) for name, t in empty.items()]
        return df.select("block", F.lit(kind).alias("kind"), *values)

    asked = rows_of(merged.where("kind = 'word'").select("block", "keys", "counts"), 0).union(rows_of(answers, 1))
    held_docs = rows_of(source.withColumn("block", F.spark_partition_id()), 2)
    # One task a block, as large as a scan partition: hashes of block numbers would bring several together.
    blocks = 1 + (items.agg(F.max("block")).first()[0] or 0)
    scored = (
        asked.union(held_docs)
        .repartitionById(blocks, F.col("block"))
        .sortWithinPartitions("block", "kind")
        .mapInArrow(
            _score_blocks(depth, total, distinct, texts_taught),
            "id long, n_tokens long, n_known long, base_score double, score double, bits_per_byte double",
        )
    )
    return scored.select(
        F.col("id").alias(id_col),
        (remainder(F.col("id"), folds) == held_fold).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "bits_per_byte",
    )

"""Exact near duplicates by Jaccard similarity of word shingles: a universe-partition join.

Shingles are hashed to 64 bits and the hash space is cut into segments, as many as the size band of a set asks
for.  Two sets that link differ in so few shingles that, of more segments than that, one is equal in
both; where a set leaves too many segments empty for that, its segments also index what is left of them after
deleting one shingle.  Documents that share such a key are candidates; their texts are compared exactly.

A set with more filled segments than it needs shares several with any partner.  It drops as many of its keys
as that allows, the most frequent in the corpus first: so common passages make no candidates.  Of a pair, parities
of the hashes' endings give a lower bound of the difference, which rules most chance candidates out.

A candidate pair is needed only where it may join two components.  So first each key's members are compared with one
of them, and only pairs of a key that then still lie in different components follow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import LOWER_ASCII, blobs, remembered, small, written
from tidemark.llm.components import connected_components

SHINGLE_WORDS = 5
CACHED_WORDS = 1 << 17  # words met before, at most so many and none longer than CACHED_BYTES
CACHED_BYTES = 64
GROUP_PART = 1_024  # members of a group that one row or task takes
LINK_BLOCK = 256  # sets of a component that are compared with as many others at once
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _word_hashes() -> dict[bytes, int]:
    """Per process: hashes of words met before; emptied when full."""
    return remembered("word hashes", dict)


def hashes_of(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """The hash of each word; short ones are remembered in ``known``."""
    try:
        return np.array(list(map(known.__getitem__, words)), np.uint64)
    except KeyError:
        found = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = xxhash.xxh3_64_intdigest(word)
                if len(word) <= CACHED_BYTES:
                    known[word] = value
            found.append(value)
        return np.array(found, np.uint64)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words, known = text.translate(LOWER_ASCII).split(), _word_hashes()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > CACHED_WORDS:
        known.clear()
    hashes = hashes_of(words, known)
    if len(words) < SHINGLE_WORDS:
        return _mix(np.array([(hashes * _FACTORS[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))], np.uint64))
    n = len(words) - SHINGLE_WORDS + 1
    total = hashes[:n] * _FACTORS[0]
    for k in range(1, SHINGLE_WORDS):
        total += hashes[k : k + n] * _FACTORS[k]
    return np.unique(_mix(total))


class Bands:
    """Size bands and, for each, how many segments its sets are cut into."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]

    def largest_partner(self, size: int) -> int:
        return size * 100 // self.percent

    def of(self, size: int) -> list[int]:
        """The bands a set joins in: its own, and lower ones that hold a smaller partner."""
        while self.lows[-1] <= size:
            self.lows.append(max(self.lows[-1] + 1, self.largest_partner(self.lows[-1]) + 1))
        band = int(np.searchsorted(self.lows, size, "right")) - 1
        found = [band]
        while band and self.largest_partner(self.lows[band] - 1) >= size:
            band -= 1
            found.append(band)
        return found

    def difference(self, band: int) -> int:
        """The most shingles by which a set of the band and a larger partner differ if they link."""
        return _most_different(self.lows[band + 1] - 1, self.largest_partner(self.lows[band + 1] - 1), self.percent)

    @lru_cache(maxsize=None)  # noqa: B019
    def segments(self, band: int) -> int:
        """The number of segments with the least expected keys over the sizes of the band.

        A set of n shingles in m segments has about m(1 - exp(-n/m)) that are not empty, each a key.  If those are
        no more than the difference allowed, it needs its n deletions too: with few segments that
        is likely, with many there are more keys.
        """
        allowed = self.difference(band)
        low, high = self.lows[band], self.lows[band + 1] - 1
        sizes = np.unique(np.linspace(low, high, 9).astype(int))
        best, least = 1, np.inf
        for m in range(allowed + 1, 3 * allowed + 4, max(1, allowed // 64)):
            empty = np.exp(-sizes / m)
            filled = m * (1 - empty)
            deviation = np.sqrt(np.maximum(1e-9, m * empty * (1 - empty * (1 + sizes / m))))
            short = 1 / (1 + np.exp(-1.7 * (allowed + 0.5 - filled) / deviation))
            cost = (filled + short * sizes).mean()
            if cost < least:
                best, least = m, cost
        return best


def _most_different(a: int, b: int, percent: int) -> int:
    # linked: 100 * shared >= percent * union, shared + union = a + b, difference = union - shared
    return (100 - percent) * (a + b) // (100 + percent)


def set_keys(hashes: np.ndarray, bands: Bands) -> tuple[np.ndarray, list[int]]:
    """Keys of a set: any set that links with it has one of them too, and how many it has at least.

    Let d be the band's allowed difference.  A set with over d filled segments shares one whole with its
    partner.  Otherwise segments of two or more shingles count twice, since one shingle of difference
    there is found by a deletion; a set short even then indexes its single shingles.  The lowest bit of a
    key is that of its band; the second result has the number shared, at least, for either bit.
    """
    spread = _mix(hashes + _GOLDEN)
    size, joined = len(hashes), bands.of(len(hashes))
    found, shared = [], [1, 1]
    for band in joined:
        m, allowed = bands.segments(band), bands.difference(band)
        segment = ((hashes >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sums = np.add.reduceat(spread, starts)
        label = segment[starts] * _GOLDEN + np.uint64((2 * band + 1) * 0xC2B2AE3D27D4EB4F % 2**64)
        keys = [_mix(sums + label)]
        if len(starts) > allowed:
            # partners are larger in the set's own band, and from the band in a lower one
            partner = bands.largest_partner(size) if band == joined[0] else bands.lows[band + 1] - 1
            if len(joined) <= 2:  # else two of the bands have one bit
                shared[band & 1] = max(1, len(starts) - _most_different(size, partner, bands.percent))
        else:
            counts = np.diff(np.append(starts, size))
            several = np.repeat(counts >= 2, counts)
            keys.append(_mix(np.repeat(sums + label, counts)[several] - spread[several]))
            if len(starts) + (counts >= 2).sum() <= allowed:
                keys.append(_mix(spread + np.uint64(2 * band * 0x165667B19E3779F9 % 2**64)))
        found.append(np.concatenate(keys) & ~np.uint64(1) | np.uint64(band & 1))
    return np.unique(np.concatenate(found)), shared


def _key_blobs(percent: int, buckets: int):
    """Rows of documents, and of each bucket's keys and set digests of a batch as one binary value."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in small(batches, 512, 4 << 20):
            sizes, nodes, sketches, least, keys, owners, seen = [], [], [], [], [], [], set()
            for doc_id, text in zip(batch.column(0).to_pylist(), blobs(batch.column(1))):
                hashes = shingle_set(text or b"")
                node = int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
                sizes.append(len(hashes))
                nodes.append(node)
                sketches.append(sketch(hashes))
                found, shared = set_keys(hashes, bands) if len(hashes) else (np.zeros(0, np.uint64), [1, 1])
                # Keys that become one when cut to bucket and 32 bits count once.
                cut = ((found >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (found & np.uint64(0xFFFFFFFF))
                lost = len(cut) - len(np.unique(cut))
                shared = [max(1, n - lost) for n in shared]
                least.append(shared)
                if doc_id is not None and len(hashes) and node not in seen:
                    seen.add(node)
                    keys.append(found)
                    owners.append(node)
            kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
            spread = [int(n % 65_536) for n in nodes]
            rows = [spread, [None] * len(nodes), batch.column(0).to_pylist(), sizes, nodes, sketches, *map(list, zip(*least))]
            if keys:
                owner = np.repeat(np.array(owners, np.int64), [len(k) for k in keys])
                key = np.concatenate(keys)
                bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, low, owner = bucket[order], key[order].astype(np.uint32), owner[order]
                starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]):
                    rows[0].append(int(bucket[start]))
                    rows[1].append(low[start:stop].tobytes() + owner[start:stop].tobytes())
                extra = [None] * len(starts)
                for column in rows[2:]:
                    column += extra
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(rows, kinds)], ["bucket", "keys", "id", "n_shingles", "node", "sketch", "least_0", "least_1"]
            )

    return emit


JOINED = "kind string, id long, n_shingles int, node long, sketch binary, least_0 int, least_1 int, key long, n int"


def _join_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket in; documents as they are, and every key of two or more sets with each of them, out."""
    names = [name.split()[0] for name in JOINED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]

    def batch_of(rows: int, **values) -> pa.RecordBatch:
        arrays = [pa.array(values[n], k) if n in values else pa.nulls(rows, k) for n, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def joined(bucket: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([np.frombuffer(b, np.uint32, len(b) // 12) for b in held])
        nodes = np.concatenate([np.frombuffer(b, np.int64, len(b) // 12, 4 * (len(b) // 12)) for b in held])
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        keep = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
        keys, nodes = keys[keep], nodes[keep]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(starts, len(keys)))
        each = np.repeat(counts, counts)
        several = each >= 2
        for at in range(0, int(several.sum()), 100_000):
            part = slice(at, at + 100_000)
            key = (np.int64(bucket) << np.int64(32)) | keys[several][part].astype(np.int64)
            yield batch_of(len(key), kind=["key"] * len(key), node=nodes[several][part], key=key, n=each[several][part].astype(np.int32))

    bucket, held = None, []
    for batch in batches:
        rows = batch.to_pydict()
        docs = [k for k, blob in enumerate(rows["keys"]) if blob is None]
        if docs:
            columns = {n: [rows[n][k] for k in docs] for n in ("id", "n_shingles", "node", "sketch", "least_0", "least_1")}
            yield batch_of(len(docs), kind=["document"] * len(docs), **columns)
        for at, blob in zip(rows["bucket"], rows["keys"]):
            if blob is None:
                continue
            if at != bucket and held:
                yield from joined(bucket, held)
                held = []
            bucket = at
            held.append(blob)
    if held:
        yield from joined(bucket, held)


def sketch(hashes: np.ndarray) -> bytes:
    """The parity of the number of hashes with each ending, a bit for each of four to eight endings a hash."""
    bits = max(6, min(24, (4 * len(hashes)).bit_length()))
    counts = np.bincount((hashes & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(sketches: np.ndarray, size: int) -> np.ndarray:
    """Rows of sketches with endings one bit shorter until they have ``size`` bytes, as 64-bit words."""
    while sketches.shape[1] > size:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return np.ascontiguousarray(sketches).view(np.uint64)


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of hashes that only one of two sets has: each changes one parity."""
    x, y = (_folded(np.frombuffer(s, np.uint8)[None, :], min(len(a), len(b))) for s in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


def _may_link(percent: int):
    """Pairs with sizes and sketches in; those that the sketches do not rule out, out."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [batch.column(k).to_pylist() for k in range(2, 6)]
            near = [least_difference(x, y) <= _most_different(m, n, percent) for m, n, x, y in zip(*rows)]
            kept = batch.filter(pa.array(near, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return keep


def _compare_texts(percent: int):
    """Rows sorted by (leader, part), the leader's own text first: whether each other text links with it."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, None
        for batch in small(batches):
            rows = [[], [], []]
            for leader, part, node, text in zip(*(batch.column(k).to_pylist() for k in range(3)), blobs(batch.column(3))):
                hashes = shingle_set(text or b"")
                if (leader, part) != current:
                    if node != leader:
                        raise ValueError("a group without its leader's text")
                    current, own = (leader, part), hashes
                if node == leader:
                    linked = False
                else:
                    shared = len(np.intersect1d(own, hashes, assume_unique=True))
                    linked = 100 * shared >= percent * (len(own) + len(hashes) - shared)
                for column, value in zip(rows, (leader, node, linked)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], ["a", "b", "linked"])

    return compare


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``, ``linked`` for every pair (and, not linked, each ``a`` with itself).

    A text travels once for each of its pairs.  A leader with many partners is dealt to several parts.
    """
    part = (F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / GROUP_PART).cast("long"))).cast("int")
    dealt = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")), "a").select("a", part.alias("part"), "b")
    both = dealt.union(dealt.select("a", "part", F.col("a").alias("b")).distinct())
    sent = both.join(texts, F.col("b") == F.col("node")).select("a", "part", "b", (F.col("a") != F.col("b")).alias("other"), "text")
    return (
        sent.repartition("a", "part")
        .sortWithinPartitions("a", "part", "other")
        .select("a", "part", "b", "text")
        .mapInArrow(_compare_texts(percent), "a long, b long, linked boolean")
    )


def _near_rows(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Places (row of x, row of y) where the sketches, folded to one length, differ by at most ``most``."""
    size = min(x.shape[1], y.shape[1])
    x, y = _folded(x, size), _folded(y, size)
    found = []
    for k in range(len(x)):
        near = np.flatnonzero(np.bitwise_count(y ^ x[k]).sum(axis=1, dtype=np.int64) <= most[k])
        found.append(np.stack([np.full(len(near), k), near], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _pairs_in_block(rows: dict[str, list], same: bool, percent: int) -> np.ndarray:
    """Pairs (smaller, larger) of a block, or between its two sides, that may link and are in different components."""
    node, component, n = (np.array(rows[k], np.int64) for k in ("node", "component", "n"))
    side = np.array(rows["left_side"], bool)
    length = np.array([len(s) for s in rows["sketch"]])
    found = [np.zeros((0, 2), np.int64)]
    for low in np.unique(length).tolist():
        # Partners' sizes are within a factor of two, so are the lengths of their sketches.
        for high in (low, 2 * low):
            for one, other in ((low, high), (high, low)) if high > low else ((low, low),):
                left = np.flatnonzero((length == one) & side)
                right = np.flatnonzero((length == other) & (side if same else ~side))
                if not len(left) or not len(right):
                    continue
                x, y = (np.frombuffer(b"".join(rows["sketch"][k] for k in at), np.uint8).reshape(len(at), -1) for at in (left, right))
                most = (100 - percent) * (n[left][:, None] + n[right][None, :]) // (100 + percent)
                open_ = (component[left][:, None] != component[right][None, :]) & (np.abs(n[left][:, None] - n[right][None, :]) <= most)
                near = _near_rows(x, y, np.where(open_, most, -1))
                found.append(np.stack([node[left[near[:, 0]]], node[right[near[:, 1]]]], 1))
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def _pairs_in_blocks(percent: int):
    """Rows sorted by (leader, left, right) in; the pairs of each block out."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                pairs = _pairs_in_block(held, current[1] == current[2], percent)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            rows = batch.to_pydict()
            for k in range(batch.num_rows):
                at = rows["leader"][k], rows["left"][k], rows["right"][k]
                if at != current:
                    yield from flush()
                    current, held = at, {name: [] for name in ("node", "component", "n", "sketch", "left_side")}
                for name, values in held.items():
                    values.append(rows[name][k])
        yield from flush()

    return pair


def _remaining_pairs(keys: DataFrame, components: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets with a common key that are in different components and may still link.

    Near copies have nearly all keys in common, so keys whose smallest member is one set (their leader) are taken
    together: all members of any of them are compared once.  They are numbered by hash into blocks of about
    ``GROUP_PART``; two blocks, or one with itself, are compared in a task, so a large group is spread.
    Only pairs that pass are rows.
    """
    placed = keys.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("leader"), F.count("*").alias("size"))
        .where("low <> high and size > 2")
        .select("key", "leader")
    )
    members = placed.join(open_keys, "key").select("leader", "node", "component").distinct()
    blocks = members.groupBy("leader").agg(F.ceil(F.count("*") / GROUP_PART).cast("int").alias("blocks"))
    left = members.join(blocks, "leader").join(nodes.select("node", "n", "sketch"), "node")
    left = left.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    moved = ["leader", "block", "node", "component", "n", "sketch"]
    as_left = left.select(*moved, F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("other"))
    as_right = left.select(*moved, F.explode(F.sequence(F.lit(0), F.col("block"))).alias("other")).where("other < block")
    sides = [
        side.select("leader", F.col(low).alias("left"), F.col(high).alias("right"), *moved[2:], F.lit(is_left).alias("left_side"))
        for side, low, high, is_left in ((as_left, "block", "other", True), (as_right, "other", "block", False))
    ]
    return (
        sides[0]
        .union(sides[1])
        .repartition("leader", "left", "right")
        .sortWithinPartitions("leader", "left", "right")
        .mapInArrow(_pairs_in_blocks(percent), "a long, b long")
        .distinct()
    )


def _rarest_keys(keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each set's keys without those it may drop: the most frequent ones, one fewer than any partner shares."""
    bit = F.col("key").bitwiseAND(1)
    within = Window.partitionBy("node", "bit").orderBy("n", "key")
    least = F.when(F.col("bit") == 1, F.col("least_1")).otherwise(F.col("least_0"))
    return (
        keys.join(nodes.select("node", "least_0", "least_1"), "node")
        .withColumn("bit", bit)
        .withColumn("place", F.row_number().over(within))
        .withColumn("held", F.count("*").over(Window.partitionBy("node", "bit")))
        .where(F.col("place") <= F.col("held") - least + 1)
        .select("key", "node")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False
) -> DataFrame:
    """Components of documents whose sets of word shingles have a Jaccard similarity of ``percent`` or more.

    Returns for each row ``id_col``, ``n_shingles``, ``component_id`` (the smallest id reachable by links, its own
    included) and ``class_id`` (the smallest id with the very same set); with ``count_links`` also ``n_links``, the
    number of other classes that link with its own, of all links there are.  A NULL text or one without
    words has an empty set and no link, its component is itself.  A NULL id takes no part: its component
    is NULL.  Repeated rows give repeated results; an empty table gives an empty one; other columns are not
    looked at.  Sets are told apart by 64-bit digests, links are decided on the texts.

    Hot keys: equal sets count once, a key's members are first compared with one of them only, and large groups are dealt
    to several tasks.  Only texts of candidates travel.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    keyed = source.mapInArrow(
        _key_blobs(percent, buckets),
        "bucket int, keys binary, id long, n_shingles int, node long, sketch binary, least_0 int, least_1 int",
    )
    joined = written(
        keyed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_join_buckets, JOINED), "shingles"
    )
    sets = joined.where("kind = 'document'").select("id", "n_shingles", "node")
    shared = joined.where("kind = 'key'").select("key", "node", "n")
    nodes = (
        joined.where("kind = 'document' and id is not null")
        .join(shared.select("node").distinct(), "node", "left_semi")
        .groupBy("node")
        .agg(
            F.min("id").alias("id"),
            F.max("n_shingles").alias("n"),
            F.max("sketch").alias("sketch"),
            F.max("least_0").alias("least_0"),
            F.max("least_1").alias("least_1"),
        )
    )
    nodes = written(nodes, "nodes")
    keys = written(_rarest_keys(shared, nodes), "keys")

    first = keys.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("members")).where("members > 1")
    pairs = keys.join(first, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    of = {x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab"}
    near = written(
        pairs.join(of["a"], "a")
        .join(of["b"], "b")
        .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        .mapInArrow(_may_link(percent), "a long, b long"),
        "near",
    )
    linked = _verified(near, _texts(source, nodes, near), percent).where("linked").select("a", "b")
    linked = written(linked, "linked")
    components = connected_components(linked)
    more = _remaining_pairs(keys, components, nodes, percent)
    more = written(more.join(near, ["a", "b"], "left_anti"), "remaining")
    if not more.isEmpty():
        again = _verified(more, _texts(source, nodes, more), percent).where("linked").select("a", "b")
        components = connected_components(linked.union(again))

    placed = sets.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = (F.col("id").isNotNull()) & (F.col("n_shingles") > 0)
    lowest = placed.where(known).groupBy("component").agg(F.min("id").alias("component_id"))
    classes = placed.where(known).groupBy("node").agg(F.min("id").alias("class_id"), F.first("component").alias("component"))
    named = classes.join(lowest, "component").select("node", "class_id", "component_id")
    own = F.when(known, F.col("component_id")).otherwise(F.col("id"))
    columns = [
        F.col("id").alias(id_col),
        F.col("n_shingles").cast("long").alias("n_shingles"),
        own.alias("component_id"),
        F.when(known, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
    ]
    if count_links:
        components = written(components.select("node", "component"), "components")
        texts = _texts_of(source, nodes, components.select("node"))
        counted = links_of_components(components, texts, percent).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
        named = named.join(counted, "node", "left")
        columns.append(F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"))
    return sets.join(named, "node", "left").select(*columns)


def near_links(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every link between different sets, once, by their classes: ``left_id`` < ``right_id`` (smallest ids) and ``shared`` shingles.

    With ``class_id`` of ``near_duplicates`` as membership these are all links of ``docs``: copies are not expanded.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = written(near_duplicates(docs, percent, id_col, text_col), "near")
    classes = found.where(F.col(id_col).isNotNull() & (F.col("n_shingles") > 0)).select(F.col("class_id").alias("node"), F.col("component_id").alias("component")).distinct()
    several = classes.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    members = written(classes.join(several.select("component"), "component", "left_semi"), "members")
    # Of an id that repeats with other texts the row that is its class's is not told apart: ids have to be unique.
    texts = source.join(members.select(F.col("node").alias("id")), "id", "left_semi").select(F.col("id").alias("node"), "text")
    return links_of_components(members, texts, percent, as_pairs=True).select(
        F.col("a").alias("left_id"), F.col("b").alias("right_id"), F.col("n").alias("shared")
    )


def _shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of each set on the left with each on the right.

    Only hashes that both sides have count.  They are the columns of two matrices of zeros and ones, multiplied some
    columns at a time.
    """
    found = np.zeros((len(left), len(right)), np.int64)
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    for start in range(0, len(both), 4_096):
        columns = both[start : start + 4_096]
        sides = []
        for sets in (left, right):
            matrix = np.zeros((len(sets), len(columns)), np.float32)
            for row, hashes in enumerate(sets):
                low, high = np.searchsorted(hashes, columns[0]), np.searchsorted(hashes, columns[-1], "right")
                places = np.searchsorted(columns, hashes[low:high])
                here = columns[np.minimum(places, len(columns) - 1)] == hashes[low:high]
                matrix[row, places[here]] = 1
            sides.append(matrix)
        found += (sides[0] @ sides[1].T).astype(np.int64)  # counts up to 4,096 are exact in 32 bits
    return found


def _links_in_blocks(percent: int, as_pairs: bool):
    """Rows sorted by (component, left, right) in; the links of each block out, as pairs or counted by set."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, ([], [])

        def flush() -> Iterator[pa.RecordBatch]:
            same = current is not None and current[1] == current[2]
            left, right = held[0], held[0] if same else held[1]
            if not left or not right:
                return
            shared = _shared_shingles([h for _, h in left], [h for _, h in right])
            sizes = [np.array([len(h) for _, h in side], np.int64) for side in (left, right)]
            linked = 100 * shared >= percent * (sizes[0][:, None] + sizes[1][None, :] - shared)
            if same:
                np.fill_diagonal(linked, False)
            nodes = [np.array([node for node, _ in side], np.int64) for side in (left, right)]
            if as_pairs:
                rows, columns = np.nonzero(np.triu(linked) if same else linked)
                ends = np.sort(np.stack([nodes[0][rows], nodes[1][columns]], 1), axis=1)
                arrays = [pa.array(ends[:, 0]), pa.array(ends[:, 1]), pa.array(shared[rows, columns])]
            else:
                counted = [(nodes[0], linked.sum(axis=1))] + ([] if same else [(nodes[1], linked.sum(axis=0))])
                node, count = (np.concatenate(c) for c in zip(*counted))
                arrays = [pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "n"])

        for batch in small(batches):
            rows = zip(*(batch.column(k).to_pylist() for k in range(5)), blobs(batch.column(5)))
            for component, left, right, is_left, node, text in rows:
                if (component, left, right) != current:
                    yield from flush()
                    current, held = (component, left, right), ([], [])
                held[0 if is_left else 1].append((node, shingle_set(text or b"")))
        yield from flush()

    return link


def links_of_components(components: DataFrame, texts: DataFrame, percent: int, as_pairs: bool = False) -> DataFrame:
    """All links between sets of one component (node, component): ``a``, ``b`` and ``n`` shared shingles; or ``a`` and its number ``n``.

    Every link lies inside a component.  The members of a component are dealt by hash to blocks of about
    ``LINK_BLOCK``; a task compares two blocks, or one with itself, and emits counts, so neither a large component nor
    its pairs are in one place.  The text of a set travels once for each block that its own is compared with.
    """
    blocks = components.groupBy("component").agg(F.ceil(F.count("*") / LINK_BLOCK).cast("int").alias("blocks"))
    dealt = components.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    left = dealt.select("component", F.col("block").alias("left"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("right"), F.lit(True).alias("is_left"), "node")
    right = dealt.select("component", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("left"), F.col("block").alias("right"), F.lit(False).alias("is_left"), "node")
    sides = left.union(right.where("left < right")).join(texts, "node")
    return (
        sides.select("component", "left", "right", "is_left", "node", "text")
        .repartition("component", "left", "right")
        .sortWithinPartitions("component", "left", "right")
        .mapInArrow(_links_in_blocks(percent, as_pairs), "a long, b long, n long")
    )


def _texts(source: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node`` and ``text`` of every set in ``pairs``, written once."""
    return _texts_of(source, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())


def _texts_of(source: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    texts = source.join(nodes.join(wanted, "node", "left_semi").select("id", "node"), "id")
    # An id that repeats with other texts sends them all; one with the node's set is kept.
    return written(
        texts.select("node", "text").mapInArrow(_with_set, "node long, text string").dropDuplicates(["node"]), "texts"
    )


def _with_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (node, text) those whose text has the set that ``node`` stands for."""
    for batch in small(batches):
        keep = []
        for node, text in zip(batch.column(0).to_pylist(), blobs(batch.column(1))):
            digest = hashlib.blake2b(shingle_set(text or b"").tobytes(), digest_size=8).digest()
            keep.append(int.from_bytes(digest, "little", signed=True) == node)
        kept = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["node", "text"])

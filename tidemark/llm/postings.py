"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample, every vector is indexed.  A vector near the border of several
clusters is put into the lists of all of them, unless a chosen centroid is close to the next one.  Centroids are found by best-first search in an in-memory graph of their neighbours.  A query
opens the nearest lists, as many as the recall asks for: that is measured by brute force, at the table's size.  A list longer than its share is split
into parts by a hash, so copies of one vector, which no centroid can part, stay balanced too; parts are dealt
to buckets of about equal size, and a query goes to a bucket once, however many of its lists are there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import small, written

SAMPLE_ROWS = 20_000  # vectors the centroids are fitted on, at most
LARGEST_INDEX = SAMPLE_ROWS // 8  # centroids, at most, so that each is fitted on some vectors; lists are then longer, and split
LIST_ROWS = 200  # vectors a list should hold
GRAPH_DEGREE = 16
BEAM = 32
CALIBRATION_QUERIES = 256  # queries whose true neighbours tell how many lists to open
LEAST_BUCKETS = 32  # groups of lists that are compared together, and their rows where that makes more of them
BUCKET_ROWS = 65_536
RATIO_STEP, LARGEST_RATIO = 1e-6, 1e6
ROUNDING = 1e-9  # of a squared distance from a matrix product, far above its rounding


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, np.square(a).sum(1)[:, None] + np.square(b).sum(1)[None, :] - 2 * a @ b.T)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids that split ``sample`` into parts of nearly equal size, by halving the largest part.

    A part is halved at the median along the direction between the two means of a short 2-means run, so
    each half has as many vectors as the other; the centroids are then moved once to their own vectors.
    """
    rng = np.random.default_rng(7)
    parts = [np.arange(len(sample))]
    while len(parts) < min(lists, len(sample)):
        parts.sort(key=len)
        part = parts.pop()
        vectors = sample[part]
        two = vectors[rng.choice(len(part), 2, replace=False)]
        for _ in range(rounds):
            near = np.argmin(_squared(vectors, two), axis=1)
            if 0 < near.sum() < len(near):
                two = np.array([vectors[near == 0].mean(0), vectors[near == 1].mean(0)])
        order = np.argsort(vectors @ (two[1] - two[0]), kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    centroids = np.array([sample[part].mean(0) for part in parts])
    near = np.concatenate([np.argmin(_squared(sample[at : at + 2048], centroids), axis=1) for at in range(0, len(sample), 2048)])
    sums = np.zeros_like(centroids)
    np.add.at(sums, near, sample)
    counts = np.bincount(near, minlength=len(centroids))[:, None]
    return np.where(counts > 0, sums / np.maximum(counts, 1), centroids)


@dataclass(frozen=True)
class CentroidGraph:
    """Centroids, for each its nearest ones and a few random ones, and where a search starts."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray) -> CentroidGraph:
        n = len(centroids)
        rng = np.random.default_rng(11)
        near = min(GRAPH_DEGREE, n - 1)
        links = np.empty((n, near + 4), np.int32)
        for at in range(0, n, 1024):
            distances = _squared(centroids[at : at + 1024], centroids)
            distances[np.arange(len(distances)), np.arange(at, at + len(distances))] = np.inf
            links[at : at + 1024, :near] = np.argsort(distances, axis=1)[:, :near]
        links[:, near:] = rng.integers(0, n, (n, 4))  # far links let a search cross the graph
        return cls(centroids, links, rng.permutation(n)[: min(n, BEAM)].astype(np.int32))

    def search(self, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest centroids found for each vector, nearest first, and squared distances.

        All vectors are searched at once: each expands the best centroid of its beam that it has not
        expanded yet, until there is none.
        """
        n, beam = len(vectors), min(len(self.centroids), max(BEAM, 2 * k))
        norms = np.square(self.centroids).sum(1)
        own = np.square(vectors).sum(1)

        def distances(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
            dots = np.einsum("rd,rkd->rk", vectors[rows], self.centroids[ids])
            return np.maximum(0, own[rows, None] + norms[ids] - 2 * dots)

        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        found = distances(np.arange(n), ids)
        expanded = np.zeros_like(ids, dtype=bool)
        active = np.arange(n)
        while len(active):
            open_ = np.where(expanded[active], np.inf, found[active])
            pick = np.argmin(open_, axis=1)
            going = np.isfinite(open_[np.arange(len(active)), pick])
            active, pick = active[going], pick[going]
            if not len(active):
                break
            expanded[active, pick] = True
            new = self.links[ids[active, pick]]
            new_found = distances(active, new)
            seen = (new[:, :, None] == ids[active][:, None, :]).any(2)
            first = np.ones_like(seen)
            order = np.argsort(new, axis=1, kind="stable")
            ranked = np.take_along_axis(new, order, 1)
            np.put_along_axis(first, order[:, 1:], ranked[:, 1:] != ranked[:, :-1], 1)
            new_found[seen | ~first] = np.inf
            all_ids = np.hstack([ids[active], new])
            all_found = np.hstack([found[active], new_found])
            all_expanded = np.hstack([expanded[active], ~np.isfinite(new_found)])
            width = min(beam, all_ids.shape[1])
            keep = np.argsort(all_found, axis=1, kind="stable")[:, :width]
            if ids.shape[1] < width:
                grow = width - ids.shape[1]
                ids = np.hstack([ids, np.zeros((n, grow), ids.dtype)])
                found = np.hstack([found, np.full((n, grow), np.inf)])
                expanded = np.hstack([expanded, np.ones((n, grow), bool)])
            ids[active] = np.take_along_axis(all_ids, keep, 1)
            found[active] = np.take_along_axis(all_found, keep, 1)
            expanded[active] = np.take_along_axis(all_expanded, keep, 1)
        order = np.argsort(found, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(found, order, 1)


    def within(self, vectors: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroids within ``ratio`` of the nearest one's distance: rows of ``vectors``, centroids, squared distances.

        From the nearest centroid found, neighbours in the graph are followed as long as they are within the limit;
        each distance is computed once.
        """
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(0, len(vectors), 64):
            part = vectors[start : start + 64]
            norms = np.square(part).sum(1)
            nearest, least = self.search(part, 1)
            limit = least[:, 0] * ratio * ratio
            seen = np.zeros((len(part), len(self.centroids)), bool)
            rows, ids = np.arange(len(part)), nearest[:, 0]
            seen[rows, ids] = True
            distance = least[:, 0]
            while len(rows):
                found.append((rows + start, ids, distance))
                rows = np.repeat(rows, self.links.shape[1])
                ids = self.links[ids].ravel()
                new = ~seen[rows, ids]
                pairs = np.unique(rows[new].astype(np.int64) * len(self.centroids) + ids[new])
                rows, ids = pairs // len(self.centroids), pairs % len(self.centroids)
                seen[rows, ids] = True
                dots = np.einsum("rd,rd->r", part[rows], self.centroids[ids])
                distance = np.maximum(0, norms[rows] + self._norms[ids] - 2 * dots)
                near = distance <= limit[rows]
                rows, ids, distance = rows[near], ids[near], distance[near]
        rows, ids, distance = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((ids, distance, rows))
        return rows[order], ids[order], distance[order]

    @property
    def _norms(self) -> np.ndarray:
        return np.square(self.centroids).sum(1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part; the others are no one's neighbour."""
    vector = df[vector_col].cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return df.select(df[id_col].cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & (F.size("vector") > 0) & sound & F.exists("vector", lambda x: x != 0)
    )


def _assign(graph: CentroidGraph, replicas: int, widen: float, spread: float):
    """Lists of every vector: the nearest and, for one near a border, those almost as near."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, found = graph.search(_matrix(part.column(1)), replicas)
                chosen = found <= (1 + widen) ** 2 * found[:, :1]
                for k in range(1, ids.shape[1]):  # skip a centroid close to a chosen one
                    for j in range(k):
                        between = np.square(graph.centroids[ids[:, k]] - graph.centroids[ids[:, j]]).sum(1)
                        chosen[:, k] &= ~(chosen[:, j] & (between < spread * spread * found[:, k]))
                chosen[:, 0] = True
                rows, places = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows, places].astype(np.int32)), pa.array(places == 0), *(part.column(c).take(pa.array(rows)) for c in (0, 1))],
                    ["list", "own", "id", "vector"],
                )

    return assign


def _ratios(centroids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each vector how many times as far each centroid is as its nearest one, in units of ``RATIO_STEP``, rounded up."""
    distances = np.sqrt(_squared(vectors, centroids))
    nearest = np.maximum(distances.min(axis=1, keepdims=True), 1e-300)
    return np.ceil(np.minimum(distances / nearest, LARGEST_RATIO) / RATIO_STEP).astype(np.int64)


def _first_distinct(distance: np.ndarray, ids: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` nearest distinct ids; of an id the nearest row, then the smallest place, counts."""
    by_id = np.lexsort((places, distance, ids))
    _, first = np.unique(ids[by_id], return_index=True)
    rows = by_id[first]
    return rows[np.lexsort((ids[rows], distance[rows]))][:k]


def _exact_places(asked_ids: np.ndarray, asked: np.ndarray, places: np.ndarray, k: int):
    """The ``k`` nearest of all rows of a task for each asked vector, and the ratio that opens their list."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        limit = np.full(len(asked), np.inf)
        for batch in small(batches, 2_048):
            lists, ids, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            slack = ROUNDING * (np.square(asked).sum(1)[:, None] + np.square(vectors).sum(1)[None, :])
            near = (_squared(asked, vectors) <= np.square(limit)[:, None] + slack) & (ids[None, :] != asked_ids[:, None])
            for row in np.flatnonzero(near.any(axis=1)):
                at = np.flatnonzero(near[row])
                found = np.sqrt(np.square(vectors[at] - asked[row]).sum(axis=1)), ids[at], places[row][lists[at]]
                held = tuple(map(np.concatenate, zip(best[row], found)))
                keep = _first_distinct(*held, k)
                best[row] = tuple(column[keep] for column in held)
                if len(keep) == k:
                    limit[row] = best[row][0][-1]
        rows = np.repeat(np.arange(len(asked)), [len(b[0]) for b in best])
        score, ids, place = map(np.concatenate, zip(*best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(ids), pa.array(score), pa.array(place.astype(np.int64))],
            ["asked", "vec_id", "score", "place"],
        )

    return nearest


def _ratio_for_recall(postings: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int, recall: float) -> float:
    """Within which ratio of the nearest centroid's distance lie the lists of the share ``recall`` of the true neighbours.

    The true neighbours of some of the queries are those among all rows of the index, so the ratio follows from its
    size and data.
    """
    distinct = queries.groupBy("vector").agg(F.min("id").alias("id"))
    asked = distinct.orderBy(F.xxhash64("vector"), "id").limit(CALIBRATION_QUERIES).toPandas()
    if recall >= 1 or asked.empty:
        return np.inf
    vectors = np.array(asked["vector"].tolist(), float)
    found = postings.select("list", "id", "vector").mapInArrow(
        _exact_places(asked["id"].to_numpy(), vectors, _ratios(centroids, vectors), k), "asked int, vec_id long, score double, place long"
    )
    once = found.groupBy("asked", "vec_id").agg(F.min(F.struct("score", "place")).alias("best"))
    order = Window.partitionBy("asked").orderBy("best.score", "vec_id")
    true = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("best.place").toPandas()["place"]
    if true.empty:
        return np.inf
    largest = int(np.sort(true.to_numpy())[int(np.ceil(recall * len(true))) - 1]) * RATIO_STEP
    return np.inf if largest >= LARGEST_RATIO else largest


def _opened(graph: CentroidGraph, own: np.ndarray, vectors: np.ndarray, ratio: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``vectors`` and the lists they open: those within ``ratio``, and more where these have at most ``k`` rows of their own."""
    found, waiting, limit = [], np.arange(len(vectors)), ratio
    while len(waiting):
        if np.isfinite(limit):
            rows, ids, _ = graph.within(vectors[waiting], limit)
        else:
            rows, ids = (m.ravel() for m in np.indices((len(waiting), len(graph.centroids))))
        held = np.bincount(rows, weights=own[ids], minlength=len(waiting))
        enough = (held > k) if np.isfinite(limit) else np.ones(len(waiting), bool)
        kept = enough[rows]
        found.append((waiting[rows[kept]], ids[kept]))
        waiting = waiting[~enough]
        limit = 1.5 * limit if limit < 100 else np.inf
    rows, ids = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    order = np.lexsort((ids, rows))
    return rows[order], ids[order]


def _buckets(sizes: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A bucket for each part of each list (those of a list are neighbours), with about as many rows in each."""
    rows = np.repeat(sizes / parts, parts)
    held = [(0.0, bucket) for bucket in range(min(len(rows), max(LEAST_BUCKETS, int(sizes.sum()) // BUCKET_ROWS)))]
    bucket_of = np.zeros(len(rows), np.int32)
    for unit in np.argsort(-rows, kind="stable").tolist():
        filled, bucket_of[unit] = held[0]
        heapq.heapreplace(held, (filled + rows[unit], held[0][1]))
    return bucket_of


def _compare_in_buckets(lists: int, k: int):
    """Rows sorted by bucket, those of the index before those asked; of each asked one the ``k`` nearest of its lists."""

    def nearest(asked: dict[str, list], at: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        a = np.array(asked["vector"])
        opened = np.zeros((len(a), lists), bool)
        for row, some in enumerate(asked["lists"]):
            opened[row, some] = True
        rough = _squared(a, vectors)
        rough[~opened[:, at] | (np.array(asked["id"])[:, None] == ids[None, :])] = np.inf
        slack = ROUNDING * (np.square(a).sum(1) + np.square(vectors).sum(1).max())
        columns = [[], [], []]
        for row, query_id in enumerate(asked["id"]):
            open_, most = int(np.isfinite(rough[row]).sum()), 4 * k
            while True:  # copies and repeated ids may fill the first places
                limit = np.partition(rough[row], most - 1)[most - 1] if most < open_ else np.finfo(float).max
                near = np.flatnonzero(rough[row] <= limit + slack[row])
                if most >= open_ or len(np.unique(ids[near])) >= k:
                    break
                most *= 4
            distance = np.sqrt(np.square(vectors[near] - a[row]).sum(axis=1))
            keep = _first_distinct(distance, ids[near], at[near], k)
            for column, values in zip(columns, (np.full(len(keep), query_id, np.int64), ids[near][keep], distance[keep])):
                column.append(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["query_id", "vec_id", "score"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index = None, [], None
        for batch in small(batches, 64):
            buckets, is_asked = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            ends = np.flatnonzero((buckets[1:] != buckets[:-1]) | (is_asked[1:] != is_asked[:-1])) + 1
            for start, stop in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows]):
                part = batch.slice(start, stop - start)
                if buckets[start] != current:
                    current, held, index = buckets[start], [], None
                if not is_asked[start]:
                    held.append((part.column(2).to_numpy(), part.column(4).to_numpy(), _matrix(part.column(5))))
                    continue
                if index is None:
                    index, held = tuple(map(np.concatenate, zip(*held))) if held else (), []
                if index:
                    yield from nearest({n: part.column(c).to_pylist() for n, c in (("lists", 3), ("id", 4), ("vector", 5))}, *index)

    return compare


def nearest_neighbours(
    vectors: DataFrame,
    query_filter,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    replicas: int = 4,
    widen: float = 0.1,
    spread: float = 0.5,
    recall: float = 0.99,
) -> DataFrame:
    """The ``k`` nearest rows found for each row of ``vectors`` that ``query_filter`` (on the id) takes.

    Returns query_id, rank (from 1), vec_id and score, the Euclidean distance in double precision; ties go to
    the smaller id.  A vector goes to at most ``replicas`` lists within ``1 + widen`` of its nearest centroid's
    distance, none of them nearer to another than ``spread`` times the vector's distance.  A query opens the lists whose
    centroids are within a ratio of its nearest one's distance: the ratio that finds the share ``recall`` of the true
    neighbours, as measured by brute force over the whole table for ``CALIBRATION_QUERIES`` of the queries, and more
    until their own rows outnumber ``k``; with ``recall`` 1 all lists, which is exact.  If all rows are fewer than ``k``, all are
    found.  Vectors that are NULL, empty, zero, or hold NULL, NaN or an infinity take no part, nor do NULL
    ids; all others need one length.  Of repeated ids the nearest vector counts once.  An empty table
    gives an empty one; other columns are not looked at.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, id_col, vector_col)
    rows = usable.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not rows:
        return spark.createDataFrame([], schema)
    # By hash, so the sample is the same in every run, and about its size leaves the tasks.
    share = min(1.0, 1.1 * SAMPLE_ROWS / rows)
    drawn = usable.where(F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 31)) < int(share * (1 << 31)))
    sample = drawn.orderBy(F.xxhash64("id", "vector")).limit(SAMPLE_ROWS).toPandas()["vector"]
    sample = np.array(sample.tolist(), float)
    if not len(sample):  # copies of one vector under one id may all be left out
        sample = np.array([usable.first()["vector"]])
    lists = max(1, min(LARGEST_INDEX, rows // LIST_ROWS, len(sample) // 8))
    graph = CentroidGraph.build(balanced_centroids(sample, lists))
    postings = written(
        usable.mapInArrow(_assign(graph, replicas, widen, spread), "list int, own boolean, id long, vector array<double>"), "postings"
    )
    # One row a list: at most LARGEST_INDEX.
    sizes = np.zeros((2, len(graph.centroids)), np.int64)
    for row in postings.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.col("own").cast("int")).alias("own")).collect():
        sizes[:, row["list"]] = row["n"], row["own"]
    share = 4 * LIST_ROWS * max(1, rows // (LIST_ROWS * len(graph.centroids)))
    parts = np.maximum(1, -(-sizes[0] // share)).astype(np.int32)

    queries = usable.where(query_filter(F.col("id")))
    ratio = _ratio_for_recall(postings, queries, graph.centroids, k, recall)
    bucket_of = _buckets(sizes[0], parts)
    first_part = np.concatenate([[0], np.cumsum(parts)[:-1]])
    buckets, lists = int(bucket_of.max()) + 1, len(graph.centroids)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows_, chosen = _opened(graph, sizes[1], _matrix(batch.column(1)), ratio, k)
            counts = parts[chosen]
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            bucket = bucket_of[np.repeat(first_part[chosen], counts) + within]
            # One row for each bucket of a query, with those of its lists that are there.
            key = np.unique((np.repeat(rows_, counts) * buckets + bucket) * lists + np.repeat(chosen, counts))
            place, starts = np.unique(key // lists, return_index=True)
            here = pa.ListArray.from_arrays(pa.array(np.append(starts, len(key)).astype(np.int32)), pa.array((key % lists).astype(np.int32)))
            of = pa.array(place // buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array((place % buckets).astype(np.int32)), here, *(batch.column(c).take(of) for c in (0, 1))],
                ["bucket", "lists", "id", "vector"],
            )

    def of_list(values: np.ndarray, place: Column) -> Column:
        return F.element_at(F.lit(values.tolist()).cast("array<int>"), place + 1)

    part = F.pmod(F.xxhash64("id", "vector"), of_list(parts, F.col("list"))).cast("int")
    stored = postings.select(
        of_list(bucket_of, of_list(first_part, F.col("list")) + part).alias("bucket"),
        F.lit(False).alias("asked"),
        "list",
        F.lit(None).cast("array<int>").alias("lists"),
        "id",
        "vector",
    )
    asked = queries.mapInArrow(probe, "bucket int, lists array<int>, id long, vector array<double>").select(
        "bucket", F.lit(True).alias("asked"), F.lit(None).cast("int").alias("list"), "lists", "id", "vector"
    )
    found = (
        stored.union(asked)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "asked")
        .mapInArrow(_compare_in_buckets(lists, k), "query_id long, vec_id long, score double")
    )
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )

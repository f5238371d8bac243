"""Whitening of embeddings by spectrum slicing.

The number of eigenvalues below a shift is the number of negative pivots of an LDLᵀ factorisation of
the shifted covariance (Sylvester's law of inertia).  Halving an interval by such counts isolates
each leading eigenvalue, Rayleigh quotient iteration then converges cubically to its vector, and counts on both
sides of the value certify its number.  Moments are added up by tasks; only tables whose size follows from the
number of dimensions come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import small, written

SCALE = 256.0
COMPONENTS = 4
# Eigenvalues within this share of the largest count as one when they are numbered; below the other, times the number
# of dimensions, they are rounding.
RESOLUTION, ZERO = 1e-13, 4e-15
_LONG = np.iinfo(np.int64)
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def inertia_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` are smaller than ``shift``.

    LDLᵀ with symmetric pivoting by blocks of one or two rows (Bunch and Kaufman), so that indefinite
    matrices with small diagonals are factorised stably.  A block of two has one negative pivot.
    """
    a = matrix - shift * np.eye(len(matrix))
    threshold, negative, k, n = (1 + np.sqrt(17)) / 8, 0, 0, len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1 :, k])
        largest = column.max(initial=0.0)
        diagonal, width = abs(a[k, k]), 1
        if diagonal < threshold * largest:
            r = k + 1 + int(column.argmax())
            others = np.abs(a[k:, r])
            others[r - k] = 0.0
            if diagonal * others.max() < threshold * largest**2:
                if abs(a[r, r]) >= threshold * others.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    width = 2
        if width == 1:
            pivot = a[k, k]
            negative += pivot < 0
            if pivot != 0:
                rest = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(rest, rest / pivot)
        else:
            block = a[k : k + 2, k : k + 2].copy()
            negative += 1
            rest = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        k += width
    return int(negative)


def _isolated(matrix: np.ndarray, number: int, low: float, high: float, resolution: float) -> tuple[float, float, bool]:
    """An interval that holds the ``number``-th smallest eigenvalue (from 0), and whether no other one is in it.

    Once no other one is, a few halvings more keep its middle much nearer to it than to the others.
    """
    below, above, more = 0, len(matrix), 8
    while high - low > resolution and more:
        more -= below == number and above == number + 1
        middle = (low + high) / 2
        if not low < middle < high:
            break
        count = inertia_below(matrix, middle)
        if count > number:
            high, above = middle, count
        else:
            low, below = middle, count
    return low, high, below == number and above == number + 1


def _refined(matrix: np.ndarray, low: float, high: float, earlier: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """The eigenpair of the interval by Rayleigh quotient iteration, orthogonal to the vectors found before.

    The first steps invert at the interval's middle, which draws the vector towards the pair that is asked for;
    once its quotient lies in the interval the shift follows the quotient.
    """
    n = len(matrix)
    rng = np.random.default_rng(seed)

    def cleaned(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - earlier @ (earlier.T @ v)
        return v / np.linalg.norm(v)

    vector, shift, best = cleaned(rng.standard_normal(n)), (low + high) / 2, None
    for _ in range(60):
        solved = None
        try:
            solved = np.linalg.solve(matrix - shift * np.eye(n), vector)
        except np.linalg.LinAlgError:
            pass
        if solved is None or not np.isfinite(solved).all():  # the shift is an eigenvalue to the last digit
            solved = np.linalg.solve(matrix - (shift + 4 * np.spacing(1.0)) * np.eye(n), vector)
        vector = cleaned(solved)
        quotient = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - quotient * vector))
        if best is not None and low <= best[1] <= high and residual >= best[0] / 2:
            break
        if best is None or residual < best[0] or not low <= best[1] <= high:
            best = (residual, quotient, vector)
        shift = quotient if low <= quotient <= high else (low + high) / 2
    return best[1], best[2]


def leading_eigenpairs(covariance: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric positive semidefinite matrix, falling, and unit eigenvectors as columns.

    Values that are zero to double precision are left out.  Each value's number is certified by counts below and above
    it; values too close to tell apart (within ``RESOLUTION`` of the largest) are certified together.
    """
    d = len(covariance)
    scale = float(np.abs(covariance).sum(axis=1).max(initial=0.0))
    if d == 0 or scale == 0 or not np.isfinite(scale):
        return np.zeros(0), np.zeros((d, 0))
    matrix = covariance / scale  # all eigenvalues are at most 1
    values, vectors = np.zeros(0), np.zeros((d, 0))
    for place in range(min(k, d)):
        number = d - 1 - place
        low, high, alone = _isolated(matrix, number, -RESOLUTION, 1 + RESOLUTION, RESOLUTION)
        value, vector = _refined(matrix, low, high, vectors, place)
        if value <= d * ZERO:
            break
        margin = max(d * RESOLUTION, 1e-9 * (high - low))
        at_most, below = inertia_below(matrix, value + margin), inertia_below(matrix, value - margin)
        if not below <= number < at_most:
            raise ArithmeticError(f"eigenvalue {place + 1} is not certified: {below} below, {d - at_most} above")
        if alone and at_most - below == 1 and not low - margin <= value <= high + margin:
            raise ArithmeticError(f"eigenvalue {place + 1} left its interval")
        vector = vector * np.sign(vector[np.abs(vector).argmax()])  # one sign in every run
        values, vectors = np.append(values, value), np.column_stack([vectors, vector])
    return values * scale, vectors


def _pack(x: np.ndarray) -> bytes:
    """A vector of longs in the narrowest width that holds it: equal vectors have equal bytes."""
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    for code, kind in enumerate(_WIDTHS):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return bytes([code]) + x.astype(kind).tobytes()
    raise AssertionError


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, _WIDTHS[data[0]], offset=1).astype(np.int64)


def _to_longs(vector: np.ndarray) -> np.ndarray:
    """floor(256 c) of each entry; beyond the range of a long its nearest end, as a cast in SQL does."""
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * vector)
    inside = (scaled >= -(2.0**63)) & (scaled < 2.0**63)
    return np.where(inside, np.where(inside, scaled, 0).astype(np.int64), np.where(scaled > 0, _LONG.max, _LONG.min))


def _matrix_of(packed: list[bytes]) -> np.ndarray:
    """Packed vectors as rows; one ``frombuffer`` where all have one width."""
    if len({(p[0], len(p)) for p in packed}) == 1:
        kind = np.dtype(_WIDTHS[packed[0][0]])
        joined = np.frombuffer(b"".join(p[1:] for p in packed), kind)
        return joined.reshape(len(packed), -1).astype(np.int64)
    rows = [_unpack(p) for p in packed]
    if len({len(r) for r in rows}) > 1:
        raise ValueError("vectors differ in length")
    return np.array(rows)


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 1_024):
        vectors = batch.column(1)
        packed = [_pack(_to_longs(np.array(v, np.float64))) for v in vectors.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "x"])


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``x`` (packed longs) of each row whose vector has entries, all of them finite."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"))
    return source.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & sound).mapInArrow(
        _quantised, "id long, x binary"
    )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task: how many vectors, and the sum of each dimension as two longs (high and low 32 bits)."""
    n, total = 0, None
    for batch in small(batches, 4_096):
        x = _matrix_of(batch.column(0).to_pylist())
        if total is not None and total.shape[1] != x.shape[1]:
            raise ValueError("vectors differ in length")
        halves = np.array([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
        n, total = n + len(x), halves if total is None else total + halves
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.shape[1], dtype=np.int32)), pa.array(np.full(total.shape[1], n)), pa.array(total[0]), pa.array(total[1])],
            ["place", "n", "high", "low"],
        )


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``x`` minus a mean whose whole part and rest come apart: far from zero no digit of a distance is lost."""
    if max(np.abs(x).max(initial=0), np.abs(whole).max(initial=0)) < 2**62:
        return (x - whole) - rest
    return x - (whole + rest)


def _products(whole: np.ndarray, rest: np.ndarray, directions: np.ndarray | None):
    """Of a task: the rows of the sum of outer products of centred vectors, or of their projections."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in small(batches, 4_096):
            x = _centred(_matrix_of(batch.column(0).to_pylist()), whole, rest)
            if directions is not None:
                x = np.column_stack([np.ones(len(x)), x @ directions])
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            places = np.arange(len(total), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(list(total), pa.list_(pa.float64()))], ["place", "products"])

    return add_up


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tables with one place added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in small(batches, 64):
        for place, products in zip(batch.column(0).to_pylist(), batch.column(1)):
            row = products.values.to_numpy()
            sums[place] = row if place not in sums else sums[place] + row
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["place", "products"]
        )


def _second_moment(fit: DataFrame, whole: np.ndarray, rest: np.ndarray, directions: np.ndarray | None = None) -> np.ndarray:
    schema = "place int, products array<double>"
    partial = fit.select("x").mapInArrow(_products(whole, rest, directions), schema)
    rows = partial.repartition("place").mapInArrow(_added, schema).orderBy("place").collect()
    return np.array([row["products"] for row in rows])


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Coordinates of every vector on the leading components of the quantised vectors, scaled to unit variance.

    Entry c counts as the long floor(256 c).  The mean S/n, the covariance V (divisor n) and its eigenpairs are those of
    the *distinct* quantised vectors.  Returns one row per row of ``vectors`` and component (from 1, by falling
    eigenvalue e): ``id_col``, ``component``, ``n``, ``deviation`` (the exact sum of (n x - S)²; NULL where that is
    no long), ``whitened`` ((x - S/n)·v/√e), ``explained`` (e / trace V), ``identity_error`` (of the measured covariance
    of ``whitened`` over the distinct vectors) and ``eigenvalue``.

    Rows whose vector is NULL, empty, or holds NULL, NaN or an infinity give no rows; a NULL id stays NULL; repeated
    rows give repeated results.  Components of eigenvalue zero (fewer distinct vectors or dimensions than
    components) have no whitened value and no rows, so equal vectors everywhere, or an empty table, give an empty result.
    Vectors of different lengths raise.  Entries beyond a long count as its nearest end.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    schema = (
        f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double, eigenvalue double"
    )
    rows = written(quantised(vectors, id_col, vector_col), "quantised")
    fit = written(rows.select("x").distinct(), "fit")
    sums = fit.mapInArrow(_sums, "place int, n long, high long, low long").groupBy("place").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")
    ).orderBy("place").collect()
    if not sums:
        return spark.createDataFrame([], schema)
    n = int(sums[0]["n"])
    if any(int(row["n"]) != n for row in sums):
        raise ValueError("vectors differ in length")
    total = [int(row["high"]) * 2**32 + int(row["low"]) for row in sums]
    whole = np.array([s // n for s in total], dtype=np.int64)
    rest = np.array([s % n / n for s in total])

    covariance = _second_moment(fit, whole, rest) / n
    covariance = (covariance + covariance.T) / 2
    values, directions = leading_eigenpairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    scaled = directions / np.sqrt(values)
    moments = _second_moment(fit, whole, rest, scaled) / n
    measured = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    identity_error = float(np.abs(measured - np.eye(len(values))).max())
    explained = values / np.trace(covariance)
    largest = max(map(abs, total))
    k = len(values)

    def deviations(x: np.ndarray) -> list[int | None]:
        most = n * max(abs(int(x.min())), abs(int(x.max()))) + largest
        if most < 2**62 and most * most * x.shape[1] < 2**63:
            return np.square(n * x - np.array(total, np.int64)).sum(axis=1).tolist()
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, total)) for row in x.tolist()]
        return [e if e < 2**63 else None for e in exact]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 4_096):
            x = _matrix_of(batch.column(1).to_pylist())
            if x.shape[1] != len(total):
                raise ValueError("vectors differ in length")
            found = _centred(x, whole, rest) @ scaled
            of = pa.array(np.repeat(np.arange(len(x)), k))

            def each(values_: np.ndarray) -> pa.Array:
                return pa.array(np.tile(values_, len(x)))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of),
                    each(np.arange(1, k + 1, dtype=np.int32)),
                    pa.array(np.full(len(of), n)),
                    pa.array(deviations(x), pa.int64()).take(of),
                    pa.array(found.ravel()),
                    each(explained),
                    pa.array(np.full(len(of), identity_error)),
                    each(values),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"],
            )

    found = rows.mapInArrow(
        project,
        "id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double",
    )
    return found.withColumnRenamed("id", id_col)

"""Whitening against plain linear algebra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import registry
from tidemark.llm.whitening import inertia_below, leading_eigenpairs, whiten

SF_DIR = "/root/testdata/sf0.01"


def covariances():
    rng = np.random.default_rng(5)
    for round_ in range(60):
        d, n = int(rng.integers(1, 40)), int(rng.integers(1, 120))
        x = np.floor(rng.standard_normal((n, d)) * rng.uniform(0.1, 300, size=d))
        x = np.round(x / 200) if round_ % 3 == 0 else x
        yield np.cov(x.T, bias=True).reshape(d, d)
    yield np.diag([1.0, 2, 2, 2, 2, 5])
    yield np.zeros((3, 3))
    yield np.array([[0.0, 1], [1, 0]]) + np.eye(2)


def test_counts_and_pairs_equal_a_full_decomposition():
    rng = np.random.default_rng(6)
    for v in covariances():
        values = np.linalg.eigvalsh(v)[::-1]
        for shift in rng.uniform(-1, values[0] + 1, 3):
            assert inertia_below(v, shift) == (values < shift).sum()
        found, vectors = leading_eigenpairs(v)
        k = len(found)
        assert k == min(4, len(v), int((values > 1e-11 * max(values[0], 1e-300)).sum()))
        assert np.allclose(found, values[:k], rtol=1e-10, atol=1e-10 * values[0])
        assert np.abs(v @ vectors - vectors * found).max(initial=0) <= 1e-10 * max(1, values[0])
        assert np.abs(vectors.T @ vectors - np.eye(k)).max(initial=0) < 1e-10


def check(rows, found):
    """``found`` against sums of Python integers and numpy's decomposition."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    longs = [tuple(int(np.floor(256 * c)) for c in v) for _, v in usable]
    fit = sorted(set(longs))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, int((values > 1e-11 * values[0]).sum()))
    expected = {}
    for (vec_id, _), x in zip(usable, longs):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for component in range(k):
            whitened = (np.array(x, float) - mean) @ vectors[:, component] / np.sqrt(values[component])
            expected.setdefault((vec_id, component + 1), []).append((n, deviation, abs(whitened), values[component] / np.trace(v)))
    got = {}
    for row in found:
        got.setdefault((row.vec_id, row.component), []).append((row.n, row.deviation, abs(row.whitened), row.explained))
        assert row.identity_error <= 1e-4
    assert got.keys() == expected.keys()
    for key, rows_ in expected.items():
        for a, b in zip(sorted(rows_), sorted(got[key])):
            assert a[:2] == b[:2] and np.allclose(a[2:], b[2:], rtol=1e-8, atol=1e-8)


def test_query_equals_a_full_decomposition(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check(rows, registry.op12_spectrum_whitening(spark, SF_DIR).collect())


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.0, 2.0]), (2, [0.5, 0.0, 2.0]), (3, None), (4, []), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]), (7, [None, 0.0, 0.0]),
        (None, [100.0, 1.0, -3.0]), (8, [0.001, 0.002, 0.003]), (8, [4.0, 5.0, 6.5]), (9, [4.0, 5.0, 6.5]), (10, [30.0, -50.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("id", "x", "n", "component", "place", "vector"):
        df = df.withColumn(name, F.lit("own"))
    check(rows, whiten(df).collect())


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_without_variance_there_are_no_components(spark, rows):
    assert whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_far_vectors_and_lengths_that_differ(spark):
    rows = [(1, [1e9, 0.5]), (2, [1e9 + 1, 0.25]), (3, [1e300, 0.0]), (4, [1e9, 1.0])]
    # As exact as the same vectors near zero: neither mean nor deviation loses a digit.
    schema = "vec_id long, embedding array<double>"
    near = whiten(spark.createDataFrame([(1, [0.0, 0.5]), (2, [1.0, 0.25]), (4, [0.0, 1.0])], schema)).collect()
    found = whiten(spark.createDataFrame(rows[:2] + rows[3:], schema)).collect()
    for a, b in zip(sorted(near), sorted(found)):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9, atol=1e-9)
    far = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in far} == {None} and {r.n for r in far} == {4}
    with pytest.raises(Exception, match="length"):
        whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()

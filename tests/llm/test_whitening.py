"""Spectrum slicing against a dense solver, whitening against a plain version."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tarnlake.llm.queries import op12_whitening
from tarnlake.llm.spectrum_slicing import above, leading
from tarnlake.llm.whitening import whitened_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
RANDOM = np.random.default_rng(3)


def covariance(n, d):
    x = RANDOM.standard_normal((n, d)) * np.arange(1, d + 1)
    return np.cov(x.T, bias=True).reshape(d, d)


@pytest.mark.parametrize("d", [1, 2, 5, 30, 64])
def test_counts_are_those_of_the_eigenvalues(d):
    matrix = covariance(3 * d + 2, d) - d * np.eye(d)
    values = np.linalg.eigvalsh(matrix)
    for shift in [*np.linspace(values[0] - 1, values[-1] + 1, 23), 0.0]:
        assert above(matrix, shift) == (values > shift).sum()


def test_counts_with_zero_diagonals():
    matrix = np.array([[0, 1, 0], [1, 0, 0], [0, 0, 0]], float)
    assert [above(matrix, s) for s in (-2, -0.5, 0.5, 2)] == [3, 2, 1, 0]


@pytest.mark.parametrize("d", [1, 3, 40, 64])
def test_leading_pairs(d):
    matrix = covariance(5 * d, d)
    values, vectors = leading(matrix, 8)
    expected = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    assert len(values) == min(8, d)
    assert np.allclose(values, expected, rtol=1e-12)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-12 * expected[0])
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-13)


@pytest.mark.parametrize(
    "matrix, expected",
    [
        (np.eye(5), [1] * 5),
        (np.zeros((4, 4)), []),
        (np.diag([3.0, 3, 3, 2, 2, 1e-30]), [3, 3, 3, 2, 2]),
        (np.ones((6, 6)), [6]),
        (np.diag([1, 1 + 1e-15, 1 + 1e-9, 0.5]), [1 + 1e-9, 1, 1, 0.5]),
        (np.zeros((0, 0)), []),
    ],
)
def test_repeated_and_missing_values(matrix, expected):
    values, vectors = leading(matrix, 8)
    assert np.allclose(values, expected, rtol=1e-13)
    assert np.allclose(vectors @ vectors.T, np.eye(len(expected)), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-13)


def plain(vectors):
    """n, eigenvalue shares, exact deviations and whitened values up to sign, of (id, vector)."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[float((n * c - s)) / n for c, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    return n, values / np.trace(cov), deviations, centred @ axes / np.sqrt(values)


def check(rows, vectors):
    n, shares, deviations, white = plain(vectors)
    assert len(rows) == n * len(shares)
    signs = {}
    expected = {}
    for (vec, _), deviation, w in zip(vectors, deviations, white, strict=True):
        expected.setdefault(vec, []).append((deviation, w))
    for row in rows:
        k = row["component"] - 1
        assert row["n"] == n and abs(row["identity_error"]) < 1e-6
        assert math.isclose(row["explained"], shares[k], rel_tol=1e-9)
        if row["whitened"] and len(expected[row["vec_id"]]) == 1:
            (deviation, w), = expected[row["vec_id"]]
            assert row["deviation"] == deviation
            assert math.isclose(abs(row["whitened"]), abs(w[k]), rel_tol=1e-7, abs_tol=1e-9)
            if abs(w[k]) > 1e-6:
                assert signs.setdefault(k, np.sign(row["whitened"] * w[k])) == np.sign(row["whitened"] * w[k])


def usable(rows, d):
    fits = lambda v: v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)
    return [(i, v) for i, v in rows if fits(v)]


def test_query_equals_plain_version(spark, corpus):
    table = pq.read_table(f"{corpus}/embeddings.parquet").to_pylist()
    check(op12_whitening(spark, corpus).collect(), usable([(r["vec_id"], r["embedding"]) for r in table], 64))


def test_odd_vectors(spark):
    kept = [(i, [float(x) for x in RANDOM.standard_normal(10)]) for i in range(40)]
    kept += [(50, [0.0] * 10), (51, kept[3][1]), (52, [1e3] * 10), (3, kept[3][1])]
    odd = [(60, None), (61, []), (62, [1.0]), (63, [float("nan")] * 10), (64, [None] + [1.0] * 9), (65, [float("inf")] * 10), (66, [1e30] * 10)]
    rows = [(i, v, None) for i, v in kept + odd] + [(None, [2.0] * 10, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("n", "component", "whitened", "task", "i", "mean")})
    found = whitened_vectors(frame.repartition(7)).collect()
    check(found, [*kept, (None, [2.0] * 10)])


def test_long_vectors_do_not_overflow(spark):
    rows = [(i, [float(x) * 1e12 for x in RANDOM.standard_normal(3)]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in whitened_vectors(vectors).collect()}
    assert len(found) == 30
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for i, row in enumerate(x):
        exact = sum((30 * c - s) ** 2 for c, s in zip(row, sums, strict=True))
        assert found[i]["deviation"] == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(5)], [(1, [], 1)]])
def test_nothing_to_whiten(spark, rows):
    found = whitened_vectors(spark.createDataFrame(rows, SCHEMA))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_components_than_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 0.5 * (i % 3)], 0) for i in range(9)]
    found = whitened_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1, 2}
    assert abs(sum(r["explained"] for r in found) / 9 - 1) < 1e-9

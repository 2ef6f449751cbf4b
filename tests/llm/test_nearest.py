"""Nearest vectors against brute force: recall, exact scores, order, odd rows."""

import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import dimension_scan
from tarnlake.llm.dimension_scan import fit, nearest_lists, nearest_vectors, scan
from tarnlake.llm.queries import op11_nearest

SCHEMA = "vec_id long, embedding array<float>, label int"
RANDOM = np.random.default_rng(11)


def plain(rows, every=20, nearest=20):
    """query to (vec_id, score), nearest first, of rows (vec_id, vector)."""
    ok = lambda v: v is not None and any(v) and all(c is not None and math.isfinite(c) for c in v)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if i is not None and ok(v)]
    asking = defaultdict(list)
    for i, v in rows:
        if i % every == 0:
            asking[i].append(v)
    result = {}
    for i, found in asking.items():
        q = min(found)
        scored = []
        for j, v in rows:
            if j != i and len(v) == len(q):
                total = 0.0
                for a, b in zip(q, v, strict=True):
                    total += a * b
                scored.append((-total, j))
        result[i] = [(j, -s) for s, j in sorted(scored)[:nearest]]
    return result


def told(df):
    result = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        result[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(result[r["query_id"]])
    return dict(result)


def recall(found, expected):
    hits = sum(len({j for j, _ in found.get(i, [])} & {j for j, _ in rows}) for i, rows in expected.items())
    return hits / max(1, sum(map(len, expected.values())))


def test_query_equals_brute_force(spark, corpus):
    """Fewer rows than two lists hold: every list is probed, and the test alone may err."""
    table = pq.read_table(f"{corpus}/embeddings.parquet").to_pylist()
    expected = {i: rows for i, rows in plain([(r["vec_id"], r["embedding"]) for r in table]).items() if rows}
    assert told(op11_nearest(spark, corpus)) == expected


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(dimension_scan, "LIST_ROWS", 64)
    monkeypatch.setattr(dimension_scan, "TILE_DOUBLES", 1 << 10)
    centres = RANDOM.standard_normal((30, 24)) * 2
    rows = [(int(i), (centres[i % 30] + RANDOM.standard_normal(24)).tolist()) for i in range(3000)]
    found = told(nearest_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)))
    expected = plain(rows)
    assert recall(found, expected) >= 0.95
    exact = {i: dict(pairs) for i, pairs in plain(rows, nearest=3000).items()}
    for i, pairs in found.items():
        assert len(pairs) == 20 and all(exact[i][j] == s for j, s in pairs)
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))


def test_lengths_differ(spark):
    """The longest rows have the largest products, not the nearest ones."""
    rows = [(int(i), (RANDOM.standard_normal(12) * (1 + i % 7)).tolist()) for i in range(600)]
    found = told(nearest_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)))
    assert recall(found, plain(rows)) >= 0.95


def test_hot_vector(spark):
    """A third of the rows are one vector: the smallest ids win the tie, but for the query's own."""
    hot = [1.0] * 8
    rows = [(i, hot if i % 3 == 0 else RANDOM.standard_normal(8).tolist()) for i in range(900)]
    found = told(nearest_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)))
    expected = plain(rows)
    assert set(found) == set(expected)
    for i in (0, 60):
        tied = [j for j, s in found[i] if s == 8.0]
        assert len(tied) > 5 and tied == [j for j in range(0, 900, 3) if j != i][: len(tied)]
    assert recall(found, expected) >= 0.95


def test_odd_rows(spark):
    base = [(i, RANDOM.standard_normal(6).tolist()) for i in range(50)]
    odd = [
        (60, None), (80, []), (100, [0.0] * 6), (120, [float("nan")] * 6), (140, [None] * 6), (160, [float("inf")] * 6),
        (None, [1.0] * 6), (180, [1.0, 2.0]), (181, [2.0, 1.0]), (200, [1.0] * 3), (20, [9.0] * 6), (7, base[7][1]), (40, base[40][1]),
        (-20, [-1.0] * 6),
    ]
    rows = base + odd
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    clashing = {n: F.lit("x") for n in ("query", "member", "dim", "list", "rank", "score", "ids", "bound", "home")}
    assert told(nearest_vectors(frame.withColumns(clashing))) == {i: r for i, r in plain(rows).items() if r}


@pytest.mark.parametrize("rows", [[], [(20, None, 1)], [(20, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 1)]])
def test_no_answers(spark, rows):
    assert nearest_vectors(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_scan_gives_up_early_but_keeps_the_nearest():
    rows = RANDOM.standard_normal((2000, 40))
    queries = rows[:50] + 0.1 * RANDOM.standard_normal((50, 40))
    longest = float(np.sqrt((rows * rows).sum(axis=1).max()))
    i, j, score = scan(queries, rows, np.full(50, -np.inf), np.arange(2000), longest, 10)
    products = queries @ rows.T
    for q in range(50):
        best = np.argsort(-products[q])[:10]
        mine = j[i == q]
        assert len(set(best) & set(mine)) >= 9
        assert np.allclose(np.sort(score[i == q]), np.sort(products[q][mine]))


def test_scan_keeps_to_its_bound():
    rows = RANDOM.standard_normal((300, 8))
    longest = float(np.sqrt((rows * rows).sum(axis=1).max()))
    top = np.sort(rows[:1] @ rows.T)[0][-5]
    _, j, score = scan(rows[:1], rows, np.array([top]), np.arange(300), longest, 10)
    assert len(j) == 5 and score.min() >= top - 1e-9


def test_probes_cover_the_sample():
    sample = RANDOM.standard_normal((2000, 16))
    longest = float(np.sqrt((sample * sample).sum(axis=1).max()))
    index = fit(sample, 100_000, longest)
    assert len(index.centroids) == 98
    assert 1 <= index.probes <= 98
    near = nearest_lists(np.c_[sample, np.zeros(2000)], index.centroids, 3)
    assert near.shape == (2000, 3) and near.max() < 98


def test_plan_shuffles_no_vector_for_each_pair(spark):
    """Both sides of the scan are dealt by list and tile; nothing is joined without a key."""
    rows = [(i, RANDOM.standard_normal(4).tolist(), 0) for i in range(100)]
    plan = nearest_vectors(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

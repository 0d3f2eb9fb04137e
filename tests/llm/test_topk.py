"""Exact search against SQL and against all products."""

import math

import numpy as np
from check_queries import compare
from pyspark.sql import functions as F

from tidelog.llm import topk
from tidelog.llm.queries import QUERIES, SQL


def test_whole_table(lspark, sf, duck):
    got = QUERIES["op6_exact_topk"](lspark, sf).toArrow()
    assert compare(got, duck.execute(SQL["op6_exact_topk"]).to_arrow_table()) == []


def test_blocks_and_ties(lspark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.integers(-2, 3, 4) / 16]) for i in range(300)]
    got = topk.top_k(lspark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 50 == 0).collect()
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q in range(0, 300, 50):
        scores = sorted(((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q))[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got)) == want


def test_few_candidates_are_evaluated():
    rng = np.random.default_rng(2)
    x = np.rint(rng.normal(0, 40, (20, 8))[rng.integers(0, 20, 4000)] + rng.normal(0, 2, (4000, 8)))
    pivots, squares = x[:24], (x * x).sum(axis=1)
    away = np.sqrt(np.maximum(squares[:, None] + (pivots ** 2).sum(axis=1) - 2 * x @ pivots.T, 0))
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    best = topk.best_of_block(np.arange(4000), x.view(Counted), squares, away, 0, x[0], squares[0], away[0], 5)
    every = sorted(((-int(s), i) for i, s in enumerate(x @ x[0]) if i))[:5]
    assert best == [(-s, i) for s, i in every] and sum(seen) < 2000


def test_odd_rows(lspark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, [0.5, -0.5]), (5, [0.5, -0.5]), (None, [9.0, 9.0]),
            (6, []), (7, [1.0, 2.0, 3.0]), (100, [0.0, 0.0]), (8, [1.0, 2.0])]
    vectors = lspark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, id int")
    got = sorted(map(tuple, topk.top_k(vectors, F.col("id") % 50 == 0).collect()))
    # Row 5 is there twice: both are candidates.
    assert got == [(0, 1, 8, 327680), (0, 2, 100, 0), (0, 3, 5, -32768), (0, 4, 5, -32768), (100, 1, 0, 0), (100, 2, 5, 0), (100, 3, 5, 0), (100, 4, 8, 0)]
    assert topk.top_k(vectors.limit(0), F.col("id") % 50 == 0).count() == 0

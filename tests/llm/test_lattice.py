"""Embedding groups against all pairs, the lattice against its definition, recall at the limit."""

import numpy as np

from tidelog.llm import buckets, lattice
from tidelog.llm.queries import QUERIES


def brute(ids, x, cosine=0.9):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= cosine
    np.fill_diagonal(close, False)
    group = np.arange(len(x))
    while True:
        low = np.minimum(group, np.where(close, group[None, :], len(x)).min(axis=1))
        low = low[low]
        if (low == group).all():
            break
        group = low
    least = {g: min(ids[k] for k in np.flatnonzero(group == g)) for g in set(group)}
    return {(ids[k], int(close[k].sum()), least[group[k]], ids[k] == least[group[k]]) for k in range(len(x))}


def test_whole_table(lspark, sf):
    rows = lspark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
    got = set(map(tuple, QUERIES["op7_lattice"](lspark, sf).select("vec_id", "n_links", "component_id", "kept").collect()))
    assert got == want


def test_recall_at_the_limit():
    rng = np.random.default_rng(5)
    x = lattice.unit_rows(rng.normal(size=(3000, 64)))
    z = rng.normal(size=x.shape)
    z = lattice.unit_rows(z - (z * x).sum(axis=1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    (a, pa), (b, pb) = lattice.cells(x), lattice.cells(y)
    met = ((a == b) | (pa == b[..., None]).any(-1) | (pb == a[..., None]).any(-1)).any(-1)
    assert met.mean() > 0.97
    assert (a[:1500] == a[1500:]).mean() < 0.001  # unrelated vectors rarely share a cell


def test_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 2, (500, 8))
    found = lattice.nearest_point(x)
    assert ((found.sum(axis=1) % 2) == 0).all() and (np.isin(found % 1, [0, 0.5]).all(axis=1)).all()
    ways = lattice.minimal_vectors()
    assert len(ways) == 240 and np.allclose((ways ** 2).sum(axis=1), 2)
    others = ((x[:, None] - found[:, None] - ways) ** 2).sum(-1)  # a nearer point would be a neighbour of the found one
    assert (((x - found) ** 2).sum(axis=1)[:, None] <= others + 1e-9).all()


def test_large_group_in_blocks(lspark, monkeypatch):
    monkeypatch.setattr(buckets, "SMALL", 6)
    monkeypatch.setattr(buckets, "BLOCK", 16)
    monkeypatch.setattr(lattice, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(3, 16))
    x = centre[rng.integers(0, 3, 150)] + rng.normal(0, 0.45, (150, 16))
    x = np.vstack([x, x[:20], rng.normal(size=(30, 16))])
    rows = [(k + 5, [float(v) for v in r]) for k, r in enumerate(x)]
    got = set(map(tuple, lattice.near_duplicates(lspark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    want = brute([r[0] for r in rows], x)
    assert len(got & want) > 0.97 * len(want)


def test_odd_rows(lspark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (9, [1.0, 2.0]), (8, [2.0, 4.0]), (8, [2.0, 4.0]),
            (7, [1.0, 2.0, 0.0]), (None, [1.0, 2.0])]
    vectors = lspark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, v int")
    got = sorted(map(tuple, lattice.near_duplicates(vectors).collect()), key=str)
    assert got == sorted([(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, None)] + [(9, 2, 8, False), (8, 2, 8, True), (8, 2, 8, True)], key=str)
    assert lattice.near_duplicates(vectors.limit(0)).count() == 0

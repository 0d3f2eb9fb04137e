"""Near-duplicate embeddings: random projections decoded to E8 lattice points, neighbouring cells probed, cosine verified."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.buckets import BLOCK, bucket_links, square_blocks, with_heads
from tidelog.llm.common import Scratch
from tidelog.llm.components import components
from tidelog.llm.vectors import finite, matrix

COSINE = 0.9
TABLES, POINTS, SPREAD, PROBES, SEED = 12, 2, 0.5, 8, 7


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the ways from a cell to its neighbours."""
    pairs = [(i, j, s, t) for i, j in combinations(range(8), 2) for s, t in product((1, -1), repeat=2)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, s, t) in enumerate(pairs):
        whole[row, [i, j]] = s, t
    half = np.array([v for v in product((0.5, -0.5), repeat=8) if np.prod(v) > 0])
    return np.vstack([whole, half])


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole-number points whose sum is even."""
    near = np.rint(x)
    rest = x - near
    worst = np.abs(rest).argmax(axis=1)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    near[odd, worst[odd]] += np.where(rest[odd, worst[odd]] >= 0, 1, -1)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row of 8: whole numbers or halves, with an even sum."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def cells(unit: np.ndarray, tables: int = TABLES, points: int = POINTS, spread: float = SPREAD, probes: int = PROBES,
          seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(own, probed): 64-bit cell numbers, rows x tables and rows x tables x probed cells, of unit vectors.

    In each table ``points`` projections to 8 dimensions give a lattice point each, together the
    cell. Probed are the cells with one of the points moved to one of the ``probes`` neighbours
    that lie most in the direction of the vector.
    """
    rng, ways, n = np.random.default_rng([seed, unit.shape[1]]), minimal_vectors(), len(unit)
    own, probed = [], []
    with np.errstate(over="ignore"):
        for _ in range(tables):
            weights = rng.integers(1, 2 ** 63, 8 * points, dtype=np.uint64) | np.uint64(1)
            mark = rng.integers(0, 2 ** 63, dtype=np.uint64)
            number, moves = np.full(n, mark, np.uint64), []
            for p in range(points):
                projected = unit @ rng.normal(0, spread, (unit.shape[1], 8))
                point = nearest_point(projected)
                key = weights[8 * p:8 * p + 8]
                number += ((2 * point).astype(np.int64).view(np.uint64) * key).sum(axis=1, dtype=np.uint64)
                toward = np.argpartition(-((projected - point) @ ways.T), probes, axis=1)[:, :probes]
                steps = ((2 * ways).astype(np.int64).view(np.uint64) * key).sum(axis=1, dtype=np.uint64)
                moves.append(steps[toward])
            own.append(number)
            probed.append(number[:, None] + np.hstack(moves))
    return np.array(own).T.view(np.int64), np.stack(probed, axis=1).view(np.int64)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component near 1: exact, and no product of components vanishes or overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pairs_close(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Whether row k of x and row k of y, both scaled, are at the cosine or above."""
    return (x * y).sum(axis=1) >= cosine * np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def all_close(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """The same for every row of x with every row of y; what rounding of the product could decide is decided pair by pair."""
    bound = cosine * np.sqrt(np.outer((x * x).sum(axis=1), (y * y).sum(axis=1)))
    products = x @ y.T
    close = products >= bound
    i, j = np.nonzero(np.abs(products - bound) <= 1e-9 * bound)
    close[i, j] = pairs_close(x[i], y[j], cosine)
    return close


def entries(vectors: DataFrame) -> DataFrame:
    """(cell, v, own): every vector in its own cell of each table and in the cells it probes."""
    def batches(rows):
        for batch in rows:
            ids, sizes = batch.column("v").to_numpy(), batch.column("embedding").value_lengths().to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                own, probed = cells(unit_rows(matrix(batch.column("embedding").take(pa.array(at)))))
                probed = probed.reshape(len(at), -1)
                yield pa.RecordBatch.from_pydict({
                    "cell": np.concatenate([own.ravel(), probed.ravel()]),
                    "v": np.concatenate([ids[at].repeat(own.shape[1]), ids[at].repeat(probed.shape[1])]),
                    "own": np.arange(own.size + probed.size) < own.size})

    return vectors.select("v", "embedding").mapInArrow(batches, "cell long, v long, own boolean")


def verified(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) whose whole vectors have that cosine in double precision, or more."""
    def batches(rows):
        for batch in rows:
            out = np.zeros(batch.num_rows, bool)
            sizes = batch.column("x").value_lengths().to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero((sizes == size) & (batch.column("y").value_lengths().to_numpy() == size))
                if len(at):
                    out[at] = pairs_close(*(scaled(matrix(batch.column(c).take(pa.array(at)))) for c in ("x", "y")), cosine)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(out))

    x = vectors.select(F.col("v").alias("a"), F.col("embedding").alias("x"))
    y = vectors.select(F.col("v").alias("b"), F.col("embedding").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(batches, "a long, b long")


def _same_length(table: pa.Table):
    """((left rows, right rows), [left vectors, right vectors]) for each length of vector, scaled."""
    sizes = table["embedding"].combine_chunks().value_lengths().to_numpy()
    left = table["left"].to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        here = np.flatnonzero((sizes == size) & left), np.flatnonzero((sizes == size) & ~left)
        if len(here[0]) and len(here[1]):
            yield here, [scaled(matrix(table["embedding"].combine_chunks().take(pa.array(h)))) for h in here]


def _links_in_blocks(table: pa.Table, cosine: float = COSINE) -> pa.Table:
    """Of each left vector one link to every component it meets among the right ones: a forest has the same components."""
    a, b = [], []
    ids, comp = table["v"].to_numpy(), table["comp"].to_numpy()
    for (rows, columns), (x, y) in _same_length(table):
        close = all_close(x, y, cosine)
        for k, row in enumerate(rows):
            met = columns[np.flatnonzero(close[k])]
            _, first = np.unique(comp[met], return_index=True)
            a += [ids[row]] * len(first)
            b += ids[met[first]].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _counts_in_blocks(table: pa.Table) -> pa.Table:
    """For each left vector the vectors among the right ones at the cosine or above, of its own component."""
    v, n = [], []
    ids, comp, many = table["v"].to_numpy(), table["comp"].to_numpy(), table["many"].to_numpy()
    for (rows, columns), (x, y) in _same_length(table):
        close = all_close(x, y, COSINE) & (comp[rows][:, None] == comp[columns]) & (ids[rows][:, None] != ids[columns])
        v += ids[rows].tolist()
        n += (close @ many[columns]).tolist()
    return pa.table({"v": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, name: str = "lattice") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: links at ``cosine`` or more, found by shared lattice cells.

    ``vectors`` has vec_id and embedding; other columns are ignored. Vectors that are null, empty,
    zero or not finite, and rows with a null vec_id, have no links and are components of their own.
    Vectors of different length never link. Repeated rows are other vectors at cosine 1. Equal
    vectors are collapsed before anything is compared. The cells decide components; n_links then counts
    all links inside a component, block by block, so copies in a component are never missed.
    """
    scratch = Scratch(vectors.sparkSession, name)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(finite(), F.col("embedding").cast("array<double>")).alias("embedding"))
    usable = F.col("vec_id").isNotNull() & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    distinct = rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("many"))
    distinct = scratch.store(distinct.select(F.monotonically_increasing_id().alias("v"), "embedding", "first", "many"), "distinct")
    payload = distinct.select("v", "embedding")
    links = bucket_links(scratch, with_heads(scratch, entries(distinct)), payload, lambda pairs: verified(pairs, payload, cosine), lambda t: _links_in_blocks(t, cosine))
    comps = components(scratch, links)
    comps = scratch.store(comps.withColumnRenamed("id", "v").withColumnRenamed("component", "comp").join(distinct, "v"), "members")
    sizes = comps.groupBy("comp").agg(F.count("*").alias("n"), F.min("first").alias("component_id"))
    # Small components share a task, a large one is dealt into square blocks.
    members = comps.join(sizes, "comp").select("v", "comp", "embedding", "many", "n")
    deal = max(1, comps.count() // BLOCK)
    small = members.where(f"n <= {BLOCK // 4}").withColumn("i", F.pmod(F.xxhash64("comp"), F.lit(deal)).cast("int"))
    small = small.select("v", "comp", "embedding", "many", F.explode(F.array(F.lit(True), F.lit(False))).alias("left"), F.lit(-1).cast("long").alias("g"), "i", F.col("i").alias("j"))
    large = square_blocks(members.where(f"n > {BLOCK // 4}"), "n").select("v", "comp", "embedding", "many", "left", F.col("comp").alias("g"), "i", "j")
    schema = "v long, n long"
    counted = small.groupBy("g", "i", "j").applyInArrow(_counts_in_blocks, schema).union(large.groupBy("g", "i", "j").applyInArrow(_counts_in_blocks, schema))
    counted = counted.groupBy("v").agg(F.sum("n").alias("n_links"))
    found = distinct.join(counted, "v", "left").join(comps.select("v", "comp"), "v", "left").join(sizes.select("comp", "component_id"), "comp", "left")
    found = scratch.store(found.select("embedding", (F.coalesce("n_links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                                       F.coalesce("component_id", "first").alias("component_id")), "found")
    linked = rows.where(usable).join(found, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

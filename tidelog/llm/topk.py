"""Exact top-k by integer inner product: pivot table, bounds from many pivots, candidates in order of their bound."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch
from tidelog.llm.vectors import distinct_rows, matrix

PIVOTS, SCALE = 24, 256
# Rows that meet in one task: candidates and queries of a pair of blocks.
CANDIDATE_ROWS, QUERY_ROWS = 8192, 2048
STEP = 256  # candidates evaluated between two looks at the bound


def quantised(embedding: str = "embedding") -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` (id, ints, many) with ``square`` (its squared length) and ``away`` (its distance to each pivot)."""
    def batches(parts):
        for batch in parts:
            x = matrix(batch.column("ints"))
            square = (x * x).sum(axis=1)
            away = np.sqrt(np.maximum(square[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ints"), batch.column("many"), pa.array(square),
                 pa.FixedSizeListArray.from_arrays(pa.array(away.ravel()), len(pivots)).cast(pa.list_(pa.float64()))],
                ["id", "ints", "many", "square", "away"])

    return rows.mapInArrow(batches, "id long, ints array<long>, many long, square double, away array<double>")


def best_of_block(*block) -> list[tuple[int, int]]:
    """The k best (score, id) of :func:`best_rows`."""
    return [(score, i) for score, i, _ in best_rows(*block)]


def best_rows(ids: np.ndarray, x: np.ndarray, squares: np.ndarray, away: np.ndarray, query_id: int, q: np.ndarray,
              q_square: float, q_away: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best (score, id, place) for one query, ties to the smaller id.

    With |q - x| >= max |d(q, p) - d(x, p)| over the pivots p, the product (q² + x² - |q - x|²) / 2 has
    an upper bound. Candidates are evaluated in its order until it falls below the k-th score.
    """
    apart = np.abs(away - q_away).max(axis=1)
    bound = (squares + q_square - apart * apart) / 2
    bound += 1e-6 * (1 + squares + q_square)  # rounding of the distances
    bound[ids == query_id] = -np.inf
    order = np.argsort(-bound, kind="stable")
    best: list[tuple[int, int, int]] = []
    for at in range(0, len(order), STEP):
        part = order[at:at + STEP]
        part = part[bound[part] > -np.inf]
        if not len(part) or len(best) == k and bound[part[0]] < best[-1][0]:
            break
        scores = x[part] @ q
        first = np.lexsort((ids[part], -scores))[:k]
        best = sorted([*best, *((int(scores[f]), int(ids[part[f]]), int(part[f])) for f in first)], key=lambda t: (-t[0], t[1]))[:k]
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, name: str = "topk") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer products of each query with all other rows; all, if fewer.

    ``vectors`` has vec_id and embedding, ``is_query`` is a condition on vec_id; other columns are
    ignored. Rows with a null vec_id or a vector that is null or not finite take no part. Rows that
    repeat a vec_id are all candidates for other ids and all ask, so a row may come out several times. Vectors of another
    length than the query's are no candidates. Components are up to 2^20 in size, so that products
    are exact. An empty table gives no rows. Queries and candidates meet block by block, each pair
    of blocks in one task of bounded size; only the k best of a block go on.
    """
    scratch = Scratch(vectors.sparkSession, name)
    rows = distinct_rows(vectors).select(F.col("vec_id").alias("id"), quantised().alias("ints"), "many")
    rows = scratch.store(rows.withColumn("size", F.size("ints")).where("size > 0"), "ints")
    kinds = {r["size"]: (r["n"], r["queries"] or 0) for r in rows.groupBy("size").agg(
        F.count("*").alias("n"), F.sum(is_query_on(is_query).cast("long")).alias("queries")).collect()}  # a row per dimension
    results = None
    for size, (n, queries) in sorted(kinds.items()):
        if not queries:
            continue
        same = rows.where(F.col("size") == size)
        pivots = np.array([r.ints for r in same.orderBy(F.xxhash64("id")).limit(PIVOTS).collect()], float)
        table = scratch.store(pivot_table(same.select("id", "ints", "many"), pivots), f"pivots-{size}")
        found = _blocks(table, is_query, n, queries, k)
        results = found if results is None else results.union(found)
    if results is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    results = results.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("many", F.lit(k)))))
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def is_query_on(is_query: Column) -> Column:
    return F.coalesce(is_query, F.lit(False))


def _blocks(table: DataFrame, is_query: Column, n: int, queries: int, k: int) -> DataFrame:
    wide, deep = math.ceil(n / CANDIDATE_ROWS), math.ceil(queries / QUERY_ROWS)
    own = F.xxhash64("id")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    candidates = table.withColumn("c", F.pmod(own, F.lit(wide)).cast("int")).withColumn("q", every(deep))
    asked = table.where(is_query_on(is_query)).withColumn("q", F.pmod(own, F.lit(deep)).cast("int")).withColumn("c", every(wide))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            ids, x = left["id"].to_numpy(), matrix(left["ints"])
            squares, away, many = left["square"].to_numpy(), matrix(left["away"]), left["many"].to_pylist()
            asked = zip(right["id"].to_pylist(), matrix(right["ints"]), right["square"].to_numpy(), matrix(right["away"]), right["many"].to_pylist())
            for query_id, q, q_square, q_away, times in asked:
                out += [(query_id, i, s, times * many[p]) for s, i, p in best_rows(ids, x, squares, away, query_id, q, q_square, q_away, k)]
        return pa.table({name: pa.array([r[at] for r in out], pa.int64()) for at, name in enumerate(("query_id", "vec_id", "score", "many"))})

    return candidates.groupBy("c", "q").cogroup(asked.groupBy("c", "q")).applyInArrow(meet, "query_id long, vec_id long, score long, many long")

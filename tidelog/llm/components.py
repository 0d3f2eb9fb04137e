"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch

MAX_ROUNDS = 60


def _largest_to_root(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest neighbour of that node."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("a", "b")
    roots = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("root"))
    return both.where("b > a").join(roots, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))


def _smaller_to_root(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the smallest of them. Links have a > b."""
    roots = links.groupBy("a").agg(F.min("b").alias("root"))
    moved = links.join(roots, "a").where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.union(roots)


def components(scratch: Scratch, links: DataFrame, name: str = "links") -> DataFrame:
    """Distributed union-find: (id, component) for every id in ``links`` (a, b), component = smallest id reachable.

    Alternating stars (Kiveris et al., "Connected Components in MapReduce and Beyond"): each round
    re-links nodes to the smallest neighbour until every node points at its root. A round is two
    minima with map-side combine and two equi-joins; a node with many neighbours is a skewed join
    key, which adaptive execution splits. Rounds are written to the shared folder. Links from a row
    to itself, repeated links and links with a null end add nothing.
    """
    state = scratch.store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b AND a IS NOT NULL AND b IS NOT NULL").distinct(), f"{name}-0")
    seen = None
    for turn in range(1, MAX_ROUNDS + 1):
        state = scratch.store(_smaller_to_root(_largest_to_root(state).where("a > b").distinct()).distinct(),
                              f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = state.select(F.col("b").alias("id")).distinct()
    return state.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        roots.select("id", F.col("id").alias("component")))

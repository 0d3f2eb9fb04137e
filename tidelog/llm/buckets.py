"""Links between rows that share a bucket, for buckets of any size: no pair is lost and no bucket is expanded into all its pairs."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch
from tidelog.llm.components import components

# A bucket of up to so many entries is compared pair by pair; a larger one in square blocks of so many rows.
SMALL, BLOCK = 32, 1024


def square_blocks(members: DataFrame, count: str) -> DataFrame:
    """Rows of groups of any size, repeated so that every pair of a group meets in one (group, i, j): side says as which."""
    n = F.ceil(F.col(count) / F.lit(BLOCK)).cast("int")
    cut = members.withColumn("_n", n).withColumn("_at", F.pmod(F.xxhash64("v", F.lit(1)), F.col("_n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return cut.withColumn("_other", other).select(
        *members.columns, F.explode(F.array(
            F.struct(F.lit(True).alias("left"), F.col("_at").alias("i"), F.col("_other").alias("j")),
            F.struct(F.lit(False).alias("left"), F.col("_other").alias("i"), F.col("_at").alias("j")))).alias("p")).select(
        *members.columns, "p.left", "p.i", "p.j")


def with_heads(scratch: Scratch, placed: DataFrame) -> DataFrame:
    """(cell, v, own, head, n) of the entries of buckets that hold different rows; n counts entries, head is the bucket's first own row."""
    placed = scratch.store(placed, "entries")
    heads = scratch.store(placed.groupBy("cell").agg(
        F.min(F.when(F.col("own"), F.col("v"))).alias("head"), F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")).where(
        "low != high AND head IS NOT NULL").select("cell", "head", "n"), "heads")
    return placed.join(heads, "cell")


def bucket_links(scratch: Scratch, members: DataFrame, payload: DataFrame, verified: Callable[[DataFrame], DataFrame],
                 in_blocks: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Links (a, b) with the components of all links between rows that share a bucket.

    ``members`` has cell, v, own (false for an entry that only looks into the cell: two such are
    no pair), head and n, and is read several times. ``payload`` has v and what is compared. ``verified`` keeps the pairs (a, b) that
    link. First every entry is compared with the first row of its bucket, which is linear and
    joins most groups of copies. Then only buckets that still hold several components are compared
    across them: small ones as pairs, large ones by ``in_blocks``, whose tasks get two blocks of
    rows (left or not, v, comp and the payload) and give (a, b).
    """
    stars = members.where("v != head").select(F.least("v", "head").alias("a"), F.greatest("v", "head").alias("b")).distinct()
    star_links = scratch.store(verified(stars), "stars")
    comps = components(scratch, star_links, "star-links")
    known = members.where("n > 2").join(comps.withColumnRenamed("id", "v"), "v", "left").select(
        "cell", "head", "v", "own", F.coalesce("component", "v").alias("comp"))
    open_ = known.groupBy("cell").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    open_ = scratch.store(open_.select("cell", "n"), "open")
    small = known.join(open_.where(f"n <= {SMALL}"), "cell").groupBy("cell", "head").agg(F.collect_list(F.struct("v", "own", "comp")).alias("vs"))
    pairs = small.select("head", "vs", F.explode("vs").alias("x")).where("x.own").select("head", "x", F.explode("vs").alias("y")).where(
        "x.comp != y.comp AND x.v != head AND y.v != head").select(
        F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct()
    large = known.join(open_.where(f"n > {SMALL}"), "cell").dropDuplicates(["cell", "v"]).join(payload, "v")
    squares = square_blocks(large.drop("head", "own"), "n")
    large_links = squares.groupBy("cell", "i", "j").applyInArrow(in_blocks, "a long, b long")
    return star_links.union(verified(pairs)).union(large_links.where("a != b"))

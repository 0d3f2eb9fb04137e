"""A blocked Bloom filter as a table of blocks, built and tested by expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A block is four 64-bit words with two bits of a key in each.
WORDS, BITS_PER_KEY = 4, 16
# Blocks are broadcast up to this number (40 MB with their numbers); beyond it the filter is joined by shuffle.
BROADCAST_BLOCKS = 1 << 20


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // (64 * WORDS)))


def _bits(key: Column) -> list[Column]:
    """The bits of a key in the words of its block."""
    bits = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")

    def at(place: int) -> Column:
        return F.call_function("shiftleft", one, F.shiftright(bits, 6 * place).bitwiseAND(F.lit(63)).cast("int"))

    return [at(2 * w).bitwiseOR(at(2 * w + 1)) for w in range(WORDS)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of column ``key`` as a table: block number and four words; at most ``blocks`` rows, combined before the shuffle."""
    words = keys.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"),
                        *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col("key")))])
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def with_maybe(rows: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with boolean ``_maybe``: false only if column ``key`` is no ``key`` of ``keys``."""
    found = bloom_blocks(keys, blocks)
    if blocks <= BROADCAST_BLOCKS:
        found = F.broadcast(found)
    hit = reduce(and_, [F.col(f"w{i}").bitwiseAND(b) == b for i, b in enumerate(_bits(F.col("key")))])
    probe = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    return probe.join(found, "block", "left").select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("_maybe"))

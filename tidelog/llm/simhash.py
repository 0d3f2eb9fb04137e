"""SimHash fingerprints of documents and their near-duplicate groups by radius-1 balls of whole fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, free_name
from tidelog.llm.components import components

SHINGLE, SEED, BITS, SEGMENTS = 3, 42, 64, 2


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text, as a signed number; no words (or null) give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(p, seed) for p in parts], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, key, fp) of every row of ``docs``; key is a hash of the whole text."""
    def batches(rows):
        for batch in rows:
            texts = batch.column("text").to_pylist()
            prints = pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), prints], ["doc_id", "key", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return narrow.mapInArrow(batches, "doc_id long, key long, fp long")


def segment_balls(segments: int = SEGMENTS) -> list[int]:
    """Masks of the radius-1 Hamming ball of each segment, the centre once, as signed 64-bit numbers."""
    width = BITS // segments
    flips = [1 << (s * width + bit) for s in range(segments) for bit in range(width)]
    return [0, *(m - (1 << 64) if m >> 63 else m for m in flips)]


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fp`` at 2 or fewer differing bits.

    This is one table keyed by the whole fingerprint, in place of multi-index tables by segment: a
    fingerprint is entered under itself and its 64 neighbours at distance 1, whatever ``SEGMENTS``
    is. It serves distance 2 alone. Two fingerprints share such an entry exactly if they differ in at
    most two bits. So a table bucket holds at most 65
    fingerprints, whatever the size of a group of near copies, and needs no cap. Its members are
    kept as one bit mask (a fixed-width hash aggregate). Each is linked to the smallest, after a
    comparison of the whole fingerprints. ``prints`` has distinct values of ``fp``.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in segment_balls()])
    entries = prints.select("fp", F.explode(masks).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("bucket"), "flip")
    buckets = entries.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_or("flip").alias("flips"), F.max(F.col("flip") == 0).alias("whole")).where("n > 1")
    held = F.filter(masks, lambda m: F.when(m == 0, F.col("whole")).otherwise(m.bitwiseAND(F.col("flips")) != 0))
    members = buckets.select(F.transform(held, lambda m: F.col("bucket").bitwiseXOR(m)).alias("fps"))
    return (members.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
            .where("a != b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).distinct())


def _grouped(docs: DataFrame, name: str) -> DataFrame:
    """(doc_id, key, fp, component, component_id) of every row; component is the smallest fingerprint of the group."""
    scratch = Scratch(docs.sparkSession, name)
    printed = scratch.store(with_fingerprint(docs), "prints")
    values = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = components(scratch, near_links(values.select("fp")))
    values = values.join(groups.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    least = values.groupBy("component").agg(F.min("first").alias("component_id"))
    named = scratch.store(values.join(least, "component").select("fp", "component", "component_id"), "groups")
    return printed.join(named, "fp")


def near_duplicates(docs: DataFrame, name: str = "simhash") -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints link, directly or through others.

    ``docs`` needs doc_id and text; other columns are ignored. component_id is the smallest doc_id
    of the group. A null or empty text has fingerprint zero and links like any other. Rows with a
    null doc_id are fingerprinted and grouped, but never name a group (component_id is null if all
    are null). Repeated rows each give a row. An empty table gives no rows.
    """
    return _grouped(docs, name).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, name: str = "simhash-keep") -> DataFrame:
    """``docs`` with one document of each group, that of the smallest doc_id; columns as given, whatever they are called.

    Rows with a null doc_id are kept: they have no id to be told apart by. Equal rows of the kept
    document are reduced to one. Different texts under one doc_id are different documents: each stays
    if its group has no smaller doc_id, and of those in one group the one with the smallest text hash. Null and empty
    texts are one group. An empty table gives no rows.
    """
    found = _grouped(docs.select("doc_id", "text"), name).where("doc_id IS NOT NULL")
    doc, key = free_name(docs, "_doc"), free_name(docs, "_key")
    keepers = found.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("k")).select(
        F.col("k.doc_id").alias(doc), F.col("k.key").alias(f"{key}_"))
    keyed = docs.where("doc_id IS NOT NULL").withColumn(key, F.xxhash64("text"))
    known = keyed.join(keepers, (F.col("doc_id") == F.col(doc)) & (F.col(key) == F.col(f"{key}_")), "left_semi")
    return known.dropDuplicates(["doc_id", key]).drop(key).unionByName(docs.where("doc_id IS NULL"))

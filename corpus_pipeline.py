"""From raw documents to packed training sequences: toxic documents out, repeated lines out, near copies out, the rest packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import lines, packing, simhash, toxicity
from tidelog.llm.common import Scratch, prepare, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it is fitted on the labels outside the held-out fold."""
    return toxicity.keep_clean(docs, table(prepare(spark), sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are equal or nearly so across all documents the first stays."""
    prepare(spark)
    return lines.without_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    prepare(spark)
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("simhash near-dedup", drop_near_copies), ("best-fit packing", pack)]

# Neither the classifier nor the hashes can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written to the shared folder and read by the next."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.store(docs, f"stage-{k}")
    return docs

"""Many subscribers and many patterns at once: tables of prefixes and globs that meet topics in one equi-join.

A log has few different topics, so topics are matched once and events then join their topic. A topic meets
a prefix by its own beginnings of the lengths that prefixes have; a glob is entered under its literal head and
checked where the head fits. Nothing is compared with everything, and no plan grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _by_prefix(topics: DataFrame, keyed: DataFrame, topic: str, prefix: str) -> DataFrame:
    """Rows of ``topics`` with those of ``keyed`` whose ``prefix`` they begin with."""
    # One array of different lengths, none longer than a topic may be.
    lengths = keyed.agg(F.collect_set(F.length(prefix)).alias("n")).scalar()
    cut = topics.withColumn("_lengths", lengths).withColumn("_n", F.explode("_lengths")).where(F.col("_n") <= F.length(topic))
    return cut.withColumn(prefix, F.expr(f"substring(`{topic}`, 1, _n)")).drop("_lengths", "_n").join(keyed, prefix)


def subscribed(ev: DataFrame, subscriptions: DataFrame, column: str = "topic") -> DataFrame:
    """``ev`` with ``subscriber``, once for every subscriber (subscriber, prefix) with a prefix of its topic.

    The empty prefix takes every topic. A null topic or prefix matches nothing; a subscriber whose prefixes overlap gets an event once.
    """
    wanted = subscriptions.where("prefix IS NOT NULL").select("subscriber", F.col("prefix").alias("_prefix")).distinct()
    topics = ev.select(F.col(column).alias("_topic")).where("_topic IS NOT NULL").distinct()
    matches = _by_prefix(topics, wanted, "_topic", "_prefix").select("_topic", "subscriber").distinct()
    return ev.join(matches, F.col(column) == F.col("_topic")).drop("_topic")


def glob_head(glob: Column) -> Column:
    """The part of a ``*`` / ``?`` pattern before its first wildcard."""
    return F.regexp_extract(glob, r"(?s)^[^*?]*", 0)


def glob_like(glob: Column) -> Column:
    """The same pattern for LIKE."""
    plain = F.regexp_replace(glob, r"([\\%_])", r"\\$1")
    return F.translate(plain, "*?", "%_")


def matched_topics(topics: DataFrame, patterns: DataFrame, column: str = "topic") -> DataFrame:
    """Every different topic with every pattern (column ``glob`` and others) that it matches."""
    keyed = patterns.where("glob IS NOT NULL").withColumns({"_head": glob_head(F.col("glob")), "_like": glob_like(F.col("glob"))})
    different = topics.select(column).where(F.col(column).isNotNull()).distinct()
    return _by_prefix(different, keyed, column, "_head").where(F.expr(f"`{column}` LIKE _like")).drop("_head", "_like")


def selected(ev: DataFrame, patterns: DataFrame, column: str = "topic") -> DataFrame:
    """Events whose topic matches a pattern with ``include`` and none without; no including pattern at all means every topic.

    ``patterns`` has glob and include. A null topic matches no pattern.
    """
    marks = matched_topics(ev, patterns, column).groupBy(F.col(column).alias("_topic")).agg(
        F.bool_or("include").alias("_in"), F.bool_or(~F.col("include")).alias("_out"))
    any_in = patterns.agg(F.coalesce(F.bool_or(F.col("include") & F.col("glob").isNotNull()), F.lit(False)).alias("n")).scalar()
    joined = ev.join(marks, F.col(column) == F.col("_topic"), "left")
    kept = ~F.coalesce("_out", F.lit(False)) & (F.coalesce("_in", F.lit(False)) | ~any_in)
    return joined.where(kept).drop("_topic", "_in", "_out")

"""Topics and fan-out to publishers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import KAFKA_PREFIX, STREAM_PREFIX

# --- Fixed values: topic styles and the text for a missing name --------------
TOPIC_STYLES = ["kafka", "stream", "message"]
UNKNOWN = "unknown"


def with_topic(
    ev: DataFrame,
    style: str = "kafka",
    prefix: str | None = None,
    per_table: bool = False,
    name: str = "topic",
) -> DataFrame:
    """Add the topic an event goes to.

    ``kafka``    the prefix alone, or ``prefix{db}.{table}`` when ``per_table``
    ``stream``   ``prefix{db}.{table}``
    ``message``  ``{db}.{table}``
    """
    if style not in TOPIC_STYLES:
        raise ValueError(f"style must be one of {TOPIC_STYLES}")
    place = F.concat(F.coalesce("db", F.lit(UNKNOWN)), F.lit("."), F.coalesce("table", F.lit(UNKNOWN)))
    if style == "message":
        return ev.withColumn(name, place)
    default = KAFKA_PREFIX if style == "kafka" else STREAM_PREFIX
    head = F.lit(default if prefix is None else prefix)
    topic = head if style == "kafka" and not per_table else F.concat(head, place)
    return ev.withColumn(name, topic)


# A publisher listens to named databases or to all of them.
def _listeners(routes: DataFrame, *cols: str) -> tuple[DataFrame, DataFrame]:
    """(db, _to) for named databases and one row (_to) of those that take every database: arrays of publishers."""
    active = routes.where("active").withColumn("_to", F.struct(*cols))
    named = active.select("_to", F.explode(F.array_distinct("databases")).alias("db")).groupBy("db").agg(F.collect_list("_to").alias("_to"))
    everywhere = active.where(F.coalesce(F.size("databases"), F.lit(0)) == 0).agg(F.collect_list("_to").alias("_to"))
    return named, everywhere


def route(ev: DataFrame, routes: DataFrame) -> DataFrame:
    """One row per event and matching active publisher.

    A publisher without databases takes every event; an event without a database
    goes nowhere.  Each event meets the publishers of its database in one join, as
    an array, and is repeated only for publishers that take it.  A route's
    settings stay with the route: they may hold passwords.
    """
    named, everywhere = _listeners(routes, "publisher", "sink")
    met = ev.where("db is not null").join(named, "db", "left")
    none = F.array().cast("array<struct<publisher:string,sink:string>>")
    to = F.concat(F.coalesce("_to", none), everywhere.scalar())
    return met.withColumn("_to", F.explode(to)).select(*ev.columns, "_to.publisher", "_to.sink")


def with_dispatch_count(ev: DataFrame, routes: DataFrame) -> DataFrame:
    """Add how many publishers each event reaches.

    Counts per database come from the routes, so events are not shuffled.
    """
    named, everywhere = _listeners(routes, "publisher")
    named = named.select("db", F.size("_to").cast("bigint").alias("_n"))
    everywhere = everywhere.select(F.size("_to").cast("bigint"))
    return ev.join(named, "db", "left").withColumn(
        "dispatched",
        F.when(F.col("db").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.coalesce("_n", F.lit(0).cast("bigint")) + everywhere.scalar()),
    ).drop("_n")


def dispatch_counts(ev: DataFrame, routes: DataFrame) -> DataFrame:
    """Publishers reached per event."""
    return with_dispatch_count(ev, routes).select("log_file", "position", "db", "table", "dispatched")


def unmatched_events(ev: DataFrame, routes: DataFrame) -> DataFrame:
    """Events that no active publisher takes."""
    return with_dispatch_count(ev, routes).where("dispatched = 0").drop("dispatched")


def new_streams(found: DataFrame, known: DataFrame) -> DataFrame:
    """Streams not seen before.  Both sides are reduced before they are shuffled."""
    return found.select("stream").distinct().join(known.select("stream").distinct(), "stream", "left_anti")

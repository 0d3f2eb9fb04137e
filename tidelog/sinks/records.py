"""Records as each kind of destination expects them (K2-K4, K6-K9).

All of these are projections: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import compact_summary
from ..functions.values import syslog_pri
from ..operators.filters import packet_bytes, size_guard
from ..operators.order import file_no
from ..operators.routing import with_topic
from ..schemas import PUBSUB_CHANNEL

PLACE = ["log_file", "position"]


def kafka_records(ev: DataFrame, prefix: str | None = None, per_table: bool = False) -> DataFrame:
    """Topic, key (transaction) and value (document)."""
    return with_topic(ev, "kafka", prefix, per_table).select(
        *PLACE, "topic", F.col("txn").alias("key"), F.col("json").alias("value"))


def _or_empty(name: str):
    return F.coalesce(F.col(name), F.lit(""))


def redis_stream_records(ev: DataFrame, prefix: str | None = None) -> DataFrame:
    """Stream name and its four fields; missing values are empty text."""
    fields = F.create_map(
        F.lit("json"), F.col("json"), F.lit("db"), _or_empty("db"),
        F.lit("table"), _or_empty("table"), F.lit("txn"), _or_empty("txn"),
    )
    return with_topic(ev, "stream", prefix, name="stream").select(*PLACE, "stream", fields.alias("fields"))


def pubsub_records(ev: DataFrame, channel: str = PUBSUB_CHANNEL) -> DataFrame:
    return ev.select(*PLACE, F.lit(channel).alias("channel"), F.col("json").alias("message"))


def syslog_records(ev: DataFrame, compact: bool = False, facility: str | None = None,
                   priority: str | None = None) -> DataFrame:
    """PRI number and message: the document, or its one-line summary."""
    pri = syslog_pri(F.lit(facility), F.lit(priority))
    if compact:
        return compact_summary(ev, "message").select(*PLACE, pri.alias("pri"), "message")
    return ev.select(*PLACE, pri.alias("pri"), F.col("json").alias("message"))


def datagram_records(ev: DataFrame, max_bytes: int | None = None, newline: bool = True) -> tuple[DataFrame, DataFrame]:
    """Datagrams that fit, and the oversize events for a dead-letter table."""
    fits, oversize = size_guard(ev, max_bytes, newline)
    packet = F.concat("json", F.lit("\n")) if newline else F.col("json")
    return (
        fits.select(*PLACE, packet.alias("packet"), packet_bytes(newline).alias("bytes")),
        oversize.select(*PLACE, "json", packet_bytes(newline).alias("bytes")),
    )


def topic_messages(ev: DataFrame, filtering: bool = True) -> DataFrame:
    """Two-part messages, or payloads alone (null topic) without filtering."""
    topic = F.col("topic") if filtering else F.lit(None).cast("string")
    return with_topic(ev, "message").select(*PLACE, topic.alias("topic"), F.col("json").alias("payload"))


def audit_rows(ev: DataFrame, ts: str | None = "ts") -> DataFrame:
    """Rows of the audit table; ``id`` follows from the log position.

    ``event_time`` is the event's time column, or now without one.
    """
    when = F.col(ts) if ts else F.current_timestamp()
    return ev.select(
        (F.shiftleft(file_no(), 32) + F.col("position")).alias("id"),
        when.alias("event_time"),
        _or_empty("txn").alias("txn_id"),
        _or_empty("db").alias("source_db"),
        _or_empty("table").alias("source_table"),
        F.col("type").alias("event_type"),
        _or_empty("log_file").alias("binlog_file"),
        F.col("position").alias("binlog_position"),
        F.col("json").alias("event_json"),
    )

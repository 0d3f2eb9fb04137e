"""Queries over what each destination receives."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from ..operators.metrics import delivery_stats
from ..sinks import records
from ..sinks.delivery_sink import deliver_batch
from ..sinks.deliver import DEFAULT_RETRIES, python_deliver, webhook_deliver
from ..session import scratch_folder
from ..sinks.files import audit_lookup, rotation_plan, write_audit, write_jsonl
from ..sinks.publisher import EventPublisher
from .derived_log import E, J, derived_events
from .registry import query


@query("rotation_plan", f"""WITH {E}, N AS (
  SELECT log_file, position, (row_number() OVER (ORDER BY seq) - 1) // 100 AS segment FROM E),
S AS (SELECT *, (SELECT max(segment) FROM N) - 1 - segment AS s FROM N)
SELECT log_file, position, segment, CASE WHEN s >= 0 THEN s END AS suffix, s < 3 AS kept FROM S""")
def rotation(spark, sf):
    return rotation_plan(derived_events(spark, sf), 100, 3).select("log_file", "position", "segment", "suffix", "kept")


@query("rotated_files", f"""WITH {J}, N AS (
  SELECT json, (row_number() OVER (ORDER BY seq) - 1) // 100 AS segment FROM J)
SELECT CAST(segment AS INTEGER) AS segment, json FROM N WHERE segment >= (SELECT max(segment) FROM N) - 3""")
def rotated(spark, sf):
    path = f"{scratch_folder(spark)}/rotated-{uuid.uuid4().hex}"
    write_jsonl(derived_events(spark, sf), path, 100, 3)
    return spark.read.text(path).select("segment", F.col("value").alias("json"))


class NoDeletes(EventPublisher):
    """Takes one event at a time and refuses deletes."""

    name = "no deletes"

    def publish(self, event):
        return int('"type":"DELETE"' in event["json"])


@query("event_publisher", f"""WITH {J} SELECT log_file, position, 'no deletes' AS publisher, kind <> 'DELETE' AS ok FROM J""")
def per_event(spark, sf):
    return NoDeletes().publish_batch(derived_events(spark, sf), 0).select("log_file", "position", "publisher", "ok")


@query("kafka_records", f"""WITH {J}
SELECT log_file, position, 'cdc.' || db || '.' || "table" AS topic, txn AS key, json AS value FROM J""")
def kafka(spark, sf):
    return records.kafka_records(derived_events(spark, sf), per_table=True)


@query("redis_stream_records", f"""WITH {J}
SELECT log_file, position, 'cdc:' || db || '.' || "table" AS stream, json, db, "table", txn FROM J""")
def redis_stream(spark, sf):
    out = records.redis_stream_records(derived_events(spark, sf))
    return out.select("log_file", "position", "stream", *[F.col("fields")[k].alias(k) for k in ("json", "db", "table", "txn")])


@query("pubsub_records", f"WITH {J} SELECT log_file, position, 'cdc_events' AS channel, json AS message FROM J")
def pubsub(spark, sf):
    return records.pubsub_records(derived_events(spark, sf))


@query("syslog_records", f"""WITH {J}
SELECT log_file, position, CAST(14 AS INTEGER) AS pri, 'CDC: ' || type || ' db=' || db || ' table=' || "table" || ' rows=' ||
  CASE WHEN kind IN ('INSERT', 'UPDATE', 'DELETE') THEN 1 ELSE 0 END || ' txn=' || txn AS message FROM J""")
def syslog(spark, sf):
    return records.syslog_records(derived_events(spark, sf), compact=True, facility="LOG_USER", priority="LOG_INFO")


@query("datagram_records", f"""WITH {J}
SELECT log_file, position, json || chr(10) AS packet, octet_length(encode(json)) + 1 AS bytes, 'sent' AS result FROM J
  WHERE octet_length(encode(json)) + 1 <= 300
UNION ALL SELECT log_file, position, json, octet_length(encode(json)) + 1, 'oversize' FROM J
  WHERE octet_length(encode(json)) + 1 > 300""")
def datagrams(spark, sf):
    sent, oversize = records.datagram_records(derived_events(spark, sf), 300)
    both = sent.withColumn("result", F.lit("sent")).unionByName(
        oversize.withColumnRenamed("json", "packet").withColumn("result", F.lit("oversize")))
    return both.withColumn("bytes", F.col("bytes").cast("bigint"))


@query("topic_messages", f"""WITH {J} SELECT log_file, position, db || '.' || "table" AS topic, json AS payload FROM J""")
def messages(spark, sf):
    return records.topic_messages(derived_events(spark, sf))


@query("audit_rows", f"""WITH {J}
SELECT file_no * 4294967296 + position AS id, ts AS event_time, txn AS txn_id, db AS source_db, "table" AS source_table,
  type AS event_type, log_file AS binlog_file, position AS binlog_position, json AS event_json FROM J""")
def audit(spark, sf):
    return records.audit_rows(derived_events(spark, sf))


@query("audit_lookups", f"""WITH {J},
M AS (SELECT txn FROM J WHERE txn IS NOT NULL ORDER BY file_no, position LIMIT 1 OFFSET 50)
SELECT 'txn' AS lookup, log_file AS binlog_file, position AS binlog_position FROM J WHERE txn = (SELECT txn FROM M)
UNION ALL SELECT 'table', log_file, position FROM J WHERE db = 'web' AND "table" = 'notes'
UNION ALL SELECT 'time', log_file, position FROM J WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-11 18:00:00'""")
def audit_lookups(spark, sf):
    """The three lookups of a stored audit table (K9)."""
    folder = f"{scratch_folder(spark)}/audit-{uuid.uuid4().hex}"
    write_audit(derived_events(spark, sf), "audit", folder)
    audit = spark.read.parquet(folder)
    txn = audit.where("txn_id <> ''").orderBy("id").offset(50).limit(1).first().txn_id
    found = [("txn", audit_lookup(audit, txn=txn)), ("table", audit_lookup(audit, db="web", table="notes")),
             ("time", audit_lookup(audit, datetime(2024, 1, 10, 6), datetime(2024, 1, 11, 18)))]
    parts = [rows.select(F.lit(name).alias("lookup"), "binlog_file", "binlog_position") for name, rows in found]
    return parts[0].union(parts[1]).union(parts[2])


def flaky_transport():
    """Answers 503 to the first ``position div 100 mod 6`` attempts of each message."""
    tries: dict[tuple, int] = {}

    def send(record):
        place = (record["log_file"], record["position"])
        tries[place] = tries.get(place, 0) + 1
        status = 503 if tries[place] <= record["position"] // 100 % 6 else 204
        if status == 204 or tries[place] > DEFAULT_RETRIES:
            del tries[place]
        return status

    return send


@query("webhook_deliver", f"""WITH {J}
SELECT log_file, position, 'webhook' AS publisher, position // 100 % 6 <= 3 AS ok, false AS dropped,
  CAST(least(position // 100 % 6, 3) + 1 AS INTEGER) AS attempts,
  CAST(CASE WHEN position // 100 % 6 <= 3 THEN 204 ELSE 503 END AS INTEGER) AS status,
  CASE WHEN position // 100 % 6 <= 3 THEN octet_length(encode(json)) ELSE 0 END AS bytes, CAST(NULL AS VARCHAR) AS error FROM J""")
def webhook(spark, sf):
    return webhook_deliver(derived_events(spark, sf), flaky_transport, backoff=0)


def batch_endpoint():
    """Answers a list of records, by their positions."""
    return lambda records: [204 if r["position"] // 100 % 6 <= 3 else 503 for r in records]


@query("committed_reports", f"""WITH {J}
SELECT 'hook' AS publisher, count(*) AS total, count(*) FILTER (position // 100 % 6 <= 3) AS published, CAST(0 AS BIGINT) AS dropped,
  count(*) FILTER (position // 100 % 6 > 3) AS errors, CAST(sum(octet_length(encode(json))) FILTER (position // 100 % 6 <= 3) AS BIGINT) AS bytes,
  count(*) FILTER (position // 100 % 6 <= 3) / count(*) AS success_rate FROM J""")
def committed(spark, sf):
    """Statistics over the reports that the delivery sink committed, after the same batch was written twice."""
    reports = f"{scratch_folder(spark)}/run-{uuid.uuid4().hex}"
    for _ in range(2):
        stored = deliver_batch(derived_events(spark, sf), "hook", "tidelog.plans.sink_queries:batch_endpoint", reports, batchSize=50, backoff=0.001)
    return delivery_stats(stored)


def reject_deletes(event):
    """Fails on deletes, raises on commits, and answers with a non-number otherwise."""
    if event["table"] == "COMMIT":
        raise RuntimeError("no commits")
    return 1 if '"type":"DELETE"' in event["json"] else "fine"


@query("python_sink", f"""WITH {J}
SELECT log_file, position, kind NOT IN ('DELETE', 'XID') AS ok, CAST(CASE kind WHEN 'DELETE' THEN 500 WHEN 'XID' THEN NULL ELSE 200 END AS INTEGER) AS status FROM J""")
def callback(spark, sf):
    return python_deliver(derived_events(spark, sf), reject_deletes).select("log_file", "position", "ok", "status")

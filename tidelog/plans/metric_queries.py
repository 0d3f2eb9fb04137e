"""Queries over counters, rates, lag and delivery statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.capture import capture_tables
from ..operators.filters import payload_status
from ..operators.routing import route
from ..operators.rows import explode_rows
from .derived_log import E, L, ROUTES, RULES, derived_events, derived_log, routes, rules
from .registry import query, table
from .routing_queries import MATCH
from .row_queries import M, mixed_documents

COUNTS = """count(*) AS total, count(*) FILTER (type = 'INSERT') AS inserts, count(*) FILTER (type = 'UPDATE') AS updates,
  count(*) FILTER (type = 'DELETE') AS deletes, count(*) FILTER (type = 'COMMIT') AS commits"""


def typed_log(spark, sf):
    return derived_log(spark, sf).withColumn("type", F.col("kind"))


@query("table_activity", f"""WITH {L}, {RULES}
SELECT L.db AS db, L."table" AS "table", count(*) AS total, count(*) FILTER (kind = 'INSERT') AS inserts,
  count(*) FILTER (kind = 'UPDATE') AS updates, count(*) FILTER (kind = 'DELETE') AS deletes
FROM L JOIN RULES r ON L.db = r.db AND L."table" = r."table" AND r.capture_dml GROUP BY ALL""")
def activity(spark, sf):
    rows = explode_rows(capture_tables(derived_log(spark, sf), rules(spark)))
    return metrics.event_counters(rows.withColumn("type", F.col("kind")), ["db", "table"]).drop("commits")


@query("event_counters", f"WITH {E} SELECT {COUNTS} FROM E")
def counters(spark, sf):
    return metrics.event_counters(derived_events(spark, sf))


@query("event_counters_by_table", f"""WITH {E} SELECT db, "table", {COUNTS} FROM E GROUP BY db, "table" """)
def counters_by_table(spark, sf):
    return metrics.event_counters(derived_events(spark, sf), ["db", "table"])


@query("event_rate", f"""WITH {L}, R AS (
  SELECT db, count(*) AS total, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration FROM L GROUP BY db)
SELECT db, total, duration, CASE WHEN duration > 0 THEN total / duration ELSE 0 END AS rate FROM R""")
def rate(spark, sf):
    return metrics.event_rate(derived_log(spark, sf), ["db"])


@query("table_counts", f"""WITH {L}, N AS (SELECT coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown') AS db_table FROM L)
SELECT db_table, count(*) AS events FROM N GROUP BY db_table UNION ALL SELECT 'TOTAL', count(*) FROM N""")
def counts(spark, sf):
    return metrics.table_counts(derived_log(spark, sf))


@query("affected_rows", f"""WITH {L}
SELECT db, "table", kind AS type, count(*) AS events,
  CAST(sum(CASE WHEN kind IN ('INSERT', 'UPDATE', 'DELETE') THEN 1 ELSE 0 END) AS BIGINT) AS rows
FROM L GROUP BY ALL""")
def affected(spark, sf):
    return metrics.affected_rows(typed_log(spark, sf))


@query("last_event", f"""WITH {L}
SELECT db, arg_max(kind, seq) AS type, arg_max(coalesce("table", '-'), seq) AS "table", arg_max(ts, seq) AS ts
FROM L GROUP BY db""")
def last(spark, sf):
    named = typed_log(spark, sf).withColumn("table", F.coalesce("table", F.lit("-")))
    return metrics.last_event(named, ["db"])


@query("last_event_overall", f"""WITH {L}
SELECT kind AS type, db, "table", ts FROM L ORDER BY seq DESC LIMIT 1""")
def last_overall(spark, sf):
    return metrics.last_event(typed_log(spark, sf))


@query("error_counts", f"""WITH {M}
SELECT count(*) AS total_received, count(*) FILTER (type IS NOT NULL OR log_file = 'text7') AS processed,
  count(*) FILTER (type IS NULL AND json = '') AS empty, count(*) FILTER (type IS NULL AND log_file <> 'text7') AS errors FROM M""")
def errors(spark, sf):
    return metrics.error_counts(mixed_documents(spark, sf).withColumn("status", payload_status("json")))


@query("received_total", f"WITH {L} SELECT count(*) AS received FROM L")
def received(spark, sf):
    return metrics.received_total(derived_log(spark, sf))


def offsets(spark, sf):
    """Hourly offset samples per topic and partition."""
    at = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    sampled = table(spark, sf, "events").groupBy(
        F.concat(F.lit("cdc."), "event_type").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"), at.alias("sampled_at"),
    ).agg(F.max("event_id").alias("end_offset"), F.count("*").alias("n"))
    committed = F.expr("case when end_offset % 5 = 0 then null when end_offset % 7 = 0 then end_offset + 3 "
                       "else end_offset - n * 10 end")
    return sampled.withColumn("committed", committed).drop("n")


LAG = """S AS (
  SELECT 'cdc.' || event_type AS topic, CAST(user_id % 8 AS INTEGER) AS partition, date_trunc('hour', ts) AS sampled_at,
    max(event_id) AS end_offset, count(*) AS n FROM events GROUP BY ALL),
O AS (SELECT * EXCLUDE n, CASE WHEN end_offset % 5 = 0 THEN NULL WHEN end_offset % 7 = 0 THEN end_offset + 3
        ELSE end_offset - n * 10 END AS committed FROM S),
P AS (SELECT *, lag(end_offset) OVER w AS prev_end, (epoch_us(sampled_at) - epoch_us(lag(sampled_at) OVER w)) / 1e6 AS dt
      FROM O WINDOW w AS (PARTITION BY topic, partition ORDER BY sampled_at)),
LAG AS (SELECT topic, partition, sampled_at, end_offset, committed,
  CASE WHEN committed IS NOT NULL THEN greatest(0, end_offset - committed) END AS lag,
  CASE WHEN dt > 0 THEN (end_offset - prev_end) / dt ELSE 0 END AS rate FROM P)"""


@query("partition_lag", f"WITH {LAG} SELECT * FROM LAG")
def lag(spark, sf):
    return metrics.lag_listing(metrics.partition_lag(offsets(spark, sf))).select(
        "topic", "partition", "sampled_at", "end_offset", "committed", "lag", "rate")


@query("lag_totals", f"""WITH {LAG}
SELECT sampled_at, CAST(coalesce(sum(lag), 0) AS BIGINT) AS total_lag, round(sum(greatest(rate, 0)), 6) AS total_rate
FROM LAG GROUP BY sampled_at""")
def totals(spark, sf):
    summed = metrics.lag_totals(metrics.partition_lag(offsets(spark, sf)))
    return summed.withColumn("total_rate", F.round("total_rate", 6))


def deliveries(spark, sf):
    """Delivery reports of the routed log, with some failures and drops."""
    routed = route(derived_log(spark, sf), routes(spark))
    return routed.selectExpr(
        "publisher", "log_file", "position", "seq % 11 <> 0 as ok", "seq % 33 = 0 as dropped",
        "1 as attempts", "200 as status", "position as bytes")


D = f"""{L}, {ROUTES}, D AS (
  SELECT publisher, log_file, position, seq % 11 <> 0 AS ok, seq % 33 = 0 AS dropped, position AS bytes
  FROM L JOIN ROUTES ON {MATCH})"""


@query("delivery_stats", f"""WITH {D}
SELECT publisher, count(*) AS total, count(*) FILTER (ok) AS published, count(*) FILTER (dropped) AS dropped,
  count(*) FILTER (NOT ok AND NOT dropped) AS errors, CAST(coalesce(sum(bytes) FILTER (ok), 0) AS BIGINT) AS bytes,
  count(*) FILTER (ok) / count(*) AS success_rate FROM D GROUP BY publisher""")
def delivered(spark, sf):
    return metrics.delivery_stats(deliveries(spark, sf))


@query("batch_success", f"""WITH {D}
SELECT publisher, log_file, bool_and(ok) AS success, count(*) FILTER (ok) AS succeeded, count(*) AS total
FROM D GROUP BY publisher, log_file""")
def batches(spark, sf):
    return metrics.batch_success(deliveries(spark, sf), ["publisher", "log_file"])


def without_zone(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("windowed_counters", f"""WITH {L}
SELECT time_bucket(INTERVAL 5 SECONDS, ts) AS window_start,
  time_bucket(INTERVAL 5 SECONDS, ts) + INTERVAL 5 SECONDS AS window_end, {COUNTS.replace("type", "kind")} FROM L GROUP BY ALL""")
def windowed(spark, sf):
    return without_zone(metrics.windowed_counters(typed_log(spark, sf)))


@query("sliding_counters", f"""WITH {L}, S AS (
  SELECT kind, time_bucket(INTERVAL 30 MINUTES, ts) - unnest([INTERVAL 0 MINUTES, INTERVAL 30 MINUTES]) AS s FROM L)
SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, {COUNTS.replace("type", "kind")}
FROM S GROUP BY ALL""")
def sliding(spark, sf):
    return without_zone(metrics.windowed_counters(typed_log(spark, sf), "1 hour", "30 minutes"))

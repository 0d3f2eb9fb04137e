"""Queries that run keyed state over streams in several batches, with a restart between each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.capture import flag_captured
from ..sources.position_index import read_from
from ..streaming.live import LiveMetrics, observe_events
from ..streaming.keyed import assign_txn_sources, pack_rows_stream, partition_lag_stream, windowed_counters_stream
from ..streaming.pipeline import assign_txn_stream
from .derived_log import L, T, log_of, rules
from .metric_queries import COUNTS, LAG, offsets
from .registry import query, table
from .stream_queries import work_folder

CHUNKS = 4


def chunk_of(events, number: str):
    """Which of CHUNKS chunks of neighbouring events a row is in."""
    size = events.agg(F.max(number)).first()[0] + 1
    return F.least(F.expr(f"{number} * {CHUNKS} div {size}"), F.lit(CHUNKS - 1))


def run_in_chunks(spark, rows, chunk, transform, order=range(CHUNKS)):
    """What a stream writes when the chunks of ``rows`` arrive one by one and the query restarts for each."""
    work = work_folder(spark)
    for k in order:
        rows.where(chunk == k).coalesce(2).write.mode("append").parquet(f"{work}/in")
        found = transform(spark.readStream.schema(rows.schema).parquet(f"{work}/in"))
        writer = found.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint")
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{work}/out")


SOURCES = T.replace("(ORDER BY seq", "(PARTITION BY seq % 3 ORDER BY seq").replace("'log|at|'", "'s' || seq % 3 || '|at|'").replace(
    "'log|' ||", "'s' || seq % 3 || '|' ||")


@query("txn_many_sources", f"""WITH {SOURCES}
SELECT 's' || seq % 3 AS source, log_file, position, kind, txn, in_txn, map_db FROM T""")
def many_sources(spark, sf):
    """Three interleaved sources in one query with state per source."""
    events = table(spark, sf, "events")

    def transform(stream):
        log = log_of(stream).withColumn("source", F.concat(F.lit("s"), (F.col("seq") % 3).cast("string")))
        assigned = assign_txn_sources(flag_captured(log, rules(spark)))
        return assigned.select("source", "log_file", "position", "kind", "txn", "in_txn", "map_db")

    return run_in_chunks(spark, events, chunk_of(events, "event_id"), transform)


LATE = 6 * 3600


@query("late_windows", f"""WITH {L},
A AS (SELECT kind AS type, ts, time_bucket(INTERVAL 1 HOUR, ts) AS s, [0, 2, 1, 3][1 + CAST(least(seq * 4 // (SELECT max(event_id) + 1 FROM events), 3) AS INTEGER)] AS batch FROM L),
M AS (SELECT batch, max(epoch_us(ts)) // 1000 AS top FROM A GROUP BY batch),
W AS (SELECT b.batch, coalesce(max(e.top) - {LATE * 1000}, 0) AS mark FROM (SELECT DISTINCT batch FROM A) b LEFT JOIN M e ON e.batch < b.batch GROUP BY b.batch),
F AS (SELECT max(top) - {LATE * 1000} AS mark FROM M),
R AS (SELECT A.*, epoch_us(s) // 1000 + 3600000 <= W.mark AS late FROM A JOIN W USING (batch))
SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, late, {COUNTS} FROM R
WHERE late OR epoch_us(s) // 1000 + 3600000 <= (SELECT mark FROM F) GROUP BY ALL""")
def late_windows(spark, sf):
    """Hourly counters of a stream whose second quarter arrives after its third (Z3): closed windows, and late rows apart."""
    events = table(spark, sf, "events")

    def transform(stream):
        return windowed_counters_stream(log_of(stream).withColumn("type", F.col("kind")), 3600, f"{LATE} seconds")

    parts = run_in_chunks(spark, events, chunk_of(events, "event_id"), transform, order=(0, 2, 1, 3))
    counters = ["total", "inserts", "updates", "deletes", "commits"]
    whole = parts.groupBy("window_start", "window_end", "late").agg(*[F.sum(c).alias(c) for c in counters])
    return whole.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_from_mark", f"""WITH {L}
SELECT log_file, position, kind FROM L WHERE file_no > 1 OR (file_no = 1 AND position > 50004)""")
def stream_from_mark(spark, sf):
    """A log stream that starts after a place and restarts."""
    events = table(spark, sf, "events")
    work = work_folder(spark)

    def handle(assigned, batch_id):
        assigned.select("log_file", "position", "kind").write.mode("overwrite").parquet(f"{work}/out/batch={batch_id}")

    half = events.agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("m")).first().m
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        events.where(part).write.mode("append").parquet(f"{work}/log")
        log = log_of(spark.readStream.schema(events.schema).parquet(f"{work}/log"))
        assign_txn_stream(log, rules(spark), f"{work}/checkpoint", handle, start=("000001", 50004)).awaitTermination()
    return spark.read.parquet(f"{work}/out").drop("batch")


@query("read_from_index", f"""WITH {L}
SELECT log_file, count(*) AS events FROM L WHERE file_no > 1 OR (file_no = 1 AND position > 50004) GROUP BY log_file""")
def read_from_index(spark, sf):
    """Events after a place, from the data files that the position index names."""
    log = f"{work_folder(spark)}/log"
    derived = log_of(table(spark, sf, "events")).select("log_file", "position", "kind")
    derived.repartitionByRange(16, "log_file", "position").write.parquet(log)
    return read_from(spark, log, checkpoint="000001\n50004\n").groupBy("log_file").agg(F.count("*").alias("events"))


@query("lag_stream", f"WITH {LAG} SELECT * FROM LAG")
def lag_stream(spark, sf):
    """Lag of offset samples that arrive in chunks."""
    samples = offsets(spark, sf)
    found = run_in_chunks(spark, samples, chunk_of(samples, "end_offset"), partition_lag_stream)
    return found.withColumn("sampled_at", F.col("sampled_at").cast("timestamp_ntz"))


@query("live_metrics", f"""WITH {L} SELECT metric, value FROM (
  UNPIVOT (SELECT count(*) AS received, count(*) FILTER (kind = 'INSERT') AS inserts, count(*) FILTER (kind = 'UPDATE') AS updates,
             count(*) FILTER (kind = 'DELETE') AS deletes, count(*) FILTER (kind = 'COMMIT') AS commits FROM L) ON COLUMNS(*) INTO NAME metric VALUE value)""")
def live_metrics(spark, sf):
    """What a listener kept of a stream's observations over several batches."""
    events, work, live = table(spark, sf, "events"), work_folder(spark), LiveMetrics()
    events.repartition(3).write.parquet(f"{work}/in")
    stream = log_of(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{work}/in")).withColumn("type", F.col("kind"))
    live.attach(spark)
    try:
        writer = observe_events(stream).select("seq").writeStream.format("parquet").option("path", f"{work}/out")
        running = writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
        running.awaitTermination()
        live.wait_for_end(str(running.id))
    finally:
        spark.streams.removeListener(live)
    return live.table(spark).groupBy("metric").agg(F.sum("value").alias("value"))


@query("pack_rows_stream", """SELECT event_id // 7 AS position, (event_id % 7) // 3 AS chunk, CAST(count(*) AS INTEGER) AS n_rows,
  max(event_id % 7 = 6 OR event_id = (SELECT max(event_id) FROM events)) AS last_chunk, string_agg(user_id || ':' || event_type, ',' ORDER BY event_id) AS members
FROM events GROUP BY event_id // 7, (event_id % 7) // 3""")
def packed_stream(spark, sf):
    """Statements of seven rows that arrive in chunks of the log and are cut by their borders (P5)."""
    events = table(spark, sf, "events")
    last = events.agg(F.max("event_id")).first()[0]

    def transform(stream):
        changes = stream.selectExpr(
            "'000001' as log_file", "event_id div 7 as position", "'INSERT' as kind", "'web' as db", "'visits' as `table`", "event_id % 7 as row_no",
            "map('user', cast(user_id as variant), 'type', cast(event_type as variant)) as row", f"event_id % 7 = 6 or event_id = {last} as last_row")
        return pack_rows_stream(changes, 3)

    # The files keep variants as they are; members are read from them.
    found = run_in_chunks(spark, events, chunk_of(events, "event_id"), transform)
    members = F.transform("rows", lambda r: F.concat(r["user"].cast("string"), F.lit(":"), r["type"].cast("string")))
    return found.select("position", "chunk", F.size("rows").alias("n_rows"), "last_chunk", F.array_join(members, ",").alias("members"))

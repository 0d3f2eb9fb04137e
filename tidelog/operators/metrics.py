"""Counters, rates, lag and delivery statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .order import file_no, time_slices, with_carry

# --- Fixed values: counter names and the event type each one counts ----------
COUNTERS = {"inserts": "INSERT", "updates": "UPDATE", "deletes": "DELETE", "commits": "COMMIT"}


def _counter_columns() -> list[Column]:
    kind = F.upper("type")
    return [F.count("*").alias("total"), *[F.count_if(kind == t).alias(n) for n, t in COUNTERS.items()]]


def event_counters(ev: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total, inserts, updates, deletes and commits; other types count in the total."""
    return ev.groupBy(*(by or [])).agg(*_counter_columns())


def windowed_counters(ev: DataFrame, size: str = "5 seconds", slide: str | None = None,
                      ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """The counters per time window, batch or streaming."""
    stamped = ev.withColumn("_ts", F.col(ts).cast("timestamp"))
    if watermark:
        stamped = stamped.withWatermark("_ts", watermark)
    grouped = stamped.groupBy(F.window("_ts", size, slide).alias("_w")).agg(*_counter_columns())
    return grouped.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "total", *COUNTERS)


def _seconds(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1000000.0)


def event_rate(ev: DataFrame, by: list[str] | None = None, ts: str = "ts") -> DataFrame:
    """Events per second between the first and the last event, 0 for no duration."""
    span = ev.groupBy(*(by or [])).agg(F.count("*").alias("total"), F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    duration = _seconds(F.col("_b"), F.col("_a"))
    return span.select(
        *(by or []), "total", duration.alias("duration"),
        F.when(duration > 0, F.col("total") / duration).otherwise(F.lit(0.0)).alias("rate"),
    )


def table_counts(ev: DataFrame) -> DataFrame:
    """Events per ``db.table`` (``unknown`` for a missing name) and the grand total."""
    unknown = F.lit("unknown")
    keyed = ev.select(F.concat_ws(".", F.coalesce("db", unknown), F.coalesce("table", unknown)).alias("db_table"))
    return keyed.rollup("db_table").agg(F.count("*").alias("events")).select(
        F.coalesce("db_table", F.lit("TOTAL")).alias("db_table"), "events")


def rows_per_event(rows: Column | str = "rows") -> Column:
    return F.coalesce(F.size(rows), F.lit(0))


def affected_rows(ev: DataFrame) -> DataFrame:
    """Events and rows per database, table and type."""
    return ev.groupBy("db", "table", "type").agg(
        F.count("*").alias("events"), F.sum(rows_per_event()).alias("rows"))


def last_event(ev: DataFrame, by: list[str] | None = None, ts: str = "ts") -> DataFrame:
    """The latest event in log order, overall or per group.

    The latest place is one number, so it is found by a hash aggregate that combines
    before the shuffle; the event itself is then looked up by it.
    """
    by = by or []
    keep = [c for c in ("type", "db", "table", ts) if c not in by]
    place = (file_no().cast("decimal(19,0)") * F.expr("9223372036854775808BD") + F.col("position")).cast("decimal(38,0)")
    placed = ev.select(*by, *keep, place.alias("_place"))
    latest = placed.groupBy(*by).agg(F.max("_place").alias("_latest")).select(*[F.col(c).alias(f"_{c}") for c in by], "_latest")
    same = F.col("_place") == F.col("_latest")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    found = placed.join(latest, same).select(*by, *keep)
    return found.dropDuplicates(by) if by else found.limit(1)


def error_counts(raw: DataFrame, status: str = "status") -> DataFrame:
    """Received documents and errors, where empty payloads are errors too."""
    return raw.agg(
        F.count("*").alias("total_received"),
        F.count_if(F.col(status) == "ok").alias("processed"),
        F.count_if(F.col(status) == "empty").alias("empty"),
        F.count_if(F.col(status) != "ok").alias("errors"),
    )


def delivery_stats(deliveries: DataFrame) -> DataFrame:
    """Published, dropped, errors, bytes sent and success rate per publisher."""
    ok = F.col("ok")
    return deliveries.groupBy("publisher").agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("published"),
        F.count_if("dropped").alias("dropped"),
        F.count_if(~ok & ~F.col("dropped")).alias("errors"),
        F.coalesce(F.sum(F.when(ok, F.col("bytes"))), F.lit(0).cast("bigint")).alias("bytes"),
        (F.count_if(ok) / F.count("*")).alias("success_rate"),
    )


def batch_success(deliveries: DataFrame, by: list[str]) -> DataFrame:
    """Whether every item of a batch succeeded, and how many did."""
    return deliveries.groupBy(*by).agg(
        F.every("ok").alias("success"), F.count_if("ok").alias("succeeded"), F.count("*").alias("total"))


def partition_lag(offsets: DataFrame, slice_seconds: int = 86400, tie: list[str] | None = None) -> DataFrame:
    """Lag and rate of every sample of every partition.

    ``lag = max(0, end - committed)``, null without a committed offset;
    ``rate`` is the offsets gained per second since the previous sample of the
    partition, 0 for its first sample or when no time has passed.

    Samples are ordered inside (topic, partition, time slice), so one partition
    that holds most samples is still spread over many tasks; the previous
    sample of a slice's first row comes from a carry.
    """
    at = F.col("sampled_at")
    carried = with_carry(
        offsets,
        time_slices(["topic", "partition"], "sampled_at", slice_seconds, tie),
        last={"_prev_end": F.col("end_offset"), "_prev_us": F.unix_micros(at.cast("timestamp"))},
    )
    dt = (F.unix_micros(at.cast("timestamp")) - F.col("_prev_us")) / F.lit(1000000.0)
    return carried.withColumns({
        "lag": F.when(F.col("committed").isNotNull(),
                      F.greatest(F.lit(0).cast("bigint"), F.col("end_offset") - F.col("committed"))),
        "rate": F.when(dt > 0, (F.col("end_offset") - F.col("_prev_end")) / dt).otherwise(F.lit(0.0)),
    }).drop("_prev_end", "_prev_us")


def lag_listing(lag: DataFrame) -> DataFrame:
    """Lag rows in report order."""
    return lag.orderBy("sampled_at", "topic", "partition")


def lag_totals(lag: DataFrame) -> DataFrame:
    """Total lag (known ones) and total non-negative rate per sample time."""
    return lag.groupBy("sampled_at").agg(
        F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("total_lag"),
        F.sum(F.greatest("rate", F.lit(0.0))).alias("total_rate"),
    )


def received_total(raw: DataFrame) -> DataFrame:
    """Events received, including those that are filtered out later."""
    return raw.agg(F.count("*").alias("received"))

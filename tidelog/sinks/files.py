"""File, table and console sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.order import Slices, event_sequence, file_no
from .records import audit_rows

# --- Fixed value: rotated files kept by default --------------------------------
DEFAULT_MAX_FILES = 5


def rotation_plan(ev: DataFrame, max_events: int, max_files: int = DEFAULT_MAX_FILES,
                  slices: Slices | None = None) -> DataFrame:
    """Add ``segment`` (from 0), ``suffix`` (null = active file, 0 = newest rotated) and ``kept``.

    A file is rotated before the write that would exceed ``max_events``; the last
    ``max_files`` rotated files stay next to the active one.
    """
    if max_events < 1:
        raise ValueError("rotation needs max_events of at least 1")
    # The number of events comes with the numbering, from the sums of its slices: the log is not read for it.
    numbered = event_sequence(ev, slices, "_rn", totals=True)
    segment = F.expr(f"(_rn - 1) div {max_events}")
    suffix = F.expr(f"(_rn_total - 1) div {max_events}") - 1 - F.col("segment")
    return (
        numbered.withColumn("segment", segment)
        .withColumn("suffix", F.when(suffix >= 0, suffix))
        .withColumn("kept", F.col("suffix").isNull() | (F.col("suffix") < max(1, max_files)))
        .drop("_rn", "_rn_total")
    )


def write_jsonl(ev: DataFrame, path: str, max_events: int = 0, max_files: int = DEFAULT_MAX_FILES,
                mode: str = "overwrite") -> None:
    """One document per line, in log order.

    Without rotation: range-partitioned part files whose names sort in log order.
    With rotation: one ``segment=N`` folder per kept segment.
    """
    place = [file_no(), F.col("position")]
    if max_events <= 0:
        ordered = ev.repartitionByRange(*place).sortWithinPartitions(*place)
        ordered.select("json").write.mode(mode).text(path)
        return
    plan = rotation_plan(ev, max_events, max_files).where("kept")
    # The order key is part of the range, so a large segment is still split.
    ordered = plan.repartitionByRange("segment", *place).sortWithinPartitions("segment", *place)
    ordered.select("segment", "json").write.mode(mode).partitionBy("segment").text(path)


# Progress records are reused in turn; a replay never goes back further than one batch.
PROGRESS_SLOTS = 100


def _written(spark: SparkSession, path: str, batch_id: int) -> int:
    """Events written up to and including a batch; 0 before the first."""
    if batch_id < 0:
        return 0
    saved = spark.read.schema("batch BIGINT, total BIGINT").parquet(f"{path}/_progress/{batch_id % PROGRESS_SLOTS}").first()
    if saved is None or saved.batch != batch_id:
        raise RuntimeError(f"no record of batch {batch_id} in {path}")
    return saved.total


def _remove_segments(spark: SparkSession, path: str, below: int) -> None:
    """Delete rotated files that are no longer kept, on whatever file system they are."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("segment=") and int(name.partition("=")[2]) < below:
            fs.delete(status.getPath(), True)


def append_jsonl(ev: DataFrame, path: str, batch_id: int, max_events: int, max_files: int = DEFAULT_MAX_FILES) -> None:
    """Rotation that goes on from batch to batch of a stream.

    Events are numbered on from the previous batch and land in
    ``segment=N/batch=B``; segments beyond the last ``max_files`` rotated ones are
    neither written nor kept.  A repeated batch replaces its own files.
    """
    spark, path = ev.sparkSession, path.rstrip("/")
    before = _written(spark, path, batch_id - 1)
    total = before + ev.count()
    oldest = max(total - 1, 0) // max_events - max(1, max_files)
    place = [file_no(), F.col("position")]
    kept = (
        event_sequence(ev, name="_rn", start=before)
        .withColumn("segment", F.expr(f"(_rn - 1) div {max_events}"))
        .where(F.col("segment") >= oldest)
        .withColumn("batch", F.lit(batch_id))
    )
    ordered = kept.repartitionByRange("segment", *place).sortWithinPartitions("segment", *place)
    (
        ordered.select("segment", "batch", "json").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("segment", "batch").text(path)
    )
    progress = spark.createDataFrame([(batch_id, total)], "batch BIGINT, total BIGINT")
    progress.coalesce(1).write.mode("overwrite").parquet(f"{path}/_progress/{batch_id % PROGRESS_SLOTS}")
    _remove_segments(spark, path, oldest)


# Rows inside a file are in this order, so that its row groups' smallest and largest values tell them apart.
AUDIT_ORDER = ["event_date", "source_db", "source_table", "event_time"]


def write_audit(ev: DataFrame, table: str, path: str | None = None, ts: str | None = "ts", row_group_bytes: int | None = None) -> None:
    """Append to the audit table, partitioned by day and database.

    With ``path`` the table is a folder of Parquet files, else a catalog table. It is laid out for
    its three lookups: by time (days and sorted times), by (database, table) (partitions and sorted
    names) and by transaction (a Bloom filter in every row group), see :func:`audit_lookup`.
    """
    rows = audit_rows(ev, ts).withColumn("event_date", F.to_date("event_time"))
    rows = rows.repartitionByRange(*AUDIT_ORDER).sortWithinPartitions(*AUDIT_ORDER)
    writer = rows.write.mode("append").partitionBy("event_date", "source_db").option("parquet.bloom.filter.enabled#txn_id", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    if path:
        writer.format("parquet").save(path)
    else:
        writer.saveAsTable(table)


def audit_lookup(audit: DataFrame, since=None, until=None, db: str | None = None, table: str | None = None, txn: str | None = None) -> DataFrame:
    """Rows of an audit table by time (``since`` inclusive, ``until`` exclusive), database and table, or transaction.

    Every condition reaches the scan: days and databases choose folders, the others row groups by their statistics or Bloom filters.
    """
    if since is not None:
        audit = audit.where((F.col("event_date") >= F.to_date(F.lit(since))) & (F.col("event_time") >= F.lit(since)))
    if until is not None:
        audit = audit.where((F.col("event_date") <= F.to_date(F.lit(until))) & (F.col("event_time") < F.lit(until)))
    for name, value in (("source_db", db), ("source_table", table), ("txn_id", txn)):
        if value is not None:
            audit = audit.where(F.col(name) == value)
    return audit


def write_audit_jdbc(ev: DataFrame, url: str, table: str, properties: dict[str, str], ts: str | None = "ts") -> None:
    """Append to an audit table in a database; rows beyond any statement size are fine."""
    audit_rows(ev, ts).write.jdbc(url, table, mode="append", properties=properties)


def write_kafka(records: DataFrame, servers: str, compression: str = "snappy", batch_bytes: int = 262144,
                linger_ms: int = 10, delivery_timeout_ms: int = 120_000, **options: str) -> None:
    """Kafka records to their topics; needs Spark's Kafka connector on the class path.

    Spark's producer counts a batch in bytes (``batch.size``) and waits for each record up to
    ``delivery.timeout.ms`` before the write fails, which also covers the flush at the end.
    """
    (
        records.select("topic", "key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", compression)
        .option("kafka.batch.size", str(batch_bytes))
        .option("kafka.linger.ms", str(linger_ms))
        .option("kafka.delivery.timeout.ms", str(delivery_timeout_ms))
        .options(**options)
        .save()
    )


def write_console(ev: DataFrame, rows: int = 20):
    """Start a console query for a stream, or print a table."""
    if ev.isStreaming:
        return ev.writeStream.format("console").option("numRows", rows).option("truncate", "false").start()
    ev.show(rows, truncate=False)
    return None

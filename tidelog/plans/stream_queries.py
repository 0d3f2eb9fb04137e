"""Queries that run a stream to its end and return what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_folder
from ..sinks.builtin import FilePublisher
from ..sources.change_log import parse_change_log, read_change_stream
from ..streaming.pipeline import assign_txn_stream, run_pipeline
from .derived_log import J, T, derived_events, log_of, routes, rules
from .registry import query, table


def work_folder(spark) -> str:
    """A new folder below the shared one."""
    return f"{scratch_folder(spark)}/run-{uuid.uuid4().hex}"


@query("txn_assign_stream", f"""WITH {T} SELECT log_file, position, kind, txn, in_txn, map_db FROM T""")
def txn_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    folder = work_folder(spark)
    out = f"{folder}/out"

    def handle(assigned, batch_id):
        kept = assigned.select("log_file", "position", "kind", "txn", "in_txn", "map_db")
        kept.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    assign_txn_stream(log_of(events), rules(spark), f"{folder}/checkpoint", handle).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query("text_stream", f"""WITH {J} SELECT kind, type, txn, db, "table", 'ok' AS status FROM J""")
def text_stream(spark, sf):
    """Documents as lines of several files, read as a stream of one file a batch."""
    folder = work_folder(spark)
    derived_events(spark, sf).select("json").repartition(3).write.text(f"{folder}/lines")
    stream = read_change_stream(spark, f"{folder}/lines", max_files_per_trigger=1)
    writer = stream.select("kind", "type", "txn", "db", "table", "status").writeStream.format("parquet")
    writer = writer.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("pipeline_to_files", f"""WITH {J} SELECT type, txn, db, "table", 'ok' AS status FROM J""")
def pipeline_to_files(spark, sf):
    """Log to files: half of the log, then a restart with the rest; transactions go on across it."""
    folder, events = work_folder(spark), table(spark, sf, "events")
    middle = events.agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("m")).first().m
    publisher = FilePublisher("broker")
    publisher.init({"file_path": f"{folder}/files"})
    for half in (F.col("event_id") <= middle, F.col("event_id") > middle):
        events.where(half).write.mode("append").parquet(f"{folder}/log")
        stream = log_of(spark.readStream.schema(events.schema).parquet(f"{folder}/log"))
        only = routes(spark).where("publisher = 'broker'")
        run_pipeline(stream, rules(spark), only, {"broker": publisher}, f"{folder}/checkpoint").awaitTermination()
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/files").withColumnRenamed("value", "json")
    return parse_change_log(lines).select("type", "txn", "db", "table", "status")

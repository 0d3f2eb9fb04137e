"""Streams against batches over the same files, including restarts."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from test_order_and_txn import TINY, frame, random_log
from tidelog.operators import metrics
from tidelog.operators.txn import assign_txn
from tidelog.plans.change_events import change_events
from tidelog.plans.derived_log import derived_log, log_of, routes, rules
from tidelog.sinks.deliver import PythonSink
from tidelog.sinks.publisher import EventPublisher, Publisher, health
from tidelog.sources.change_log import read_change_stream
from tidelog.streaming.pipeline import assign_txn_stream, drain_and_stop, run_pipeline

RULE_SCHEMA = ("db STRING, capture_dml BOOLEAN, capture_ddl BOOLEAN, `table` STRING, primary_key ARRAY<STRING>, "
               "all_columns BOOLEAN, columns ARRAY<STRING>")


def add_file(spark, entries, folder):
    frame(spark, entries).drop("captured").coalesce(1).write.mode("append").parquet(folder)


class Saving(Publisher):
    """Writes each batch under its id, so a repeated batch replaces itself."""

    name = "saving"

    def __init__(self, folder):
        self.folder, self.state = folder, []

    def init(self, options):
        pass

    def start(self):
        self.state.append("start")

    def publish_batch(self, batch, batch_id):
        batch.select("log_file", "position", "txn", "db", "table", "json").write.mode("overwrite").parquet(
            f"{self.folder}/batch={batch_id}")

    def stop(self):
        self.state.append("stop")


def test_stream_equals_batch_across_restarts(spark, tmp_path):
    entries = random_log(21, n=240)
    source, out, check = (str(tmp_path / n) for n in ("log", "out", "check"))
    only_a = spark.createDataFrame([("a", True, True, "t", [], True, [])], RULE_SCHEMA)
    calls = []

    def handle(assigned, batch_id):
        calls.append(batch_id)
        assigned.select("seq", "txn", "in_txn", "map_db").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for at in range(0, 240, 60):  # four runs, each resuming from the checkpoint
        add_file(spark, entries[at:at + 60], source)
        schema = spark.read.parquet(source).schema
        log = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(source)
        assign_txn_stream(log, only_a, check, handle, slices=TINY).awaitTermination()
    assert calls == [0, 1, 2, 3]

    whole = frame(spark, entries).drop("captured").withColumn(
        "captured", F.coalesce((F.col("db") == "a") & (F.col("table") == "t"), F.lit(False)))
    want = assign_txn(whole, slices=TINY).select("seq", "txn", "in_txn", "map_db")
    got = spark.read.parquet(out).drop("batch")
    assert sorted(got.collect()) == sorted(want.collect())


def test_replayed_batch_gives_the_same_ids(spark, tmp_path):
    entries = random_log(4, n=120)
    source, check = str(tmp_path / "log"), str(tmp_path / "check")
    add_file(spark, entries[:60], source)
    only_a = spark.createDataFrame([("a", True, True, "t", [], True, [])], RULE_SCHEMA)
    seen = []

    def handle(assigned, batch_id):
        seen.append((batch_id, sorted(r.txn or "" for r in assigned.collect())))
        if batch_id == 1 and len(seen) == 2:
            raise RuntimeError("executor lost")

    def run():
        log = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        assign_txn_stream(log, only_a, check, handle, slices=TINY).awaitTermination()

    run()
    add_file(spark, entries[60:], source)
    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    assert [b for b, _ in seen] == [0, 1, 1] and seen[1][1] == seen[2][1]


def test_late_file_is_an_error(spark, tmp_path):
    entries = random_log(4, n=90)
    source, check = str(tmp_path / "log"), str(tmp_path / "check")
    only_a = spark.createDataFrame([("a", True, True, "t", [], True, [])], RULE_SCHEMA)

    def run():
        log = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        assign_txn_stream(log, only_a, check, lambda assigned, batch_id: None, slices=TINY).awaitTermination()

    add_file(spark, entries[30:], source)
    run()
    add_file(spark, entries[:30], source)
    with pytest.raises(Exception, match="out of order"):
        run()


def test_whole_stream_to_publishers(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    source = str(tmp_path / "events")
    for at in range(0, 1000, 500):
        events.where(f"event_id >= {at} and event_id < {at + 500}").coalesce(1).write.mode("append").parquet(source)
    saving = Saving(str(tmp_path / "out"))
    outcomes = []
    stream = log_of(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(source))
    query = run_pipeline(stream, rules(spark), routes(spark).where("publisher = 'broker'"), {"broker": saving}, str(tmp_path / "check"),
                         on_outcomes=outcomes.extend)
    query.awaitTermination()
    state = health(query, {"broker": saving})
    assert state["publishers"] == {"broker": True} and state["received"] >= 1000 and not state["failed"]
    drain_and_stop(query, {"broker": saving})
    assert saving.state == ["start", "stop"] and [o.ok for o in outcomes] == [True, True]
    want = change_events(derived_log(spark, sf), rules(spark)).select("log_file", "position", "txn", "db", "table", "json")
    assert sorted(spark.read.parquet(saving.folder).drop("batch").collect()) == sorted(want.collect())


def test_failed_publisher_stops_the_checkpoint(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.coalesce(1).write.parquet(str(tmp_path / "events"))

    class Broken(Saving):
        def publish_batch(self, batch, batch_id):
            raise RuntimeError("broker down")

    def run(broker, **options):
        stream = log_of(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")))
        outcomes = []
        query = run_pipeline(stream, rules(spark), routes(spark).where("publisher in ('files', 'broker')"), {"files": Saving(str(tmp_path / "files")), "broker": broker},
                             str(tmp_path / "check"), on_outcomes=outcomes.extend, **options)
        return query, outcomes

    query, outcomes = run(Broken(""))
    with pytest.raises(Exception, match="broker down"):
        query.awaitTermination()
    assert [(o.publisher, o.ok) for o in outcomes] == [("files", True), ("broker", False)]
    query, outcomes = run(Saving(str(tmp_path / "broker")))
    query.awaitTermination()
    assert [(o.batch_id, o.ok) for o in outcomes] == [(0, True), (0, True)]
    assert spark.read.parquet(str(tmp_path / "broker")).count() == change_events(derived_log(spark, sf), rules(spark)).count()


def test_failed_records_repeat_the_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    only = routes(spark).where("publisher = 'broker'")

    class PerEvent(EventPublisher):
        name = "broker"

        def __init__(self, up):
            self.up = up

        def init(self, options):
            pass

        def publish(self, event):
            return 0 if self.up or event["position"] % 3 else 1

    def run(broker):
        stream = log_of(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")))
        outcomes = []
        return run_pipeline(stream, rules(spark), only, {"broker": broker}, str(tmp_path / "check"), on_outcomes=outcomes.extend), outcomes

    query, outcomes = run(PerEvent(False))
    with pytest.raises(Exception, match="records failed"):
        query.awaitTermination()
    assert outcomes[0].failed > 0 and outcomes[0].delivered > 0
    query, outcomes = run(PerEvent(True))
    query.awaitTermination()
    total = change_events(derived_log(spark, sf), rules(spark)).count()
    assert [(o.batch_id, o.ok, o.delivered) for o in outcomes] == [(0, True, total)]
    report = spark.read.parquet(str(tmp_path / "check" / "deliveries" / "batch=0" / "sender=broker"))
    assert report.count() == report.where("ok").count() == total
    with pytest.raises(ValueError, match="broker"):
        run_pipeline(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")), rules(spark), only, {}, str(tmp_path / "no"))


def test_text_stream_and_windowed_counters(spark, sf, tmp_path):
    lines = change_events(derived_log(spark, sf), rules(spark))
    lines.select("json").coalesce(1).write.text(str(tmp_path / "lines"))
    parsed = read_change_stream(spark, str(tmp_path / "lines"), max_files_per_trigger=1)
    counted = metrics.event_counters(parsed, ["type"])
    query = counted.writeStream.outputMode("complete").format("memory").queryName("by_type").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.type: r.total for r in spark.table("by_type").collect()}
    assert got == {r.type: r["count"] for r in lines.groupBy("type").count().collect()}

    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("type", F.upper("event_type"))
    events.coalesce(1).write.parquet(str(tmp_path / "timed"))
    timed = spark.readStream.schema(events.schema).parquet(str(tmp_path / "timed"))
    windows = metrics.windowed_counters(timed, "1 hour", watermark="10 minutes")
    query = windows.writeStream.outputMode("append").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = {r.window_start: r.total for r in metrics.windowed_counters(events, "1 hour").collect()}
    closed = {r.window_start: r.total for r in spark.table("windows").collect()}
    # In append mode only windows older than the watermark are final.
    assert len(closed) >= len(batch) - 2 and all(batch[k] == v for k, v in closed.items())


def test_foreach_callback(spark, sf, tmp_path):
    lines = change_events(derived_log(spark, sf), rules(spark)).select("log_file", "position", "txn", "db", "table", "json")
    lines.coalesce(1).write.parquet(str(tmp_path / "in"))
    (tmp_path / "seen").mkdir()

    class Script:
        """Records what it saw in files, since tasks run in other processes."""

        def __init__(self, folder):
            self.folder = folder

        def on_event(self, event):
            with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(event["json"])
            return 0

    stream = spark.readStream.schema(lines.schema).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreach(PythonSink(Script(str(tmp_path / "seen")))).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(glob.glob(f"{tmp_path}/seen/*")) == lines.count()
    with pytest.raises(ValueError, match="handle"):
        PythonSink(object(), on_event="handle")

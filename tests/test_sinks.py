"""Files, tables, delivery and the publisher contract, with fake transports."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tidelog.operators import metrics
from tidelog.operators.order import log_slices
from tidelog.sinks import deliver, files, records
from tidelog.sinks.publisher import EventPublisher, Publisher, backlog_healthy, publish, validate
from tidelog.sources.change_log import read_change_log


@pytest.fixture()
def ev(spark):
    return spark.range(25).selectExpr(
        "cast(id as int) as n", "concat('f.', lpad(cast(id div 10 + 1 as string), 6, '0')) as log_file",
        "4 + (id % 10) * 100 as position", "'t' as txn", "if(id % 2 = 0, 'a', 'b') as db", "'t' as `table`", "'INSERT' as type",
        "concat('{\"type\":\"INSERT\",\"db\":\"a\",\"rows\":[{\"n\":', id, '}]}') as json",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,cast(id div 20 as int)) as ts").repartition(4)


def numbers(path):
    """Event numbers per part file, files in name order."""
    return [[json.loads(line)["rows"][0]["n"] for line in open(f)] for f in sorted(glob.glob(path))]


def test_rotation_plan(ev):
    plan = files.rotation_plan(ev, 10, 1, log_slices(200, 2)).orderBy("n").collect()
    assert [r.segment for r in plan] == [0] * 10 + [1] * 10 + [2] * 5
    assert [r.suffix for r in plan] == [1] * 10 + [0] * 10 + [None] * 5
    assert [r.kept for r in plan] == [False] * 10 + [True] * 15
    exact = files.rotation_plan(ev.where("n < 20"), 10, 0).orderBy("n").collect()
    assert [r.suffix for r in exact] == [0] * 10 + [None] * 10 and all(r.kept for r in exact)


def test_jsonl(ev, spark, tmp_path):
    files.write_jsonl(ev, str(tmp_path / "all"))
    got = numbers(f"{tmp_path}/all/part-*")
    assert [n for part in got for n in part] == list(range(25))
    files.write_jsonl(ev, str(tmp_path / "rotated"), max_events=10, max_files=1)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{tmp_path}/rotated/segment=*")) == ["segment=1", "segment=2"]
    assert [n for part in numbers(f"{tmp_path}/rotated/segment=*/part-*") for n in part] == list(range(10, 25))
    back = read_change_log(spark, str(tmp_path / "all"))
    assert back.count() == 25 and back.where("status = 'ok' and kind = 'INSERT'").count() == 25


def test_rotation_across_batches(ev, tmp_path):
    path = str(tmp_path / "log")

    def kept():
        found = {}
        for f in sorted(glob.glob(f"{path}/segment=*/batch=*/part-*")):
            segment = int(f.split("segment=")[1].split("/")[0])
            found.setdefault(segment, []).extend(json.loads(line)["rows"][0]["n"] for line in open(f))
        return {s: sorted(n) for s, n in found.items()}

    files.append_jsonl(ev.where("n < 7"), path, 0, 5, 2)
    assert kept() == {0: [0, 1, 2, 3, 4], 1: [5, 6]}
    for _ in range(2):  # the second run repeats the batch
        files.append_jsonl(ev.where("n >= 7 and n < 12"), path, 1, 5, 2)
        assert kept() == {0: [0, 1, 2, 3, 4], 1: [5, 6, 7, 8, 9], 2: [10, 11]}
    files.append_jsonl(ev.where("n >= 12"), path, 2, 5, 2)
    assert kept() == {2: [10, 11, 12, 13, 14], 3: [15, 16, 17, 18, 19], 4: [20, 21, 22, 23, 24]}
    with pytest.raises(Exception):
        files.append_jsonl(ev, path, 9, 5, 2)


def test_audit(ev, spark, tmp_path):
    for _ in range(2):
        files.write_audit(ev, "unused", path=str(tmp_path / "audit"))
    audit = spark.read.parquet(str(tmp_path / "audit"))
    assert audit.count() == 50 and audit.select("id").distinct().count() == 25
    assert sorted(os.listdir(tmp_path / "audit"))[-2:] == ["event_date=2024-01-01", "event_date=2024-01-02"]
    row = audit.where("binlog_file = 'f.000003' and binlog_position = 4").first()
    assert row.id == 3 * 2**32 + 4 and row.event_type == "INSERT" and row.txn_id == "t"
    blank = records.audit_rows(ev.withColumn("txn", F.lit(None).cast("string")), ts=None).first()
    assert blank.txn_id == "" and blank.event_time is not None


def test_records(ev):
    assert {r.topic for r in records.kafka_records(ev).collect()} == {"cdc."}
    fields = records.redis_stream_records(ev.withColumn("db", F.lit(None).cast("string"))).first()
    assert fields.stream == "cdc:unknown.t" and fields.fields["db"] == ""
    assert records.pubsub_records(ev).first().channel == "cdc_events"
    assert records.syslog_records(ev, facility="LOG_USER", priority="LOG_DEBUG").first().pri == 15
    assert records.topic_messages(ev, filtering=False).where("topic is null").count() == 25
    sent, oversize = records.datagram_records(ev, 44)
    assert (sent.count(), oversize.count()) == (10, 15)
    assert all(r.packet.endswith("\n") and len(r.packet) == r.bytes for r in sent.collect())


def failing_transport(fail_first):
    def open_transport():
        tries = {}

        def send(record):
            place = (record["log_file"], record["position"])
            tries[place] = tries.get(place, 0) + 1
            if tries[place] <= fail_first:
                raise OSError("refused")
            return 201 if record["headers"].get("Authorization") == "Bearer s" else 400

        return send

    return open_transport


def test_webhook_retries(ev):
    def run(k, token="s"):
        rows = deliver.webhook_deliver(ev, failing_transport(k), token=token, backoff=0).collect()
        assert len(rows) == 25
        return {(r.ok, r.attempts, r.status) for r in rows}
    assert run(0) == {(True, 1, 201)}
    assert run(3) == {(True, 4, 201)}
    assert run(4) == {(False, 4, None)}
    assert run(0, token="") == {(False, 4, 400)}
    assert "Authorization" not in deliver.webhook_headers("")


def test_backoff_doubles(monkeypatch):
    pauses = []
    monkeypatch.setattr(deliver.time, "sleep", pauses.append)
    assert deliver.attempt(lambda r: 500, {}, 3, 0.1) == (False, 4, 500, None)
    assert pauses == [0.1, 0.2, 0.4]


def test_python_callbacks(ev):
    def on_event(event):
        if event["db"] == "b":
            raise ValueError("no")
        return {"json": 0}.get("json") if '"n":2' in event["json"] else "text"
    stats = metrics.delivery_stats(deliver.python_deliver(ev, on_event)).first()
    assert (stats.total, stats.published, stats.errors, stats.dropped) == (25, 13, 12, 0)
    assert [deliver.callback_status(v) for v in (0, 1, -1, None, "x", True, False)] == [
        200, 500, 500, 200, 200, 500, 200]


class Collecting(Publisher):
    name, seen = "files", None

    def __init__(self, fail=False):
        self.fail, self.batches = fail, []

    def init(self, options):
        self.options = options

    def publish_batch(self, batch, batch_id):
        if self.fail:
            raise RuntimeError("down")
        self.batches.append((batch_id, batch.count()))


def test_contract():
    validate(Collecting())
    with pytest.raises(TypeError, match="publish_batch"):
        validate(Publisher())
    with pytest.raises(TypeError, match="name"):
        validate(type("Nameless", (Collecting,), {"name": ""})())
    assert backlog_healthy(10_000, 1000) and not backlog_healthy(10_001, 1000)


def test_event_publisher(ev, spark):
    class Odd(EventPublisher):
        name = "odd"

        def init(self, options):
            pass

        def publish(self, event):
            return event["position"] // 100 % 2

    with pytest.raises(TypeError, match="publish"):
        validate(type("Silent", (EventPublisher,), {"name": "silent"})())
    odd = Odd()
    validate(odd)
    stats = metrics.delivery_stats(odd.publish_batch(ev, 0)).first()
    assert (stats.publisher, stats.published, stats.errors) == ("odd", 13, 12)


def test_failing_publisher_does_not_hold_up_others(ev, spark, tmp_path):
    routes = spark.createDataFrame(
        [("good", True, ["a"], "x", {}), ("bad", True, [], "x", {}), ("all", True, [], "x", {})],
        "publisher STRING, active BOOLEAN, databases ARRAY<STRING>, sink STRING, options MAP<STRING,STRING>")
    good, everything = Collecting(), Collecting()
    outcomes = publish(ev, routes, {"good": good, "bad": Collecting(fail=True), "all": everything}, str(tmp_path), 3)
    assert [(o.publisher, o.ok) for o in outcomes] == [("good", True), ("bad", False), ("all", True)]
    assert good.batches == [(3, 13)] and everything.batches == [(3, 25)]
    assert "down" in outcomes[1].error
    with pytest.raises(ValueError, match="all, bad"):
        publish(ev, routes, {"good": good}, str(tmp_path), 4)


def test_failed_records_fail_the_outcome(ev, spark, tmp_path):
    class Picky(EventPublisher):
        name = "picky"

        def init(self, options):
            pass

        def publish(self, event):
            if event["db"] == "b":
                raise OSError("no b")
            return 0

    routes = spark.createDataFrame([("picky", True, [], "x"), ("only_a", True, ["a", "a"], "x"), ("off", False, [], "x")],
                                   "publisher STRING, active BOOLEAN, databases ARRAY<STRING>, sink STRING")
    picky, only_a = publish(ev, routes, {"picky": Picky(), "only_a": Picky()}, str(tmp_path), 7)
    assert (picky.ok, picky.delivered, picky.failed) == (False, 13, 12) and "12 records" in picky.error
    assert (only_a.ok, only_a.delivered, only_a.failed) == (True, 13, 0)
    stored = spark.read.parquet(str(tmp_path / "batch=7" / "sender=picky"))
    assert {r.error for r in stored.where("not ok").collect()} == {"OSError: no b"}

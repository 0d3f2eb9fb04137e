"""Publishers built from configuration documents, end to end with fake transports."""

import glob
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidelog.operators import metrics
from tidelog.plans.derived_log import derived_events
from tidelog.sinks.builtin import build_publishers, option_bool, option_int
from tidelog.sinks.publisher import publish, validate
from tidelog.sources.config import config_document, rules_tables


def plugin(name, kind, dbs=(), **config):
    return {"plugin": {"name": name, "library_path": f"./lib/{kind}_publisher.so", "publish_databases": list(dbs),
                       "config": config}}


def routes_of(spark, *plugins):
    return rules_tables(config_document(spark, json.dumps({"publishers": list(plugins)})))[1]


def recorder(folder, keys):
    """Transport that writes down what it was asked to send."""
    def open_transport():
        def send(record):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                json.dump({k: str(record[k]) for k in keys}, f)
            return 200
        return send
    return open_transport


class Script:
    def __init__(self):
        self.calls = []

    def on_init(self, config):
        self.calls.append(("init", config["extra"]))
        return 0

    def begin(self):
        self.calls.append("start")

    def on_health(self):
        return 1


def test_all_kinds(spark, sf, tmp_path):
    ev = derived_events(spark, sf).persist()
    sent = {k: tmp_path / k for k in ("redis", "udp", "zmq", "syslog", "web")}
    for folder in sent.values():
        folder.mkdir()
    routes = routes_of(
        spark,
        plugin("files", "file", ["web"], file_path=str(tmp_path / "files"), rotate_max_events=20, rotate_max_files=2),
        plugin("redis", "redis", use_streams=True, stream_prefix="s:"),
        plugin("udp", "udp", udp_host="h", udp_port=1, max_packet_size=250),
        plugin("zmq", "zmq", endpoint="e", subscriber_filtering=True),
        plugin("syslog", "syslog", format_compact="yes", facility="LOG_USER"),
        plugin("web", "webhook", ["shop"], webhook_url="u", auth_token="k"),
        plugin("script", "python", extra="e", on_start_method="begin"),
        plugin("ledger", "mysql", ["shop"], table="ledger", path=str(tmp_path / "ledger")),
    )
    script = Script()
    keys = {"redis": ["stream", "fields"], "udp": ["packet"], "zmq": ["topic", "payload"],
            "syslog": ["pri", "message"], "web": ["json", "headers"]}
    publishers = build_publishers(
        routes, {k: recorder(str(sent[k]), keys[k]) for k in keys}, {"script": script_for_tasks(script)})
    for p in publishers.values():
        validate(p)
        p.start()
    assert script.calls == [("init", "e"), "start"]
    outcomes = publish(ev, routes, publishers, str(tmp_path / "reports"))
    assert [o.publisher for o in outcomes if not o.ok] == ["script"]  # it refuses some events below

    total, web, shop = ev.count(), ev.where("db = 'web'").count(), ev.where("db = 'shop'").count()
    stats = {r.publisher: r for r in metrics.delivery_stats(
        spark.read.parquet(f"{tmp_path}/reports/batch=0/sender=*")).collect()}
    assert stats["redis"].published == stats["zmq"].published == stats["syslog"].published == total
    assert stats["web"].published == shop
    big = ev.where(F.octet_length("json") + 1 > 250).count()
    assert 0 < big < total and (stats["udp"].dropped, stats["udp"].published) == (big, total - big)
    assert (stats["script"].published, stats["script"].errors) == (web, total - web)
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == shop
    kept = glob.glob(f"{tmp_path}/files/segment=*")
    assert len(kept) == 3  # two rotated files and the active one

    def first(name):
        return json.load(open(glob.glob(f"{sent[name]}/*")[0]))
    assert first("redis")["stream"].startswith("s:") and "'txn'" in first("redis")["fields"]
    assert first("zmq")["topic"].count(".") == 1
    assert first("syslog")["pri"] == "14" and first("syslog")["message"].startswith("CDC: ")
    assert "Bearer k" in first("web")["headers"]
    assert publishers["script"].health_check() is False
    ev.unpersist()


def script_for_tasks(script):
    """The script object with an event hook that tasks can load by value."""
    def on_event(event):
        return 0 if event["db"] == "web" else 1
    script.on_event = on_event
    return script


def test_settings(spark):
    with pytest.raises(ValueError, match="bootstrap_servers"):
        build_publishers(routes_of(spark, plugin("k", "kafka")))
    with pytest.raises(ValueError, match="no sink"):
        build_publishers(routes_of(spark, plugin("l", "lua")))
    with pytest.raises(ValueError, match="no sink"):
        build_publishers(routes_of(spark, plugin("u", "udp", udp_host="h", udp_port=1)))
    with pytest.raises(ValueError, match="event callback"):
        build_publishers(routes_of(spark, plugin("p", "python")), scripts={"p": object()})
    kafka = build_publishers(routes_of(spark, plugin("k", "kafka", bootstrap_servers="b", topic_per_table="On")))["k"]
    ev = spark.createDataFrame([("f", 4, "d", "t", "x", "{}")],
                               "log_file STRING, position BIGINT, db STRING, `table` STRING, txn STRING, json STRING")
    assert kafka.shape(ev).first().topic == "cdc.d.t"
    options = {"a": "12x", "b": "x", "c": " YES", "d": "perhaps", "e": ""}
    assert [option_int(options, k, 9) for k in "abz"] == [12, 0, 9]
    assert [option_bool(options, k, True) for k in "cdez"] == [True, True, True, True]
    assert [option_bool(options, k, False) for k in "cdez"] == [True, False, False, False]

"""Capture rules, row images, documents, filters and values on hand-made edge rows."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.functions import values
from tidelog.functions.classify import classify_query, event_kind
from tidelog.functions.documents import parse_document
from tidelog.functions.envelope import parse_envelope, to_envelope
from tidelog.functions.text import blob_preview, compact_summary
from tidelog.operators import metrics
from tidelog.operators.capture import capture_tables, emit_only, flag_captured, project_columns, with_primary_key
from tidelog.operators.decode import decode_enum, enum_values
from tidelog.operators.filters import datagram_limit, payload_status, select_topics, size_guard, split_corrupt, subscribe
from tidelog.operators.routing import dispatch_counts, route, unmatched_events, with_topic
from tidelog.operators.rows import changed_fields, explode_rows, normalize_event, pack_rows, preview_changes, preview_rows
from tidelog.sources.change_log import parse_change_log, table_columns
from tidelog.sources.config import config_document, rules_tables

RULES = {"capture": {"databases": [
    {"a": {"tables": [{"t": {"primary_key": ["id"], "columns": ["*"]}}, {"u": {"columns": ["y", "x"]}}, {"v": {}}]}},
    {"b": {"capture_dml": False, "tables": [{"t": {"columns": ["*"]}}]}},
    {"c": {"capture_ddl": False}},
    {"a": {"capture_dml": False}},
]}, "publishers": [
    {"plugin": {"name": "all", "library_path": "x/file_publisher.so"}},
    {"plugin": {"name": "only_a", "library_path": "x/udp_publisher.so", "publish_databases": ["a", "a"]}},
    {"plugin": {"name": "off", "library_path": "x/udp_publisher.so", "active": False}},
    {"plugin": {"name": "no_library"}}, {"plugin": {"library_path": "no_name.so"}},
]}


@pytest.fixture(scope="module")
def config(spark):
    return rules_tables(config_document(spark, json.dumps(RULES)))


def events(spark, *rows):
    """Events from (kind, db, table, query, row text) tuples."""
    full = [(i, "f.000001", 4 + 50 * i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(full, "seq INT, log_file STRING, position BIGINT, kind STRING, db STRING, "
                                     "`table` STRING, query STRING, body STRING")
    return df.withColumns({
        "rows": F.from_json("body", "array<map<string,variant>>"),
        "xid": F.when(F.col("kind") == "XID", F.col("seq")).cast("decimal(20,0)"),
    }).drop("body")


def test_rules_and_routes(config):
    rules, routes = config
    by_table = {(r.db, r.table): r for r in rules.collect()}
    assert set(by_table) == {("a", "t"), ("a", "u"), ("a", "v"), ("b", "t"), ("c", None)}
    assert by_table["a", "t"].all_columns and by_table["a", "t"].primary_key == ["id"]
    assert by_table["a", "u"].columns == ["y", "x"] and by_table["a", "v"].columns == []
    assert not by_table["b", "t"].capture_dml and not by_table["c", None].capture_ddl
    assert by_table["a", "t"].capture_dml  # the first entry of a database counts
    found = {r.publisher: r for r in routes.collect()}
    assert set(found) == {"all", "only_a", "off"}
    assert found["all"].databases == [] and found["all"].queue_depth == 1024 and found["all"].sink == "file"
    assert not found["off"].active


def test_broken_configuration_raises(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        rules_tables(config_document(spark, '{"capture": {'))[0].collect()


def test_documents_together_have_one_rule_per_table(spark):
    docs = spark.createDataFrame([(json.dumps(RULES),), (json.dumps({"capture": {"databases": [{"a": {"tables": [{"t": {}}, {"w": {}}]}}]}}),)], "doc STRING")
    rules, _ = rules_tables(docs)
    names = [(r.db, r.table) for r in rules.collect()]
    assert len(names) == len(set(names)) and ("a", "w") in names
    log = events(spark, ("INSERT", "a", "t", None, '[{"id":1}]'))
    assert capture_tables(log, rules).count() == project_columns(log, rules).count() == 1


def test_capture_and_emission(spark, config):
    rules, _ = config
    log = events(
        spark,
        ("INSERT", "a", "t", None, '[{"id":1}]'), ("INSERT", "A", "t", None, "[]"), ("INSERT", "b", "t", None, "[]"),
        ("QUERY", "a", None, "ALTER x", None), ("QUERY", "c", None, "DROP x", None), ("QUERY", "", None, "DROP x", None),
        ("QUERY", "zz", None, "DROP x", None), ("QUERY", "b", None, "rename x", None), ("QUERY", "a", None, "SET x", None),
        ("QUERY", None, None, "BEGIN", None), ("XID", None, None, None, None))
    assert [r.seq for r in capture_tables(log, rules).collect()] == [0]
    assigned = flag_captured(log, rules).withColumn("txn", F.lit("t")).withColumn("map_db", F.lit("b"))
    got = {r.seq: (r.db, r.table) for r in emit_only(assigned, rules).collect()}
    assert got == {0: ("a", "t"), 3: ("a", "ALTER"), 7: ("b", "RENAME"), 10: ("b", "COMMIT")}
    late = emit_only(assigned.withColumn("map_db", F.lit("c")), rules).where("kind = 'XID'")
    none = emit_only(assigned.withColumn("map_db", F.lit(None).cast("string")), rules).where("kind = 'XID'")
    assert late.count() == 0 and none.count() == 0


def test_projection_order_nulls_and_updates(spark, config):
    rules, _ = config
    log = events(
        spark,
        ("INSERT", "a", "t", None, '[{"id":1,"n":null}]'),
        ("INSERT", "a", "u", None, '[{"x":1,"z":2,"y":null},{"x":3,"z":4,"y":"q"}]'),
        ("UPDATE", "a", "u", None, '[{"before":{"x":1,"z":2},"after":{"x":5,"z":6}}]'),
        ("DELETE", "a", "v", None, '[{"x":1}]'))
    out = with_primary_key(project_columns(log, rules), rules).withColumn("txn", F.lit("t"))
    docs = [json.loads(r.json, object_pairs_hook=list) for r in to_envelope(out).orderBy("seq").collect()]
    assert docs[0] == [("type", "INSERT"), ("txn", "t"), ("db", "a"), ("table", "t"), ("primary_key", ["id"]),
                       ("rows", [[("id", 1), ("n", None)]])]
    assert dict(docs[1])["rows"] == [[("x", 1), ("y", None)], [("x", 3), ("y", "q")]]
    assert dict(docs[2])["rows"] == [[("before", [("x", 1)]), ("after", [("x", 5)])]]
    assert dict(docs[3])["rows"] == [[]] and "primary_key" not in dict(docs[3])


def test_documents_escape_and_parse_back(spark):
    nasty = 'q"b\\c\nd\re\tf\u0001 é漢'
    body = json.dumps([{"s": nasty, "i": -5, "f": 1.25, "n": None, "big": 2**53 + 1}])
    log = events(spark, ("INSERT", "d", "t", None, body), ("QUERY", "d", None, "ALTER " + nasty + "x" * 2000, None),
                 ("XID", "d", "COMMIT", None, None), ("INSERT", "d", "t", None, None)).withColumn("txn", F.lit("t"))
    out = to_envelope(log).orderBy("seq").select("json", parse_envelope(F.col("json")).alias("p")).collect()
    row = json.loads(out[0].json)["rows"][0]
    assert row == {"s": nasty, "i": -5, "f": 1.25, "n": None, "big": 2**53 + 1}
    ddl = json.loads(out[1].json)
    assert list(ddl) == ["type", "txn", "db", "query"] and ddl["query"] == "ALTER " + nasty + "x" * 2000
    short = to_envelope(log, max_query_chars=9).where("type = 'ALTER'").first()
    assert json.loads(short.json)["query"] == ("ALTER " + nasty)[:9]
    assert json.loads(out[2].json) == {"type": "COMMIT", "txn": "t", "db": "d", "xid": 2}
    assert json.loads(out[3].json)["rows"] == []
    assert out[0].p.type == "INSERT" and out[2].p.xid == 2 and out[1].p.table is None


def test_classification(spark):
    df = spark.createDataFrame([("BEGINNING",), (" BEGIN",), ("truncate t",), ("",), (None,)], "q STRING")
    for expr in (classify_query("q"), classify_query(F.col("q"))):
        assert [r[0] for r in df.select(expr).collect()] == ["BEGIN", "QUERY", "TRUNCATE", "QUERY", None]
    codes = spark.createDataFrame([(2,), (16,), (166,), (31,), (25,), (19,), (99,), (None,)], "c INT")
    assert [r[0] for r in codes.select(event_kind("c")).collect()] == [
        "QUERY", "XID", "INSERT", "UPDATE", "DELETE", "TABLE_MAP", None, None]


def test_rows(spark):
    log = events(
        spark,
        ("UPDATE", "d", "t", None, '[{"before":{"a":1,"b":null,"c":"x","gone":1},"after":{"a":2,"b":null,"c":"x","new":1}},'
                                   '{"before":{"a":null},"after":{"a":0}}]'),
        ("INSERT", "d", "t", None, "[]"), ("DELETE", "d", "t", None, '[{"a":1}]'))
    flat = explode_rows(log)
    assert sorted((r.seq, r.row_no, r.before is None, r.after is None) for r in flat.collect()) == [
        (0, 0, False, False), (0, 1, False, False), (2, 0, False, True)]
    diff = sorted((r.row_no, r.field, r.old_value, r.new_value) for r in changed_fields(flat).collect())
    assert diff == [(0, "a", "1", "2"), (1, "a", None, "0")]
    typed = spark.sql("""SELECT map('n', cast(1 AS variant), 'm', cast('1' AS variant), 'k', parse_json('null'), 'd', cast(2.50BD AS variant)) AS before,
        map('n', cast(1.0D AS variant), 'm', cast(1 AS variant), 'k', parse_json('null'), 'd', cast(2.5D AS variant)) AS after""")
    assert [r.field for r in changed_fields(typed).collect()] == ["m"]  # numbers compare by value, text does not
    shown = {r.seq: (len(r.preview), r.more) for r in preview_rows(log, 1).collect()}
    assert shown == {0: (1, 1), 1: (0, 0), 2: (1, 0)}


def test_packing_splits_long_statements(spark):
    changes = spark.range(2500).selectExpr(
        "'f.1' as log_file", "7L as position", "'INSERT' as kind", "'d' as db", "'t' as `table`", "id as row_no",
        "map('id', cast(id as variant)) as row").repartition(7)
    got = pack_rows(changes, 1000).orderBy("chunk").select(
        "chunk", "last_chunk", F.transform("rows", lambda r: r["id"].cast("bigint")).alias("ids")).collect()
    assert [len(r.ids) for r in got] == [1000, 1000, 500] and [r.last_chunk for r in got] == [False, False, True]
    shown = preview_changes(changes).first()
    assert (len(shown.preview), shown.more) == (3, 2497)
    assert [i for r in got for i in r.ids] == list(range(2500))


def test_corrupt_documents(spark):
    texts = ['{"type":"INSERT"}', '{"type":"INS', "", "  ", None, "{}", "null", "[1]", "5", "plain", '{"a":{}}', '{"a":1} tail']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, json STRING")
    got = [r[0] for r in df.orderBy("i").select(payload_status()).collect()]
    assert got == ["ok", "invalid", "empty", "empty", "empty", "empty", "empty", "invalid", "invalid", "invalid", "ok", "invalid"]
    glued = ['{"a":1}{"b":2}', '{"a":1} {"b":2}', '{"a":1} junk }', '{"a":1},{"b":2}', '{"a":1}],[{"b":2}', '{"a":1}]', '"x","y"', '1 2', "nullnull"]
    rows = spark.createDataFrame([(t,) for t in glued], "json STRING")
    assert {r[0] for r in rows.select(payload_status()).collect()} == {"invalid"}
    assert rows.where(parse_document("json").isNotNull()).count() == 0
    good, bad = split_corrupt(df)
    assert good.count() == 2 and bad.count() == 10
    assert parse_change_log(df).count() == len(texts)
    counts = metrics.error_counts(parse_change_log(df)).first()
    assert (counts.total_received, counts.processed, counts.empty, counts.errors) == (12, 2, 5, 10)


def test_sizes_count_bytes(spark):
    df = spark.createDataFrame([("é" * 10,), ("x" * 20,), ("x" * 19,), (None,)], "json STRING")
    fits, dropped = size_guard(df, 20)
    assert [r.json for r in fits.collect()] == ["x" * 19] and dropped.count() == 3
    assert size_guard(df, 20, newline=False)[0].count() == 3
    assert [datagram_limit(n) for n in (None, 0, -1, 70000, 65507, 10)] == [65507] * 5 + [10]
    big = spark.createDataFrame([("x" * 65507,), ("x" * 65506,)], "json STRING")
    assert size_guard(big)[0].count() == 1


def test_blob_preview_counts_bytes(spark):
    df = spark.createDataFrame([("é" * 150,), ("a\tb",), (None,), ("x" * 200,)], "s STRING")
    got = [r[0] for r in df.select(blob_preview("s")).collect()]
    assert got == ["." * 200 + "...", "a.b", None, "x" * 200]


def test_summary(spark):
    df = spark.createDataFrame([
        ('{"type":"UPDATE","rows":[1,2]}', "d", "t", "x"), ("{bad", None, "t", None), ("{}", None, None, None),
        ('{"type":"INSERT","rows":5}', "d" * 600, "t", None), ("12 monkeys", "d", "t", None), ("12", "d", "t", None)], "json STRING, db STRING, `table` STRING, txn STRING")
    got = [r.summary for r in compact_summary(df).collect()]
    assert got[0] == "CDC: UPDATE db=d table=t rows=2 txn=x"
    assert got[1] == "CDC event db=? table=t"
    assert got[2] == "CDC: UNKNOWN db=? table=? rows=0 txn=none"
    assert len(got[3]) == 511
    assert got[4] == "CDC event db=d table=t"
    assert got[5] == "CDC: UNKNOWN db=d table=t rows=0 txn=none"


def test_documents_are_one_value(spark):
    good = ["{}", ' {"a":"}"} ', "[1]\n", '"x y"', "5", "true", "null", '{"a":"\u00e9\n"}'.replace("\n", "")]
    bad = ["5 x", "{} x", '"a" b', "[1] 2", "true story", "", " ", "{", "}", '{"a":1}}}x', "nul"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t STRING")
    got = [r[0] is not None for r in df.select(F.to_json(parse_document("t"))).collect()]
    assert got == [True] * len(good) + [False] * len(bad)


def test_normalize(spark):
    df = spark.createDataFrame([
        ({"json": '{"type":"insert","db":"j","table":"jt","txn":"jx","rows":[1]}', "db": "r"},),
        ({"payload": '{"type":"COMMIT"}'},), ({},), ({"json": "{broken", "table": "t"},)], "fields MAP<STRING,STRING>")
    got = [(r.type, r.db, r.table, r.txn, r.n_rows) for r in normalize_event(df).collect()]
    assert got == [("INSERT", "r", "jt", "jx", 1), ("COMMIT", "?", "?", "none", 0),
                   ("UNKNOWN", "?", "?", "none", 0), ("UNKNOWN", "?", "t", "none", 0)]


def test_routing(spark, config):
    _, routes = config
    ev = spark.createDataFrame([(1, "a"), (2, "q"), (3, None), (4, "*")], "position INT, db STRING").withColumns(
        {"log_file": F.lit("f.1"), "table": F.lit("t")})
    got = sorted((r.position, r.publisher) for r in route(ev, routes).collect())
    assert got == [(1, "all"), (1, "only_a"), (2, "all"), (4, "all")]
    assert {r.position: r.dispatched for r in dispatch_counts(ev, routes).collect()} == {1: 2, 2: 1, 3: 0, 4: 1}
    assert [r.position for r in unmatched_events(ev, routes).collect()] == [3]
    only = routes.where("publisher = 'only_a'")
    assert sorted(r.position for r in unmatched_events(ev, only).collect()) == [2, 3, 4]


def test_topics(spark):
    ev = spark.createDataFrame([("d", "t"), (None, None)], "db STRING, `table` STRING")
    def names(*args, **kw):
        return [r.topic for r in with_topic(ev, *args, **kw).collect()]
    assert names() == ["cdc.", "cdc."]
    assert names(per_table=True) == ["cdc.d.t", "cdc.unknown.unknown"]
    assert names("stream") == ["cdc:d.t", "cdc:unknown.unknown"]
    assert names("message") == ["d.t", "unknown.unknown"]
    topics = spark.createDataFrame([("cdc:a",), ("cdc.a",), ("cdcxa",), ("__skip",)], "topic STRING")
    assert select_topics(topics, ["cdc:*", "cdc.*"]).count() == 2
    assert select_topics(topics, ["cdc?a"]).count() == 3
    assert select_topics(topics, exclude=["__skip"]).count() == 3
    assert subscribe(topics).count() == 4 and subscribe(topics, "cdc:").count() == 1


def test_enums(spark):
    cols = spark.createDataFrame([("d", "t", "c", "enum('a','it''s','','x,y')"), ("d", "t", "n", "int")],
                                 "db STRING, `table` STRING, `column` STRING, column_type STRING")
    labels = enum_values(cols)
    assert [(r.ordinal, r.label) for r in labels.orderBy("ordinal").collect()] == [
        (1, "a"), (2, "it's"), (3, ""), (4, "x,y")]
    raw = spark.createDataFrame([("d", "t", "c", 2), ("d", "t", "c", 9), ("d", "t", "c", None), ("d", "q", "c", 1)],
                                "db STRING, `table` STRING, `column` STRING, ordinal INT")
    assert sorted(str(r.label) for r in decode_enum(raw, labels).collect()) == ["1", "9", "None", "it's"]


def test_values(spark):
    one = spark.range(1)
    def val(c):
        return one.select(c.alias("v")).first().v
    assert [val(values.int24(F.lit(n))) for n in (0, 0x7FFFFF, 0x800000, 0xFFFFFF)] == [0, 8388607, -8388608, -1]
    assert val(values.as_unsigned(F.lit(-1), 32)) == 2**32 - 1
    assert int(val(values.as_unsigned(F.lit(-1), 64))) == 2**64 - 1
    assert val(values.datetime2(F.unhex(F.lit("0000000000")))) is None
    assert val(values.parse_int(F.lit("99999999999"))) == 0 and val(values.parse_int(F.lit(None).cast("string"), 5)) == 5
    assert val(values.parse_bool(F.lit("\n\tON"))) is True and val(values.parse_bool(F.lit("on "), False)) is False
    assert val(values.stream_id_time(F.lit("0-0"))) == "00:00:00" and val(values.stream_id_time(F.lit("-"))) == "??:??:??"
    assert val(values.syslog_pri(F.lit(None).cast("string"), F.lit("nope"))) == 16 * 8 + 6


def test_lag_edges(spark):
    rows = [("t", 0, "2024-01-01 00:00:00", 10, 4), ("t", 0, "2024-01-01 23:59:59", 30, None),
            ("t", 0, "2024-01-03 00:00:00", 20, 25), ("t", 1, "2024-01-03 00:00:00", 5, 5), (None, 1, "2024-01-03 00:00:00", 1, 0)]
    df = spark.createDataFrame(rows, "topic STRING, partition INT, at STRING, end_offset BIGINT, committed BIGINT")
    lag = metrics.partition_lag(df.withColumn("sampled_at", F.col("at").cast("timestamp_ntz")))
    got = {(r.topic, r.partition, r.at): (r.lag, r.rate) for r in lag.collect()}
    assert len(got) == 5
    assert got["t", 0, rows[0][2]] == (6, 0.0)
    assert got["t", 0, rows[1][2]] == (None, 20 / 86399)
    assert got["t", 0, rows[2][2]] == (0, -10 / 86401)
    assert got[None, 1, rows[4][2]] == (1, 0.0)
    total = metrics.lag_totals(lag).orderBy("sampled_at").collect()
    assert [(r.total_lag, r.total_rate >= 0) for r in total] == [(6, True), (0, True), (1, True)]


def test_table_columns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_columns")
    spark.sql("CREATE OR REPLACE VIEW shop_columns.things AS SELECT 1 AS id, 'x' AS name")
    got = table_columns(spark, "shop_columns", "things").orderBy("ordinal").collect()
    assert [(r.ordinal, r.name, r.type) for r in got] == [(1, "id", "int"), (2, "name", "string")]

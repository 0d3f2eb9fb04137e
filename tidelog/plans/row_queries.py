"""Queries over row images and documents: projection, envelopes, differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import blob_preview, compact_summary, truncate_query
from ..operators.capture import capture_tables, missing_columns, project_columns, with_primary_key
from ..operators.filters import split_corrupt
from ..operators.rows import changed_fields, explode_rows, normalize_event, pack_rows, preview_changes
from ..sinks.records import redis_stream_records
from ..sources.change_log import observed_columns, parse_change_log, parse_kafka, schema_columns, union_streams
from .derived_log import J, L, RULES, derived_events, derived_log, rules
from .registry import query, table

CAPTURED = f"""{L}, {RULES},
P AS (SELECT L.* EXCLUDE (db, "table"), L.db AS db, L."table" AS "table", r.primary_key, r.all_columns, r.columns
      FROM L JOIN RULES r ON L.db = r.db AND L."table" = r."table" AND r.capture_dml)"""


@query("project_columns", f"""WITH {CAPTURED}
SELECT log_file, position, kind,
  CASE WHEN NOT all_columns AND len(columns) = 0 THEN ''
       WHEN kind = 'UPDATE' AND all_columns THEN 'created_at,id,name,props,value' WHEN kind = 'UPDATE' THEN 'created_at,id,name'
       WHEN all_columns THEN 'id,name,created_at,value,props' ELSE 'id,name,created_at' END AS names,
  CASE WHEN all_columns OR len(columns) > 0 THEN user_id END AS id,
  CASE WHEN all_columns OR len(columns) > 0 THEN ts END AS created_at,
  CASE WHEN all_columns THEN value END AS value,
  CASE WHEN all_columns THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM P""")
def projected(spark, sf):
    config = rules(spark)
    kept = project_columns(capture_tables(derived_log(spark, sf), config), config)
    row = F.element_at("rows", 1)
    image = F.when(F.col("kind") == "UPDATE", row["after"].cast("map<string,variant>")).otherwise(row)
    return kept.select("log_file", "position", "kind", image.alias("image")).select(
        "log_file", "position", "kind",
        F.array_join(F.map_keys("image"), ",").alias("names"),
        F.col("image")["id"].cast("bigint").alias("id"),
        F.col("image")["created_at"].cast("timestamp_ntz").alias("created_at"),
        F.col("image")["value"].cast("double").alias("value"),
        F.try_variant_get(F.col("image")["props"], "$.k", "bigint").alias("k"),
    )


@query("missing_columns", f"""WITH {L}, {RULES}
SELECT r.db AS db, r."table" AS "table", r.column AS "column" FROM (
  SELECT db, "table", unnest(columns) AS column FROM RULES WHERE NOT all_columns) r
WHERE NOT EXISTS (SELECT 1 FROM L WHERE L.db = r.db AND L."table" = r."table" AND kind <> 'QUERY'
                  AND r.column IN ('id', 'name', 'created_at', 'value', 'props'))""")
def missing(spark, sf):
    return missing_columns(rules(spark), observed_columns(derived_log(spark, sf)))


@query("observed_columns", f"""WITH {L}
SELECT DISTINCT db, "table", unnest(['id', 'name', 'created_at', 'value', 'props']) AS name FROM L
WHERE kind IN ('INSERT', 'UPDATE', 'DELETE')""")
def columns_seen(spark, sf):
    return observed_columns(derived_log(spark, sf))


@query("table_columns", """SELECT 'app' AS db, 'events' AS "table", column_name AS name FROM (DESCRIBE SELECT * FROM events)
UNION ALL SELECT 'app', 'orders', column_name FROM (DESCRIBE SELECT * FROM orders)""")
def columns_of_tables(spark, sf):
    found = [schema_columns(table(spark, sf, name), "app", name) for name in ("events", "orders")]
    return union_streams(*found).select("db", "table", "name")


@query("with_primary_key", f"""WITH {CAPTURED}
SELECT log_file, position, CASE WHEN len(primary_key) > 0 THEN array_to_string(primary_key, ',') END AS primary_key FROM P""")
def keyed(spark, sf):
    config = rules(spark)
    events = with_primary_key(capture_tables(derived_log(spark, sf), config), config)
    return events.select("log_file", "position", F.array_join("primary_key", ",").alias("primary_key"))


for _kind, _name in [("INSERT", "insert"), ("UPDATE", "update"), ("DELETE", "delete"),
                     ("QUERY", "ddl"), ("XID", "commit")]:
    def _documents(spark, sf, kind=_kind):
        return derived_events(spark, sf).where(F.col("kind") == kind).select("log_file", "position", "json")

    query(f"envelope_{_name}", f"WITH {J} SELECT log_file, position, json FROM J WHERE kind = '{_kind}'")(_documents)


@query("change_log_scan", f"""WITH {J}
SELECT log_file, position, kind, type, txn, db, "table",
  CASE WHEN len(primary_key) > 0 THEN array_to_string(primary_key, ',') END AS primary_key,
  CASE WHEN kind IN ('INSERT', 'UPDATE', 'DELETE') THEN 1 END AS n_rows, query, xid, 'ok' AS status FROM J""")
def scanned(spark, sf):
    documents = derived_events(spark, sf).select("log_file", "position", "json")
    return parse_change_log(documents).select(
        "log_file", "position", "kind", "type", "txn", "db", "table",
        F.array_join("primary_key", ",").alias("primary_key"), F.size("rows").alias("n_rows"),
        "query", F.col("xid").cast("bigint").alias("xid"), "status")


@query("kafka_source", f"""WITH {J}
SELECT 'cdc.' || db || '.' || "table" AS topic, position AS "offset", type, txn, db, "table" FROM J""")
def kafka_source(spark, sf):
    records = derived_events(spark, sf).select(
        F.concat(F.lit("cdc."), "db", F.lit("."), "table").alias("topic"),
        F.lit(0).alias("partition"), F.col("position").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("txn").cast("binary").alias("key"), F.col("json").cast("binary").alias("value"))
    return parse_kafka(records).select("topic", "offset", "type", "txn", "db", "table")


@query("union_streams", f"""WITH {L}
SELECT 'dml' AS stream, kind, count(*) AS events FROM L WHERE kind IN ('INSERT', 'UPDATE', 'DELETE') GROUP BY kind
UNION ALL SELECT 'other', kind, count(*) FROM L WHERE kind NOT IN ('INSERT', 'UPDATE', 'DELETE') GROUP BY kind""")
def unioned(spark, sf):
    log = derived_log(spark, sf).select("kind", "query", "db")
    dml = log.where("kind in ('INSERT', 'UPDATE', 'DELETE')").withColumn("stream", F.lit("dml")).drop("query")
    other = log.where("kind not in ('INSERT', 'UPDATE', 'DELETE')").withColumn("stream", F.lit("other")).drop("db")
    return union_streams(dml, other).groupBy("stream", "kind").agg(F.count("*").alias("events"))


def statement_changes(spark, sf):
    """Every seven events as the changed rows of one statement."""
    return table(spark, sf, "events").selectExpr(
        "'000001' as log_file", "event_id div 7 as position", "'INSERT' as kind", "'shop' as db", "'visits' as `table`",
        "event_id % 7 as row_no",
        "map('id', cast(event_id as variant), 'user', cast(user_id as variant), 'type', cast(event_type as variant)) as row")


@query("pack_rows", """SELECT event_id // 7 AS position, (event_id % 7) // 3 AS chunk, CAST(count(*) AS INTEGER) AS n_rows,
  string_agg(user_id || ':' || event_type, ',' ORDER BY event_id) AS members
FROM events GROUP BY ALL""")
def packed(spark, sf):
    members = F.transform("rows", lambda r: F.concat(r["user"].cast("string"), F.lit(":"), r["type"].cast("string")))
    return pack_rows(statement_changes(spark, sf), max_rows=3).select(
        "position", "chunk", F.size("rows").alias("n_rows"), F.array_join(members, ",").alias("members"))


@query("explode_rows", f"""WITH {L}
SELECT log_file, position, 0 AS row_no, kind,
  CASE kind WHEN 'UPDATE' THEN value - 1 WHEN 'DELETE' THEN value END AS old_value,
  CASE WHEN kind IN ('INSERT', 'UPDATE') THEN value END AS new_value
FROM L WHERE kind IN ('INSERT', 'UPDATE', 'DELETE')""")
def exploded(spark, sf):
    return explode_rows(derived_log(spark, sf)).select(
        "log_file", "position", "row_no", "kind",
        F.col("before")["value"].cast("double").alias("old_value"),
        F.col("after")["value"].cast("double").alias("new_value"))


VISIT = """map('user', cast({0}.user_id as variant), 'type', cast({0}.event_type as variant),
    'value', cast({0}.value as variant), 'props', parse_json({0}.props), '{1}', cast(1 as variant))"""


@query("changed_fields", """WITH P AS (
  SELECT a.event_id, a.user_id AS u0, b.user_id AS u1, a.event_type AS t0, b.event_type AS t1, a.value AS v0, b.value AS v1,
    replace(a.props, ' ', '') AS p0, replace(b.props, ' ', '') AS p1
  FROM events a JOIN events b ON a.event_id + 1 = b.event_id)
SELECT event_id, 'user' AS field, CAST(u0 AS VARCHAR) AS old_value, CAST(u1 AS VARCHAR) AS new_value FROM P WHERE u0 <> u1
UNION ALL SELECT event_id, 'type', t0, t1 FROM P WHERE t0 <> t1
UNION ALL SELECT event_id, 'value', CAST(v0 AS VARCHAR), CAST(v1 AS VARCHAR) FROM P WHERE v0 <> v1
UNION ALL SELECT event_id, 'props', p0, p1 FROM P WHERE p0 <> p1""")
def changes(spark, sf):
    a = table(spark, sf, "events").alias("a")
    b = table(spark, sf, "events").alias("b")
    images = a.join(b, F.col("a.event_id") + 1 == F.col("b.event_id")).select(
        F.col("a.event_id").alias("event_id"),
        F.expr(VISIT.format("a", "only_before")).alias("before"),
        F.expr(VISIT.format("b", "only_after")).alias("after"))
    return changed_fields(images)


@query("row_preview", """SELECT conv_id AS position, CAST(least(count(*), 3) AS INTEGER) AS shown,
  greatest(count(*) - 3, 0) AS more,
  array_to_string(list_slice(list(role || ':' || length(text) ORDER BY turn), 1, 3), ',') AS members
FROM conversations GROUP BY conv_id""")
def preview(spark, sf):
    turns = table(spark, sf, "conversations").selectExpr(
        "'000001' as log_file", "conv_id as position", "'INSERT' as kind", "'chat' as db", "'turns' as `table`",
        "turn as row_no", "map('role', cast(role as variant), 'size', cast(length(text) as variant)) as row")
    members = F.transform("preview", lambda r: F.concat(r["role"].cast("string"), F.lit(":"), r["size"].cast("string")))
    return preview_changes(turns).select(
        "position", F.size("preview").alias("shown"), "more", F.array_join(members, ",").alias("members"))


def long_statements(spark, sf):
    """Every 2,500 events as the changed rows of one statement."""
    return table(spark, sf, "events").selectExpr(
        "'000001' as log_file", "event_id div 2500 as position", "'INSERT' as kind", "'shop' as db", "'visits' as `table`",
        "event_id % 2500 as row_no", "map('id', cast(event_id as variant)) as row")


@query("pack_long_statements", """SELECT event_id // 2500 AS position, (event_id % 2500) // 1000 AS chunk, CAST(count(*) AS INTEGER) AS n_rows,
  (event_id % 2500) // 1000 = max((event_id % 2500) // 1000) OVER (PARTITION BY event_id // 2500) AS last_chunk,
  min(event_id) AS first_id, max(event_id) AS last_id
FROM events GROUP BY event_id // 2500, (event_id % 2500) // 1000""")
def packed_long(spark, sf):
    ids = F.transform("rows", lambda r: r["id"].cast("bigint"))
    return pack_rows(long_statements(spark, sf), max_rows=1000).select(
        "position", "chunk", F.size("rows").alias("n_rows"), "last_chunk", F.element_at(ids, 1).alias("first_id"), F.element_at(ids, -1).alias("last_id"))


@query("preview_long_statements", """SELECT event_id // 2500 AS position, CAST(least(count(*), 3) AS INTEGER) AS shown, greatest(count(*) - 3, 0) AS more
FROM events GROUP BY ALL""")
def preview_long(spark, sf):
    return preview_changes(long_statements(spark, sf)).select("position", F.size("preview").alias("shown"), F.col("more").cast("bigint").alias("more"))


@query("truncate_query", """SELECT doc_id, substring(text, 1, 1023) AS statement, substring(text, 1, 100) AS display FROM documents""")
def truncated(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", truncate_query("text").alias("statement"), truncate_query("text", 100).alias("display"))


@query("blob_preview", """SELECT page_id, array_to_string(list_transform(
    range(0, least(200, octet_length(encode(html)))),
    lambda i: CASE WHEN substring(hex(encode(html)), CAST(2 * i + 1 AS INTEGER), 2) BETWEEN '20' AND '7E'
         THEN chr(CAST('0x' || substring(hex(encode(html)), CAST(2 * i + 1 AS INTEGER), 2) AS INTEGER)) ELSE '.' END), '') ||
  CASE WHEN octet_length(encode(html)) > 200 THEN '...' ELSE '' END AS preview
FROM pages""")
def previewed(spark, sf):
    return table(spark, sf, "pages").select("page_id", blob_preview("html").alias("preview"))


# A text, nothing, and documents that begin and end like one value but are not.
GLUED = """array({text}, '', '{"a":1}{"b":2}', '{"a":1} {"b":2}', '{"a":1} junk }', '{"a":1},{"b":2}', '{"a":1}],[{"b":2}', ' {"a":1} ')"""


def mixed_documents(spark, sf):
    """Published documents, all texts of ``documents`` (not JSON), empty ones, and documents with something glued on."""
    events = derived_events(spark, sf).select("log_file", "position", "json", "db", "table", "txn")
    texts = table(spark, sf, "documents").selectExpr(
        "doc_id as position", "text", "lang as db", "if(doc_id % 3 = 0, null, source) as `table`", "cast(null as string) as txn")
    texts = texts.select("*", F.expr(f"posexplode({GLUED.replace('{text}', 'text')}) as (_how, json)"))
    return events.unionByName(texts.selectExpr("concat('text', _how) as log_file", "position", "json", "db", "`table`", "txn"))


M = f"""{J}, M AS (
  SELECT log_file, position, json, db, "table", txn, type, kind FROM J
  UNION ALL SELECT 'text' || how, doc_id, json, lang, CASE WHEN doc_id % 3 <> 0 THEN source END, NULL, NULL, NULL FROM (
    SELECT doc_id, lang, source, unnest(range(8)) AS how, unnest({GLUED.replace('array(', '[').replace('{text}', 'text')[:-1]}]) AS json
    FROM documents))"""


@query("compact_summary", f"""WITH {M}
SELECT log_file, position, substring(CASE WHEN log_file = 'text7' THEN 'CDC: UNKNOWN db=' || coalesce(db, '?') || ' table=' || coalesce("table", '?') || ' rows=0 txn=none'
  WHEN type IS NULL THEN 'CDC event db=' || coalesce(db, '?') || ' table=' || coalesce("table", '?')
  ELSE 'CDC: ' || type || ' db=' || db || ' table=' || "table" || ' rows=' ||
       CASE WHEN kind IN ('INSERT', 'UPDATE', 'DELETE') THEN 1 ELSE 0 END || ' txn=' || coalesce(txn, 'none') END, 1, 511) AS summary
FROM M""")
def summary(spark, sf):
    return compact_summary(mixed_documents(spark, sf)).select("log_file", "position", "summary")


@query("corrupt_split", f"""WITH {M}
SELECT log_file, position, CASE WHEN json = '' THEN 'empty' ELSE 'invalid' END AS status, octet_length(encode(json)) AS bytes
FROM M WHERE type IS NULL AND log_file <> 'text7'""")
def corrupt(spark, sf):
    _, bad = split_corrupt(mixed_documents(spark, sf))
    return bad.select("log_file", "position", "status", F.octet_length("json").cast("bigint").alias("bytes"))


@query("normalize_event", f"""WITH {J}
SELECT log_file, position, type, db, CASE WHEN position % 300 = 104 THEN CASE WHEN kind IN ('QUERY', 'XID') THEN '?' ELSE "table" END
  ELSE "table" END AS "table", CASE WHEN position % 500 = 204 THEN 'none' ELSE txn END AS txn,
  CASE WHEN kind IN ('INSERT', 'UPDATE', 'DELETE') AND position % 500 <> 204 THEN 1 ELSE 0 END AS n_rows,
  position % 500 = 204 AS blank FROM (
    SELECT * REPLACE (CASE WHEN position % 500 = 204 THEN 'UNKNOWN' ELSE type END AS type,
                      CASE WHEN position % 500 = 204 THEN '?' ELSE db END AS db,
                      CASE WHEN position % 500 = 204 THEN '?' ELSE "table" END AS "table",
                      CASE WHEN position % 500 = 204 THEN 'INSERT' ELSE kind END AS kind) FROM J)""")
def normalized(spark, sf):
    records = redis_stream_records(derived_events(spark, sf))
    # Some records lack the table, some use another name for the payload, some are empty.
    varied = records.withColumn("fields", F.expr(
        """case when position % 500 = 204 then cast(map() as map<string,string>)
                when position % 300 = 104 then map_filter(fields, (k, v) -> k not in ('table', 'db'))
                when position % 300 = 204 then map('payload', fields['json'], 'db', fields['db'], 'table', fields['table'])
                else fields end"""))
    return normalize_event(varied).select(
        "log_file", "position", "type", "db", "table", "txn", "n_rows", (F.col("payload") == "{}").alias("blank"))

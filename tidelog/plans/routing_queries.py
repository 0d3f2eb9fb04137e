"""Queries over routing, topics, filters and configuration documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.decode import decode_enum, enum_values
from ..operators.filters import select_topics, size_guard, subscribe
from ..operators.routing import dispatch_counts, new_streams, route, unmatched_events, with_topic
from ..sources.config import config_document, rules_tables
from .derived_log import E, L, ROUTES, derived_events, derived_log, routes
from .registry import query, table

MATCH = "active AND L.db IS NOT NULL AND (len(databases) = 0 OR list_contains(databases, L.db))"


@query("topic_names", f"""WITH {E}
SELECT log_file, position, 'cdc.' AS kafka, 'p-' || db || '.' || "table" AS kafka_table,
  'cdc:' || db || '.' || "table" AS stream, db || '.' || "table" AS message FROM E
UNION ALL SELECT log_file, position, 'cdc.', 'p-' || coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown'),
  'cdc:' || coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown'),
  coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown') FROM L""")
def topics(spark, sf):
    cols = ["log_file", "position", "db", "table"]
    ev = derived_events(spark, sf).select(*cols).unionByName(derived_log(spark, sf).select(*cols))
    named = with_topic(with_topic(ev, "kafka", name="kafka"), "kafka", "p-", True, "kafka_table")
    named = with_topic(with_topic(named, "stream", name="stream"), "message", name="message")
    return named.select("log_file", "position", "kafka", "kafka_table", "stream", "message")


@query("route_fanout", f"""WITH {L}, {ROUTES}
SELECT log_file, position, publisher, sink FROM L JOIN ROUTES ON {MATCH}""")
def fanout(spark, sf):
    return route(derived_log(spark, sf), routes(spark)).select("log_file", "position", "publisher", "sink")


@query("dispatch_counts", f"""WITH {L}, {ROUTES}
SELECT log_file, position, db, "table", (SELECT count(*) FROM ROUTES WHERE {MATCH}) AS dispatched FROM L""")
def dispatched(spark, sf):
    return dispatch_counts(derived_log(spark, sf), routes(spark))


@query("unmatched_events", f"""WITH {L}, {ROUTES}
SELECT log_file, position, db FROM L WHERE NOT EXISTS (
  SELECT 1 FROM ROUTES WHERE sink <> 'kafka' AND {MATCH})""")
def unmatched(spark, sf):
    named = routes(spark).where("sink <> 'kafka'")
    return unmatched_events(derived_log(spark, sf), named).select("log_file", "position", "db")


@query("new_streams", f"""WITH {L}
SELECT DISTINCT 'cdc:' || coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown') AS stream FROM L
WHERE coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown') NOT IN (
  SELECT db || '.' || "table" FROM L WHERE kind = 'INSERT' AND db = 'web')""")
def streams_found(spark, sf):
    log = with_topic(derived_log(spark, sf), "stream", name="stream")
    return new_streams(log, log.where("kind = 'INSERT' and db = 'web'"))


@query("subscribe_prefix", f"""WITH {L}
SELECT log_file, position, db || '.' || coalesce("table", 'unknown') AS topic FROM L WHERE db = 'web'""")
def subscribed(spark, sf):
    messages = with_topic(derived_log(spark, sf), "message")
    return subscribe(messages, "web.").select("log_file", "position", "topic")


@query("select_topics", f"""WITH {L}, N AS (
  SELECT log_file, position, 'cdc:' || coalesce(db, 'unknown') || '.' || coalesce("table", 'unknown') AS topic FROM L)
SELECT * FROM N WHERE (topic LIKE 'cdc:w%' OR topic LIKE 'cdc:shop.ac_ount_') AND topic <> 'cdc:web.notes'""")
def topics_selected(spark, sf):
    named = with_topic(derived_log(spark, sf), "stream")
    return select_topics(named, ["cdc:w*", "cdc:shop.ac?ount?"], ["cdc:web.notes"]).select(
        "log_file", "position", "topic")


@query("size_guard", """SELECT doc_id, octet_length(encode(text)) + 1 AS bytes, octet_length(encode(text)) + 1 <= 2000 AS fits FROM documents""")
def guarded(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("json"))
    fits, oversize = size_guard(docs, 2000)
    both = fits.withColumn("fits", F.lit(True)).unionByName(oversize.withColumn("fits", F.lit(False)))
    return both.select("doc_id", (F.octet_length("json") + 1).cast("bigint").alias("bytes"), "fits")


@query("enum_dictionary", """SELECT 'shop' AS db, 'part_' || p_partkey AS "table", 'kind' AS "column", ordinal, label FROM (
  SELECT p_partkey, unnest([1, 2, 3]) AS ordinal, unnest([p_brand, p_type, 'it''s ' || p_size]) AS label FROM part)""")
def dictionary(spark, sf):
    columns = table(spark, sf, "part").selectExpr(
        "'shop' as db", "concat('part_', p_partkey) as `table`", "'kind' as `column`",
        "concat('enum(\\'', p_brand, '\\',\\'', p_type, '\\',\\'it\\'\\'s ', p_size, '\\')') as column_type")
    return enum_values(columns)


@query("enum_decode", """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ordinal,
  CASE WHEN o_orderpriority LIKE '5%' THEN '5' ELSE o_orderpriority END AS label FROM orders""")
def decoded(spark, sf):
    orders = table(spark, sf, "orders")
    ordinal = F.substring("o_orderpriority", 1, 1).cast("int")
    names = orders.where("o_orderpriority not like '5%'").select("o_orderpriority").distinct().select(
        F.lit("shop").alias("db"), F.lit("orders").alias("table"), F.lit("priority").alias("column"),
        ordinal.alias("ordinal"), F.col("o_orderpriority").alias("label"))
    raw = orders.select(
        "o_orderkey", F.lit("shop").alias("db"), F.lit("orders").alias("table"), F.lit("priority").alias("column"),
        ordinal.alias("ordinal"))
    return decode_enum(raw, names).select("o_orderkey", "ordinal", "label")


def customer_documents(spark, sf):
    """One configuration document per customer, with every spelling of a setting."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey",
        """concat('{"capture":{"databases":[{"', c_mktsegment, '":{', if(c_custkey % 3 = 0, '"capture_dml":false,', ''),
             if(c_custkey % 4 = 0, '"capture_ddl":"no",', ''), '"tables":[{"', c_name, '":{"primary_key":',
             case c_custkey % 4 when 0 then '"id"' when 1 then '["a","b"]' when 2 then '[]' else 'null' end,
             ',"columns":', case c_custkey % 3 when 0 then '["*"]' when 1 then '["x","y"]' else '[]' end,
             '}},{"', c_name, '":{"columns":["again"]}}]}},{"', c_mktsegment, '":{}},{"empty":{}}]},',
             '"publishers":[{"plugin":{"name":"n', c_nationkey, '","library_path":"lib/udp_publisher.so",',
             if(c_custkey % 2 = 0, '"active":false,', ''), '"max_queu_depth":', c_custkey % 100,
             ',"publish_databases":', if(c_custkey % 5 = 0, '[]', concat('["', c_mktsegment, '"]')),
             ',"config":{"port":', c_custkey % 1000, '}}},{"plugin":{"name":"no_library"}}]}') as doc""")


@query("rules_tables", """SELECT c_custkey, c_mktsegment AS db, c_custkey % 3 <> 0 AS capture_dml, c_custkey % 4 <> 0 AS capture_ddl,
  c_name AS "table", CASE c_custkey % 4 WHEN 0 THEN 'id' WHEN 1 THEN 'a,b' ELSE '' END AS primary_key,
  c_custkey % 3 = 0 AS all_columns, CASE c_custkey % 3 WHEN 1 THEN 'x,y' ELSE '' END AS columns FROM customer
UNION ALL SELECT c_custkey, 'empty', true, true, NULL, '', false, '' FROM customer""")
def rules_parsed(spark, sf):
    found, _ = rules_tables(customer_documents(spark, sf), keep=["c_custkey"])
    return found.select("c_custkey", "db", "capture_dml", "capture_ddl", "table",
                        F.array_join("primary_key", ",").alias("primary_key"), "all_columns",
                        F.array_join("columns", ",").alias("columns"))


@query("routes_tables", """SELECT c_custkey, 'n' || c_nationkey AS publisher, c_custkey % 2 <> 0 AS active,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS databases, 'udp' AS sink,
  CAST(c_custkey % 100 AS INTEGER) AS queue_depth, CAST(c_custkey % 1000 AS VARCHAR) AS port FROM customer""")
def routes_parsed(spark, sf):
    _, found = rules_tables(customer_documents(spark, sf), keep=["c_custkey"])
    return found.select("c_custkey", "publisher", "active", F.array_join("databases", ",").alias("databases"),
                        "sink", "queue_depth", F.col("options")["port"].alias("port"))

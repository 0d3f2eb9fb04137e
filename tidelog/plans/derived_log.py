"""A change log derived from the ``events`` table, and its rules and routes.

One event gives one log entry; ``L`` is the same rule as SQL.  All of it is a
projection of the scan, so unused columns are never read or built.
"""

from __future__ import annotations

import json
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.classify import event_kind
from ..sources.config import config_document, rules_tables
from .change_events import change_events
from .registry import table

# Users fall into five databases, events into four tables. One database has everything on, one writes
# no DDL, one no row changes, one is listed without tables, and `scratch` is not listed at all.
CONFIG_DOC = {
    "capture": {"databases": [
        {"web": {"tables": [
            {"visits": {"primary_key": "id", "columns": ["*"]}},
            {"notes": {"columns": ["created_at", "name", "id", "shade"]}},
            {"visits": {"columns": []}},  # named twice: the first entry counts
        ]}},
        {"shop": {"capture_ddl": False, "tables": [
            {"accounts": {"primary_key": ["id", "name"], "columns": ["*"]}},
            {"ledger": {}},
        ]}},
        {"billing": {"capture_dml": "no", "tables": [{"ledger": {"primary_key": ["id"], "columns": ["*"]}}]}},
        {"archive": {}},
        {"web": {"capture_dml": False}},
    ]},
    "publishers": [
        {"plugin": {"name": "files", "library_path": "lib/file_publisher.so",
                    "publish_databases": ["web", "shop", "billing"], "config": {"rotate_max_events": 100}}},
        {"plugin": {"name": "broker", "active": True, "library_path": "lib/kafka_publisher.so", "publish_databases": []}},
        {"plugin": {"name": "ledger", "library_path": "lib/mysql_publisher.so", "publish_databases": ["billing", "billing"]}},
        {"plugin": {"name": "paused", "active": False, "library_path": "lib/udp_publisher.so"}},
    ],
}

IMAGE = """map(
    'id', cast(user_id as variant), 'name', cast(event_type as variant),
    'created_at', cast(ts as variant), 'value', cast(value - {less} as variant),
    'props', parse_json(props))"""


def derived_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log: place, kind, names, statement, commit number and row images."""
    return log_of(table(spark, sf_dir, "events"))


def log_of(events: DataFrame) -> DataFrame:
    """The same for any batch or stream of ``events`` rows."""
    ddl = "(event_type = 'error' and event_id % 4 = 0)"
    shaped = events.selectExpr(
        "event_id as seq",
        "ts",
        "cast(event_id div 1000 + 1 as string) as _file",
        "4 + (event_id % 1000) * 100 as position",
        f"""cast(case when event_type = 'view' or {ddl} then 2
                 when event_type = 'purchase' then 16
                 when event_type = 'signup' then element_at(array(23, 30, 166), cast(event_id % 3 + 1 as int))
                 when event_type = 'click' then element_at(array(24, 31, 167), cast(event_id % 3 + 1 as int))
                 else element_at(array(25, 32, 168), cast(event_id % 3 + 1 as int)) end as int) as code""",
        """case when event_type in ('view', 'purchase') then null
                else element_at(array('web', 'shop', 'billing', 'archive', 'scratch'), cast(user_id % 5 + 1 as int)) end as db""",
        f"""case when event_type in ('view', 'purchase') or {ddl} then null
                 else element_at(array('visits', 'accounts', 'ledger', 'notes'), cast(event_id % 4 + 1 as int))
            end as `table`""",
        f"""case when event_type = 'view' then 'BEGIN'
                 when {ddl} then element_at(array('ALTER TABLE t', concat('create table t', repeat(' (note text)', 120)), 'DROP TABLE t', 'Truncate t',
                                                  'RENAME t'), cast(event_id % 5 + 1 as int)) end as query""",
        "cast(case when event_type = 'purchase' then event_id end as decimal(20,0)) as xid",
        f"""case when event_type = 'click' then
                 array(map('before', to_variant_object({IMAGE.format(less=1)}),
                           'after', to_variant_object({IMAGE.format(less=0)})))
                 when event_type = 'signup' or (event_type = 'error' and not {ddl})
                 then array({IMAGE.format(less=0)}) end as rows""",
    )
    return shaped.withColumns({
        "log_file": F.expr("lpad(_file, greatest(6, length(_file)), '0')"),
        "kind": event_kind("code"),
    }).drop("_file")


def config_docs(spark: SparkSession) -> DataFrame:
    return config_document(spark, json.dumps(CONFIG_DOC))


@cache
def rules(spark: SparkSession) -> DataFrame:
    return rules_tables(config_docs(spark))[0]


@cache
def routes(spark: SparkSession) -> DataFrame:
    return rules_tables(config_docs(spark))[1]


def derived_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published change events of the derived log."""
    return change_events(derived_log(spark, sf_dir), rules(spark))


# --- The same rules as SQL ------------------------------------------------------
L = """L AS (
  SELECT event_id AS seq, ts, user_id, event_type, value, props,
    lpad(CAST(event_id // 1000 + 1 AS VARCHAR), CAST(greatest(6, length(CAST(event_id // 1000 + 1 AS VARCHAR))) AS INTEGER), '0') AS log_file,
    event_id // 1000 + 1 AS file_no,
    4 + (event_id % 1000) * 100 AS position,
    CAST(CASE WHEN event_type = 'view' OR (event_type = 'error' AND event_id % 4 = 0) THEN 2
         WHEN event_type = 'purchase' THEN 16
         WHEN event_type = 'signup' THEN CASE event_id % 3 WHEN 0 THEN 23 WHEN 1 THEN 30 ELSE 166 END
         WHEN event_type = 'click' THEN CASE event_id % 3 WHEN 0 THEN 24 WHEN 1 THEN 31 ELSE 167 END
         ELSE CASE event_id % 3 WHEN 0 THEN 25 WHEN 1 THEN 32 ELSE 168 END END AS INTEGER) AS code,
    CASE WHEN event_type = 'view' OR (event_type = 'error' AND event_id % 4 = 0) THEN 'QUERY'
         WHEN event_type = 'purchase' THEN 'XID' WHEN event_type = 'signup' THEN 'INSERT'
         WHEN event_type = 'click' THEN 'UPDATE' ELSE 'DELETE' END AS kind,
    CASE WHEN event_type NOT IN ('view', 'purchase') THEN
         CASE user_id % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'shop' WHEN 2 THEN 'billing' WHEN 3 THEN 'archive' ELSE 'scratch' END END AS db,
    CASE WHEN event_type IN ('view', 'purchase') OR (event_type = 'error' AND event_id % 4 = 0) THEN NULL
         ELSE CASE event_id % 4 WHEN 0 THEN 'visits' WHEN 1 THEN 'accounts' WHEN 2 THEN 'ledger' ELSE 'notes' END END AS "table",
    CASE WHEN event_type = 'view' THEN 'BEGIN' WHEN event_type = 'error' AND event_id % 4 = 0 THEN
         CASE event_id % 5 WHEN 0 THEN 'ALTER TABLE t' WHEN 1 THEN 'create table t' || repeat(' (note text)', 120) WHEN 2 THEN 'DROP TABLE t'
              WHEN 3 THEN 'Truncate t' ELSE 'RENAME t' END END AS query,
    CASE WHEN event_type = 'purchase' THEN event_id END AS xid
  FROM events)"""

RULES = """RULES(db, "table", capture_dml, capture_ddl, primary_key, all_columns, columns) AS (VALUES
  ('web', 'visits', true, true, ['id'], true, CAST([] AS VARCHAR[])),
  ('web', 'notes', true, true, CAST([] AS VARCHAR[]), false, ['created_at', 'name', 'id', 'shade']),
  ('shop', 'accounts', true, false, ['id', 'name'], true, []),
  ('shop', 'ledger', true, false, [], false, []),
  ('billing', 'ledger', false, true, ['id'], true, []),
  ('archive', NULL, true, true, [], false, []))"""

ROUTES = """ROUTES(publisher, active, databases, sink) AS (VALUES
  ('files', true, ['web', 'shop', 'billing'], 'file'),
  ('broker', true, CAST([] AS VARCHAR[]), 'kafka'),
  ('ledger', true, ['billing', 'billing'], 'mysql'),
  ('paused', false, CAST([] AS VARCHAR[]), 'udp'))"""

# Transactions: one running state over the whole log, read directly off the rules.
T = f"""{L}, {RULES},
C AS (
  SELECT L.*, r.capture_dml IS NOT NULL AND r.capture_dml AND kind IN ('INSERT', 'UPDATE', 'DELETE') AS captured,
    r.primary_key, r.all_columns, r.columns
  FROM L LEFT JOIN RULES r ON L.db = r.db AND L."table" = r."table"),
G AS (
  SELECT *, CASE WHEN query = 'BEGIN' THEN 'begin' WHEN kind = 'XID' THEN 'close' WHEN captured THEN 'row'
                 WHEN kind = 'QUERY' THEN 'statement' ELSE 'none' END AS signal
  FROM C),
W AS (
  SELECT *,
    coalesce(last_value(CASE WHEN signal IN ('begin', 'row') THEN true WHEN signal = 'close' THEN false END IGNORE NULLS) OVER w, false) AS in_txn,
    last_value(CASE WHEN signal IN ('begin', 'close') THEN signal END IGNORE NULLS) OVER w AS edge,
    last_value(CASE WHEN signal IN ('begin', 'close') THEN file_no END IGNORE NULLS) OVER w AS edge_file,
    last_value(CASE WHEN signal IN ('begin', 'close') THEN position END IGNORE NULLS) OVER w AS edge_pos,
    last_value(db IGNORE NULLS) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS any_db,
    last_value(CASE WHEN kind IN ('INSERT', 'UPDATE', 'DELETE') THEN db END IGNORE NULLS) OVER w AS map_db
  FROM G
  WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
K AS (
  SELECT *, md5(CASE
      WHEN signal = 'begin' OR (signal = 'statement' AND NOT in_txn) THEN 'log|at|' || file_no || '|' || position
      WHEN (in_txn AND signal <> 'none') OR signal = 'row' THEN
        'log|' || CASE WHEN edge = 'begin' THEN 'at' ELSE 'after' END || '|' || coalesce(edge_file, -1) || '|' || coalesce(edge_pos, -1)
      END) AS digest
  FROM W),
T AS (
  SELECT *, substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4) || '-' ||
            substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS txn
  FROM K)"""

# Published events with routing names; E is what every sink reads.
E = f"""{T},
E AS (
  SELECT T.* EXCLUDE (db, "table"),
    CASE WHEN kind = 'XID' THEN map_db ELSE db END AS db,
    CASE WHEN kind = 'XID' THEN 'COMMIT' WHEN kind = 'QUERY' THEN upper(split_part(query, ' ', 1)) ELSE "table" END AS "table",
    CASE WHEN kind = 'XID' THEN 'COMMIT' WHEN kind = 'QUERY' THEN upper(split_part(query, ' ', 1)) ELSE kind END AS type
  FROM T
  WHERE captured
     OR (kind = 'QUERY' AND query <> 'BEGIN' AND db IN (SELECT db FROM RULES WHERE capture_ddl))
     OR (kind = 'XID' AND txn IS NOT NULL AND map_db IN (SELECT db FROM RULES WHERE capture_ddl)))"""

# The document of each published event, as text.
_FULL = """'"id":' || user_id || ',"name":"' || event_type || '","created_at":"' || CAST(ts AS VARCHAR) || '","value":' || CAST(value AS VARCHAR) || ',"props":' || replace(props, ' ', '')"""
_SOME = """'"id":' || user_id || ',"name":"' || event_type || '","created_at":"' || CAST(ts AS VARCHAR) || '"'"""
_SORTED = """'"created_at":"' || CAST(ts AS VARCHAR) || '","id":' || user_id || ',"name":"' || event_type || '","props":' || replace(props, ' ', '') || ',"value":' || CAST(value - {less} AS VARCHAR)"""
_SORTED_SOME = """'"created_at":"' || CAST(ts AS VARCHAR) || '","id":' || user_id || ',"name":"' || event_type || '"'"""

J = f"""{E},
IMG AS (
  SELECT *,
    CASE WHEN all_columns THEN {_FULL} WHEN len(columns) > 0 THEN {_SOME} ELSE '' END AS image,
    CASE WHEN all_columns THEN {_SORTED.format(less=0)} WHEN len(columns) > 0 THEN {_SORTED_SOME} ELSE '' END AS new_image,
    CASE WHEN all_columns THEN {_SORTED.format(less=1)} WHEN len(columns) > 0 THEN {_SORTED_SOME} ELSE '' END AS old_image
  FROM E),
J AS (
  SELECT *, '{{"type":"' || type || '","txn":"' || txn || '","db":"' || db || '"' ||
    CASE WHEN kind = 'XID' THEN ',"xid":' || xid
         WHEN kind = 'QUERY' THEN ',"query":"' || query || '"'
         ELSE ',"table":"' || "table" || '"' ||
           CASE WHEN len(primary_key) > 0 THEN ',"primary_key":["' || array_to_string(primary_key, '","') || '"]' ELSE '' END ||
           ',"rows":[{{' || CASE WHEN kind = 'UPDATE'
             THEN '"before":{{' || old_image || '}},"after":{{' || new_image || '}}' ELSE image END || '}}]' END || '}}' AS json
  FROM IMG)"""

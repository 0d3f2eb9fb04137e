"""Schemas and the fixed values shared by every operator."""

from __future__ import annotations

# --- Fixed values: numeric replication event codes, grouped by kind ---------
EVENT_CODES = {
    "QUERY": [2],
    "ROTATE": [4],
    "FORMAT": [15],
    "XID": [16],
    "TABLE_MAP": [19],
    "INSERT": [23, 30, 166],
    "UPDATE": [24, 31, 167],
    "DELETE": [25, 32, 168],
}

# --- Fixed values: statement classes, tested as prefixes in this order ------
STATEMENT_CLASSES = [
    "BEGIN", "COMMIT", "ROLLBACK",
    "CREATE", "ALTER", "DROP", "TRUNCATE", "RENAME",
]
DDL_CLASSES = ["CREATE", "ALTER", "DROP", "TRUNCATE", "RENAME"]

# --- Fixed values: row-change kinds ----------------------------------------
DML_KINDS = ["INSERT", "UPDATE", "DELETE"]
ROW_KINDS = ["TABLE_MAP", *DML_KINDS]

# --- Fixed values: sizes and default names ----------------------------------
MAX_DATAGRAM = 65507
MAX_QUERY_CHARS = 1023
MAX_SUMMARY_CHARS = 511
FIRST_POSITION = 4
UNKNOWN_FILE = "<unknown>"
KAFKA_PREFIX = "cdc."
STREAM_PREFIX = "cdc:"
PUBSUB_CHANNEL = "cdc_events"

# --- Fixed values: key names of the payload document ------------------------
# VARIANT keeps numbers, strings and
# nulls apart; keys that a given event type does not have parse as null.
PAYLOAD = (
    "type STRING, txn STRING, db STRING, `table` STRING, "
    "primary_key ARRAY<STRING>, rows ARRAY<MAP<STRING,VARIANT>>, "
    "query STRING, xid DECIMAL(20,0)"
)

# What a delivery attempt reports back.
DELIVERIES = (
    "publisher STRING, log_file STRING, position BIGINT, ok BOOLEAN, "
    "dropped BOOLEAN, attempts INT, status INT, bytes BIGINT, error STRING"
)

# --- Fixed values: key names of the configuration document ------------------
# Fields that may hold more
# than one JSON type are read as text and interpreted afterwards.
CONFIG = (
    "capture STRUCT<databases: ARRAY<MAP<STRING, STRUCT<"
    "capture_dml: STRING, capture_ddl: STRING, "
    "tables: ARRAY<MAP<STRING, STRUCT<primary_key: STRING, columns: STRING>>>>>>>, "
    "publishers ARRAY<STRUCT<plugin: STRUCT<"
    "name: STRING, active: STRING, library_path: STRING, max_queu_depth: STRING, "
    "publish_databases: STRING, config: MAP<STRING, STRING>>>>"
)

"""One JSON document per change event, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import DML_KINDS, PAYLOAD
from .classify import classify_query, is_ddl


def event_type() -> Column:
    """Payload type: the row kind, the statement class, or COMMIT for an XID."""
    kind = F.col("kind")
    return (
        F.when(kind.isin(DML_KINDS), kind)
        .when(kind == "XID", "COMMIT")
        .when(kind == "QUERY", classify_query("query"))
    )


def to_envelope(ev: DataFrame, max_query_chars: int | None = None) -> DataFrame:
    """Add ``type`` and ``json``.

    ``to_json`` drops null *struct* fields, so a key that an event type does
    not have is absent; null *map* values, i.e. null columns of a row image,
    stay.  DDL and COMMIT documents carry no ``table`` key.  Statements are whole
    unless ``max_query_chars`` asks for their beginnings.
    """
    cols = ev.columns
    dml = F.col("type").isin(DML_KINDS)
    nothing = F.lit(None)
    statement = F.col("query") if max_query_chars is None else F.substring("query", 1, max_query_chars)
    body = F.struct(
        "type",
        "txn",
        "db",
        F.when(dml, F.col("table")).alias("table"),
        (F.when(dml & (F.size("primary_key") > 0), F.col("primary_key"))
         if "primary_key" in cols else nothing.cast("array<string>")).alias("primary_key"),
        F.when(dml, F.coalesce("rows", F.array().cast("array<map<string,variant>>"))).alias("rows"),
        F.when(is_ddl("type"), statement).alias("query"),
        F.when(F.col("type") == "COMMIT", F.col("xid")).alias("xid"),
    )
    return ev.withColumn("type", event_type()).withColumn("json", F.to_json(body))


def parse_envelope(json: Column | str) -> Column:
    """Struct of the payload document; wrong or missing keys are null."""
    return F.from_json(json, PAYLOAD, {"mode": "PERMISSIVE"})

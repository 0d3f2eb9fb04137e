"""Capture rules: which events, which columns, which keys.

Rules are a table, so every filter is an equi-join on ``db`` or ``(db, table)``.
No join is forced to broadcast: the optimizer broadcasts the rule side while it
is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it, where
adaptive skew handling splits a hot database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import classify_query, is_ddl
from ..schemas import DML_KINDS, ROW_KINDS


def _tables(rules: DataFrame, *cols: str | Column) -> DataFrame:
    return rules.where("`table` is not null and capture_dml").select("db", "table", *cols)


def _databases(rules: DataFrame) -> DataFrame:
    return rules.groupBy("db").agg(F.bool_or("capture_ddl").alias("capture_ddl"))


def capture_tables(ev: DataFrame, rules: DataFrame) -> DataFrame:
    """Row events of captured tables in databases with DML capture."""
    return ev.where(F.col("kind").isin(DML_KINDS)).join(_tables(rules), ["db", "table"], "left_semi")


def flag_captured(ev: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``captured`` to every event, keeping all of them."""
    marks = _tables(rules).withColumn("_hit", F.lit(True))
    row = F.col("kind").isin(ROW_KINDS)
    return (
        ev.join(marks, ["db", "table"], "left")
        .withColumn("captured", row & F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def emit_only(assigned: DataFrame, rules: DataFrame) -> DataFrame:
    """The events that are published, with their routing ``db`` and ``table``.

    Captured row events; DDL with a database whose DDL capture is on; commit
    markers inside a transaction whose latest row event was in such a database.
    Plain statements and BEGIN/COMMIT/ROLLBACK statements only move state.
    """
    kind, cls = F.col("kind"), classify_query("query")
    ddl = (kind == "QUERY") & is_ddl(cls)
    commit = (kind == "XID") & F.col("txn").isNotNull()
    routed = assigned.where(
        (kind.isin(DML_KINDS) & F.col("captured")) | ddl | commit
    ).withColumns({
        "db": F.when(kind == "XID", F.col("map_db")).otherwise(F.col("db")),
        "table": F.when(kind == "XID", "COMMIT").when(kind == "QUERY", cls).otherwise(F.col("table")),
    }).where(kind.isin(DML_KINDS) | (F.length("db") > 0))
    gated = routed.join(_databases(rules), "db", "left")
    return gated.where(
        F.col("kind").isin(DML_KINDS) | F.coalesce("capture_ddl", F.lit(False))
    ).drop("capture_ddl")


def _kept_rows() -> Column:
    """Row images cut to ``_columns``, in table order; all of them for ``all_columns``."""

    def keep(image):
        return F.map_filter(image, lambda k, v: F.array_contains("_columns", k))

    def pair(row):
        return F.transform_values(row, lambda k, v: F.to_variant_object(keep(v.cast("map<string,variant>"))))

    return (
        F.when(F.col("_all"), F.col("rows"))
        .when(F.col("kind") == "UPDATE", F.transform("rows", pair))
        .otherwise(F.transform("rows", keep))
    )


def _choices(rules: DataFrame) -> DataFrame:
    return _tables(rules, F.col("all_columns").alias("_all"), F.col("columns").alias("_columns"))


def project_columns(ev: DataFrame, rules: DataFrame) -> DataFrame:
    """Keep the configured columns of each row image, in table order.

    ``all_columns`` keeps everything; a captured table with neither gives empty
    rows.  Events of other tables are left as they are.
    """
    joined = ev.join(_choices(rules), ["db", "table"], "left")
    return joined.withColumn(
        "rows", F.when(F.col("_all").isNull(), F.col("rows")).otherwise(_kept_rows())
    ).drop("_all", "_columns")


def prepare_rows(ev: DataFrame, rules: DataFrame) -> DataFrame:
    """``flag_captured`` and ``project_columns`` in one join, for use before a shuffle.

    Row events that are not captured still move transaction state, so they stay,
    but without their images.
    """
    if "rows" not in ev.columns:
        return flag_captured(ev, rules)
    joined = ev.join(_choices(rules), ["db", "table"], "left")
    captured = F.col("kind").isin(ROW_KINDS) & F.col("_all").isNotNull()
    return joined.withColumns({
        "captured": captured,
        "rows": F.when(captured, _kept_rows()),
    }).drop("_all", "_columns")


def missing_columns(rules: DataFrame, table_columns: DataFrame) -> DataFrame:
    """Configured columns the table does not have."""
    named = rules.where("not all_columns").select("db", "table", F.explode("columns").alias("column"))
    known = table_columns.select("db", "table", F.col("name").alias("column")).distinct()
    return named.join(known, ["db", "table", "column"], "left_anti")


def with_primary_key(ev: DataFrame, rules: DataFrame) -> DataFrame:
    """Attach the configured ``primary_key``; null where none is configured."""
    keys = _tables(rules, "primary_key").where(F.size("primary_key") > 0)
    return ev.drop("primary_key").join(keys, ["db", "table"], "left")

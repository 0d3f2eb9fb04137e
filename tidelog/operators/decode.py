"""Typed decoding of raw column tables and ENUM dictionaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import blob_preview
from ..functions.values import as_unsigned, datetime2, fixed6, int24, timestamp2


@dataclass(frozen=True)
class ColumnType:
    """Declared type of one column: name, type, and its modifiers."""

    name: str
    mysql_type: str
    unsigned: bool = False
    fsp: int = 0
    preview: bool = False
    text: bool = False


def decode_value(raw: Column, t: ColumnType) -> Column:
    """Expression for one raw value; types without a rule pass through."""
    kind = t.mysql_type.upper()
    if kind == "TINY":
        return raw.cast("smallint").bitwiseAND(F.lit(255).cast("smallint")) if t.unsigned else raw.cast("tinyint")
    if kind == "SHORT":
        return raw.cast("int").bitwiseAND(F.lit(65535)) if t.unsigned else raw.cast("smallint")
    if kind == "INT24":
        return raw.cast("int").bitwiseAND(F.lit(0xFFFFFF)) if t.unsigned else int24(raw)
    if kind == "LONG":
        return as_unsigned(raw, 32) if t.unsigned else raw.cast("int")
    if kind == "LONGLONG":
        return as_unsigned(raw, 64) if t.unsigned else raw.cast("bigint")
    if kind == "YEAR":
        year = raw.cast("int").bitwiseAND(F.lit(255))
        return F.when(year == 0, F.lit(0)).otherwise(year + 1900).cast("smallint")
    if kind in ("FLOAT", "DOUBLE"):
        return fixed6(raw) if t.text else raw
    if kind == "TIMESTAMP":
        return timestamp2(raw)
    if kind == "TIMESTAMP2":
        def number(at, n):
            return F.conv(F.hex(F.substring(raw, at, n)), 16, 10)
        width = (t.fsp + 1) // 2
        return timestamp2(number(1, 4), number(5, width) if width else None, t.fsp)
    if kind == "DATETIME2":
        return datetime2(raw, t.fsp)
    if kind in ("VARCHAR", "STRING", "CHAR"):
        return raw.cast("string")
    if kind in ("BLOB", "TEXT") and t.preview:
        return blob_preview(raw)
    return raw


def decode_columns(df: DataFrame, types: list[ColumnType], enums: DataFrame | None = None,
                   db: str | None = None, table: str | None = None) -> DataFrame:
    """Decode a table of raw values in one ``select``, then look up ENUM labels.

    Columns without a declared type pass through unchanged.
    """
    declared = {t.name: t for t in types}
    out = df.select(*[
        decode_value(F.col(c), declared[c]).alias(c) if c in declared else F.col(c) for c in df.columns
    ])
    for t in types:
        if t.mysql_type.upper() == "ENUM" and enums is not None:
            labels = enums.where(
                (F.col("db") == db) & (F.col("table") == table) & (F.col("column") == t.name)
            ).select(F.col("ordinal").alias("_ordinal"), F.col("label").alias("_label"))
            out = out.join(labels, F.col(t.name) == F.col("_ordinal"), "left").withColumn(
                t.name, F.coalesce("_label", F.col(t.name).cast("string"))
            ).drop("_ordinal", "_label")
    return out.select(*df.columns)


def enum_values(columns: DataFrame) -> DataFrame:
    """Labels of every ENUM column from its type text ``enum('a','b')``.

    A doubled quote inside a label stands for one quote.
    """
    labels = F.expr(r"regexp_extract_all(column_type, '\'((?:[^\']|\'\')*)\'', 1)")
    return (
        columns.where(F.lower("column_type").startswith("enum("))
        .select("db", "table", "column", F.posexplode(labels).alias("_at", "_label"))
        .select("db", "table", "column", (F.col("_at") + 1).alias("ordinal"),
                F.replace("_label", F.lit("''"), F.lit("'")).alias("label"))
    )


def decode_enum(df: DataFrame, enums: DataFrame, ordinal: str = "ordinal", name: str = "label") -> DataFrame:
    """Add the label of ``(db, table, column, ordinal)``; its number as text if unknown.

    The join is the optimizer's choice: adaptive execution broadcasts a dictionary
    that turns out small and splits a hot ordinal of a large one.
    """
    keys = ["db", "table", "column"]
    labels = enums.select(*keys, F.col("ordinal").alias(ordinal), F.col("label").alias("_label"))
    return df.join(labels, [*keys, ordinal], "left").withColumn(
        name, F.coalesce("_label", F.col(ordinal).cast("string"))
    ).drop("_label")

"""Display text: previews, truncations and one-line summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import MAX_QUERY_CHARS, MAX_SUMMARY_CHARS
from .classify import _col
from .documents import parse_document


def blob_preview(c: Column | str, n: int = 200) -> Column:
    """First ``n`` bytes with everything outside printable ASCII as a dot."""
    raw = _col(c).cast("binary")
    head = F.regexp_replace(F.decode(F.substring(raw, 1, n), "ISO-8859-1"), "[^ -~]", ".")
    return F.when(F.octet_length(raw) > n, F.concat(head, F.lit("..."))).otherwise(head)


def truncate_query(c: Column | str, n: int = MAX_QUERY_CHARS) -> Column:
    return F.substring(_col(c), 1, n)


def short_txn(c: Column | str, n: int = 8) -> Column:
    return F.substring(_col(c), 1, n)


def compact_summary(ev: DataFrame, name: str = "summary") -> DataFrame:
    """Add the one-line summary of each event's ``json``.

    A document that does not parse still gets a line.  Values missing from the
    event read ``?`` (db, table), ``none`` (txn), ``UNKNOWN`` (type) or 0 (rows).
    """
    doc = F.col("_doc")
    rows = F.try_variant_get(doc, "$.rows", "array<variant>")
    db, table = F.coalesce("db", F.lit("?")), F.coalesce("table", F.lit("?"))
    full = F.format_string(
        "CDC: %s db=%s table=%s rows=%d txn=%s",
        F.coalesce(F.try_variant_get(doc, "$.type", "string"), F.lit("UNKNOWN")),
        db, table,
        F.coalesce(F.size(rows), F.lit(0)),
        F.coalesce("txn", F.lit("none")),
    )
    bare = F.format_string("CDC event db=%s table=%s", db, table)
    line = F.when(doc.isNull(), bare).otherwise(full)
    parsed = ev.withColumn("_doc", parse_document("json"))
    return parsed.withColumn(name, F.substring(line, 1, MAX_SUMMARY_CHARS)).drop("_doc")

"""Statement and event-code classification."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import DDL_CLASSES, EVENT_CODES, STATEMENT_CLASSES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_query(query: Column | str) -> Column:
    """Class of a statement by case-insensitive prefix, ``QUERY`` otherwise.

    There is no trimming and no word boundary: ``" BEGIN"`` is a plain
    statement and ``BEGINNING`` is a ``BEGIN``.
    """
    if isinstance(query, str):
        # Upper case never has fewer characters, so the beginning of a long statement is enough.
        start = f"upper(left(`{query}`, {max(map(len, STATEMENT_CLASSES))}))"
        cases = " ".join(f"WHEN {start} LIKE '{name}%' THEN '{name}'" for name in STATEMENT_CLASSES)
        return F.expr(f"CASE WHEN `{query}` IS NULL THEN NULL {cases} ELSE 'QUERY' END")
    text = F.upper(query)
    result = F.lit("QUERY")
    for name in reversed(STATEMENT_CLASSES):
        result = F.when(text.startswith(name), F.lit(name)).otherwise(result)
    return F.when(text.isNotNull(), result)


def is_ddl(statement_class: Column | str) -> Column:
    return _col(statement_class).isin(DDL_CLASSES)


def event_kind(code: Column | str) -> Column:
    """Kind of a numeric event code; null for codes that are not processed."""
    c = _col(code)
    result = None
    for kind, codes in EVENT_CODES.items():
        hit = c.isin(codes)
        result = F.when(hit, kind) if result is None else result.when(hit, kind)
    return result

"""Size, subscription, topic and corruption filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.documents import document_status, once, parse_document
from ..schemas import MAX_DATAGRAM


def packet_bytes(newline: bool = True) -> Column:
    """Bytes of the UTF-8 document plus its line end."""
    return F.octet_length("json") + (1 if newline else 0)


def datagram_limit(setting: int | None) -> int:
    """A usable size limit; anything out of range means the default."""
    return setting if setting is not None and 0 < setting <= MAX_DATAGRAM else MAX_DATAGRAM


def size_guard(ev: DataFrame, max_bytes: int | None = None, newline: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split events into those that fit one datagram and those that do not."""
    fits = F.coalesce(packet_bytes(newline) <= datagram_limit(max_bytes), F.lit(False))
    return ev.where(fits), ev.where(~fits)


def subscribe(ev: DataFrame, prefix: str = "", column: str = "topic") -> DataFrame:
    """Messages whose topic starts with ``prefix``; the empty prefix takes all."""
    return ev.where(F.col(column).startswith(prefix)) if prefix else ev


def glob_pattern(glob: str) -> str:
    """Anchored regular expression of a ``*`` / ``?`` pattern."""
    parts = {"*": ".*", "?": "."}
    return "(?s)^" + "".join(parts.get(ch, re.escape(ch)) for ch in glob) + "$"


def select_topics(
    df: DataFrame,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    column: str = "topic",
) -> DataFrame:
    """Topics matching any include pattern (none = all) and not excluded by name."""
    c = F.col(column)
    if include:
        hit = F.lit(False)
        for glob in include:
            hit = hit | c.rlike(glob_pattern(glob))
        df = df.where(hit)
    return df.where(~c.isin(list(exclude))) if exclude else df


def payload_status(json: Column | str = "json") -> Column:
    """``ok``, ``empty`` (nothing, ``{}`` or ``null``) or ``invalid`` (not a JSON object)."""

    document = F.col(json) if isinstance(json, str) else json
    return once(document, lambda text: document_status(text, parse_document(text)))


def split_corrupt(raw: DataFrame, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """Split documents into usable ones and a quarantine with the reason."""
    marked = raw.withColumn("status", payload_status(column))
    return marked.where("status = 'ok'").drop("status"), marked.where("status <> 'ok'")

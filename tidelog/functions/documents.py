"""Strict parsing of JSON documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used and wherever the optimizer moves it."""
    return F.transform(F.array(value), then)[0]


def parse_document(text: Column | str) -> Column:
    """VARIANT of a JSON text; null for anything that is not exactly one JSON value.

    The parser stops after the first complete value, so the text is parsed as the
    first element of an array that ends with a digest of the text: only if the
    digest is element 1 and the last one, the text was one value from end to end.
    """
    def parsed(t: Column) -> Column:
        digest = F.md5(t.cast("binary"))
        both = F.try_parse_json(F.concat(F.lit("["), t, F.lit(',"'), digest, F.lit('"]')))
        whole = lambda b: F.try_variant_get(b, "$[1]", "string").eqNullSafe(digest) & F.try_variant_get(b, "$[2]", "variant").isNull()
        return once(both, lambda b: F.when(whole(b), F.try_variant_get(b, "$[0]", "variant")))

    return once(F.col(text) if isinstance(text, str) else text, parsed)


def document_status(text: Column, document: Column) -> Column:
    """``ok``, ``empty`` (nothing, ``{}`` or ``null``) or ``invalid`` (not a JSON object) of a text and its parsed document."""
    # The text of a document that could be parsed tells its type by its beginning.
    return once(document.isNotNull(), lambda parsed: (
        F.when(text.isNull() | text.rlike(r"^\s*$") | parsed & text.rlike(r"^\s*(null|\{\s*\})\s*$"), "empty")
        .when(parsed & text.rlike(r"^\s*\{"), "ok")
        .otherwise("invalid")
    ))

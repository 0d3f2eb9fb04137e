"""Row images: packing, flattening, differences, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.documents import parse_document

IMAGE = "map<string,variant>"


def pack_rows(changes: DataFrame, max_rows: int) -> DataFrame:
    """Gather single-row changes of one statement into multi-row events.

    ``changes`` has ``log_file, position, kind, db, table, row_no, row``; ``row_no``
    counts from 0 inside the statement.  A long statement becomes several
    events of at most ``max_rows`` rows, numbered by ``chunk``; the chunk is part
    of the grouping key, so no task ever gathers more than that.  ``last_chunk``
    marks the end of a statement.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    keyed = changes.withColumn("chunk", F.floor(F.col("row_no") / max_rows))
    ends = keyed.groupBy("log_file", "position").agg(F.max("chunk").alias("_end"))
    gathered = keyed.groupBy("log_file", "position", "kind", "db", "table", "chunk").agg(
        F.collect_list(F.struct("row_no", "row")).alias("_items")
    )
    # VARIANT has no order, so rows are compared by number only.
    ordered = F.array_sort("_items", lambda a, b: (a["row_no"] - b["row_no"]).cast("int"))
    packed = gathered.withColumn("rows", F.transform(ordered, lambda i: i["row"])).drop("_items")
    return packed.join(ends, ["log_file", "position"]).withColumn("last_chunk", F.col("chunk") == F.col("_end")).drop("_end")


def preview_changes(changes: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` row images of each statement of ``changes`` and how many more there are.

    Rows carry their number, so only the first ``n`` are gathered; the others are counted.
    """
    shown = F.when(F.col("row_no") < n, F.struct("row_no", "row"))
    found = changes.groupBy("log_file", "position", "kind", "db", "table").agg(
        F.collect_list(shown).alias("_items"), F.count("*").alias("_n"))
    ordered = F.array_sort("_items", lambda a, b: (a["row_no"] - b["row_no"]).cast("int"))
    return found.withColumns({
        "preview": F.transform(ordered, lambda i: i["row"]),
        "more": F.greatest(F.col("_n") - n, F.lit(0)),
    }).drop("_items", "_n")


def explode_rows(ev: DataFrame) -> DataFrame:
    """One output row per row image: ``row_no`` with ``before`` and ``after``.

    INSERT has only ``after``, DELETE only ``before``, UPDATE both.
    """
    flat = ev.where(F.col("kind").isin("INSERT", "UPDATE", "DELETE")).select(
        *[c for c in ev.columns if c not in ("rows", "json")],
        F.posexplode("rows").alias("row_no", "_row"),
    )
    update = F.col("kind") == "UPDATE"
    return flat.withColumns({
        "before": F.when(update, F.col("_row")["before"].cast(IMAGE)).when(F.col("kind") == "DELETE", F.col("_row")),
        "after": F.when(update, F.col("_row")["after"].cast(IMAGE)).when(F.col("kind") == "INSERT", F.col("_row")),
    }).drop("_row")


def _same(a: Column, b: Column) -> Column:
    """Whether two VARIANTs hold the same value; numbers compare by value, whatever their type.

    Whole numbers and decimals compare by all their digits; only with a binary fraction on one side both are
    taken as such. Text that looks like a number stays text.
    """
    def number(v: Column) -> Column:
        return F.when(F.schema_of_variant(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"),
                      F.try_variant_get(v, "$", "double"))

    def digits(v: Column) -> Column:
        # Without the zeros that only the scale of a decimal adds.
        return F.when(F.schema_of_variant(v).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*)$"),
                      F.regexp_replace(F.regexp_replace(F.to_json(v), r"(\.[0-9]*?)0+$", "$1"), r"\.$", ""))

    exact = F.to_json(a).eqNullSafe(F.to_json(b))
    whole = F.schema_of_variant(a) == F.schema_of_variant(b)
    equal = F.coalesce(digits(a) == digits(b), number(a) == number(b), F.lit(False))
    return exact | (~F.coalesce(whole, F.lit(False)) & equal)


def differing_keys(before: Column, after: Column) -> Column:
    """Keys of both images whose values differ, nulls comparing equal."""
    changed = F.map_filter(after, lambda k, v: F.map_contains_key(before, k) & ~_same(v, before[k]))
    return F.map_keys(changed)


def changed_fields(rows: DataFrame) -> DataFrame:
    """One row per changed field of each UPDATE row, with both values as text."""
    keep = [c for c in rows.columns if c not in ("before", "after")]
    pairs = rows.where("before is not null and after is not null").withColumn(
        "field", F.explode(differing_keys(F.col("before"), F.col("after")))
    )
    return pairs.select(
        *keep, "field",
        F.col("before")[F.col("field")].cast("string").alias("old_value"),
        F.col("after")[F.col("field")].cast("string").alias("new_value"),
    )


def preview_rows(ev: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` row images and how many more there are."""
    return ev.withColumns({
        "preview": F.slice("rows", 1, n),
        "more": F.greatest(F.coalesce(F.size("rows"), F.lit(0)) - n, F.lit(0)),
    })


def normalize_event(records: DataFrame, fields: str = "fields") -> DataFrame:
    """Fields of a stream record with the consumers' precedence.

    The payload is the ``json`` field, else the first field, else an empty
    document.  ``db``, ``table`` and ``txn`` come from the record, else from the
    document, else ``?``, ``?`` and ``none``; the type is upper-cased.
    """
    record = F.col(fields)
    payload = F.coalesce(
        record["json"], F.try_element_at(F.map_values(record), F.lit(1)), F.lit("{}"))
    doc = F.col("_doc")

    def pick(name: str, default: str) -> Column:
        return F.coalesce(record[name], F.try_variant_get(doc, f"$.{name}", "string"), F.lit(default))

    return records.withColumn("_doc", parse_document(payload)).withColumns({
        "payload": payload,
        "type": F.upper(F.coalesce(F.try_variant_get(doc, "$.type", "string"), F.lit("UNKNOWN"))),
        "db": pick("db", "?"),
        "table": pick("table", "?"),
        "txn": pick("txn", "none"),
        "n_rows": F.coalesce(F.size(F.try_variant_get(doc, "$.rows", "array<variant>")), F.lit(0)),
    }).drop("_doc")

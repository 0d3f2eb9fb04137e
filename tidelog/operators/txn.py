"""Transactions: assignment, boundaries, outcomes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import classify_query
from ..schemas import ROW_KINDS
from .order import FILE_NO, Slices, file_no, log_slices, with_carry


def _id(source: Column, how: Column, number: Column, position: Column) -> Column:
    """Deterministic UUID-shaped text, so replays and retries agree."""
    text = F.md5(F.concat_ws("|", source, how, number.cast("string"), position.cast("string")))
    # Dashes are put in one by one, so that the digest is named, and computed, once.
    for at in (9, 14, 19, 24):
        text = F.overlay(text, F.lit("-"), at, 0)
    return text


def signals(ev: DataFrame) -> DataFrame:
    """Add ``_signal``: what each event does to the transaction state."""
    return ev.withColumn("_class", F.when(F.col("kind") == "QUERY", classify_query("query"))).withColumn(
        "_signal",
        F.expr("""CASE WHEN _class = 'BEGIN' THEN 'begin'
                       WHEN kind = 'XID' OR _class IN ('COMMIT', 'ROLLBACK') THEN 'close'
                       WHEN captured THEN 'row'
                       WHEN kind = 'QUERY' THEN 'statement'
                       ELSE 'none' END"""),
    ).drop("_class")


def _states() -> tuple[dict[str, Column], dict[str, Column]]:
    """What is carried along the log: fixed-width states and the latest database."""
    edge = "_signal IN ('begin', 'close')"
    number = FILE_NO.format("log_file")
    return {
        "_open": F.expr("CASE WHEN _signal IN ('begin', 'row') THEN true WHEN _signal = 'close' THEN false END"),
        "_edge_file": F.expr(f"CASE WHEN {edge} THEN {number} END"),
        "_edge_pos": F.expr(f"CASE WHEN {edge} THEN position END"),
        "_edge_begin": F.expr(f"CASE WHEN {edge} THEN _signal = 'begin' END"),
    }, {"_map_db": F.when(F.col("kind").isin(ROW_KINDS), F.col("db"))}


def assign_txn(
    ev: DataFrame,
    source: str | Column = "log",
    slices: Slices | None = None,
    initial: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add ``txn`` (id or null), ``in_txn`` (state before the event) and ``map_db``.

    Needs ``captured`` (see :func:`tidelog.operators.capture.flag_captured`): only
    captured row events open a transaction.  BEGIN always opens a new one; XID,
    COMMIT and ROLLBACK close; a statement outside a transaction gets an id of
    its own and opens nothing; an XID outside a transaction has no id.

    Between two boundaries (BEGIN or a close) there is at most one open
    transaction, so the id is a hash of the boundary that precedes it.  That
    makes the whole state a set of "last value" carries.  ``map_db`` is the
    database of the latest row event, captured or not.
    """
    fixed, text = _states()
    carried = with_carry(signals(ev), slices or log_slices(), last=fixed, text=text, initial=initial)
    return with_ids(carried, F.lit(source) if isinstance(source, str) else source, [c for c in ev.columns if c not in ("in_txn", "txn", "map_db")])


def with_ids(carried: DataFrame, source: Column, keep: list[str]) -> DataFrame:
    """``keep`` with in_txn, txn and map_db, from events with their signals and the states carried to them."""
    keyed = carried.withColumn("in_txn", F.coalesce("_open", F.lit(False))).withColumn(
        "_own",
        F.expr("_signal = 'begin' OR NOT in_txn AND (_signal = 'statement' OR _signal = 'close' AND kind = 'QUERY')"),
    )
    how = F.expr("CASE WHEN _own OR _edge_begin THEN 'at' ELSE 'after' END")
    number = F.when(F.col("_own"), file_no()).otherwise(F.coalesce("_edge_file", F.lit(-1)))
    at = F.expr("CASE WHEN _own THEN position ELSE coalesce(_edge_pos, -1) END")
    has_id = F.expr("_own OR _signal = 'row' OR in_txn AND _signal <> 'none'")
    return keyed.select(
        *keep, "in_txn", F.when(has_id, _id(source, how, number, at)).alias("txn"), F.col("_map_db").alias("map_db"))


def end_state(ev: DataFrame) -> DataFrame:
    """One row: the carried states after the last event of ``ev``, and its extent.

    Passing the states as ``initial`` to :func:`assign_txn` continues the log.
    """
    fixed, text = _states()
    # Text states are grouping keys and files too, so that the log meets a hash aggregate of fixed-width states; few rows are left for the rest.
    at = F.col("position")
    files = signals(ev).groupBy(file_no().alias("file"), *[e.alias(n) for n, e in text.items()]).agg(
        F.min(at).alias("_from"), F.max(at).alias("_at"),
        *[F.max_by(e, F.when(e.isNotNull(), at)).alias(n) for n, e in fixed.items()],
        *[F.max(F.when(e.isNotNull(), at)).alias(f"_at_{n}") for n, e in fixed.items()],
    )

    def place(name: str) -> Column:
        return F.struct("file", F.col(name).alias("pos"))

    found = files.agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), place(f"_at_{n}"))).alias(n) for n in fixed],
        *[F.max_by(n, F.when(F.col(n).isNotNull(), place("_at"))).alias(n) for n in text],
        F.min(place("_from")).alias("_first"), F.max(place("_at")).alias("_last"),
    )
    return found.select(
        *fixed, *text,
        F.col("_first.file").alias("_first_file"), F.col("_first.pos").alias("_first_pos"),
        F.col("_last.file").alias("_last_file"), F.col("_last.pos").alias("_last_pos"),
    )


def commit_events(assigned: DataFrame) -> DataFrame:
    """XID events inside a transaction, with the database they are routed by.

    The database is that of the latest row event; none yet means no event.
    """
    return (
        assigned.where((F.col("kind") == "XID") & F.col("txn").isNotNull())
        .withColumn("db", F.coalesce("map_db", F.lit("")))
    )


def txn_outcome(assigned: DataFrame) -> DataFrame:
    """One row per transaction: outcome, size and extent.

    Sizes are partial aggregates, so a transaction of any length is combined
    before the shuffle.
    """
    # Numbers only, so that the aggregate is a hash aggregate: the outcome as a
    # code, the place as one decimal.
    code = F.expr("""CASE WHEN kind = 'XID' OR _class = 'COMMIT' THEN 1 WHEN _class = 'ROLLBACK' THEN 2 ELSE 0 END""")
    place = file_no().cast("decimal(38,0)") * F.lit(str(2**64)).cast("decimal(20,0)") + F.col("position")
    named = assigned.where("txn is not null").withColumn(
        "_class", F.when(F.col("kind") == "QUERY", classify_query("query")))
    sized = named.groupBy("txn").agg(
        F.max(code).alias("_code"), F.count("*").alias("events"),
        F.min(place.cast("decimal(38,0)")).alias("_first"), F.max(place.cast("decimal(38,0)")).alias("_last"),
    )
    outcomes = F.array(*[F.lit(o) for o in ("OPEN", "COMMITTED", "ROLLED BACK")])

    def parts(name: str) -> list[Column]:
        return [F.expr(f"CAST(_{name} div {2**64}BD AS BIGINT)").alias(f"{name}_file"),
                F.expr(f"CAST(_{name} % {2**64}BD AS BIGINT)").alias(f"{name}_position")]

    return sized.select("txn", outcomes[F.col("_code")].alias("outcome"), "events", *parts("first"), *parts("last"))

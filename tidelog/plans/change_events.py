"""The main plan: raw log to published change events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.envelope import to_envelope
from ..operators.capture import emit_only, prepare_rows, with_primary_key
from ..operators.order import Slices
from ..operators.txn import assign_txn


def published(assigned: DataFrame, rules: DataFrame) -> DataFrame:
    """Published events with their documents, from a prepared log with transactions."""
    return to_envelope(with_primary_key(emit_only(assigned, rules), rules))


def change_events(log: DataFrame, rules: DataFrame, source: str = "log", slices: Slices | None = None) -> DataFrame:
    """Capture, project, assign transactions, filter and wrap."""
    return published(assign_txn(prepare_rows(log, rules), source, slices), rules)

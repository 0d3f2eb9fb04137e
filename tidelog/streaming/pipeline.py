"""Log-to-sinks pipeline with carried transaction state.

Transaction state belongs to a whole source.  Keeping it in a keyed state
operator would send every event of a source to one task.  Instead each
micro-batch runs the batch operator, which is parallel inside a source, and only
the state at the end of the batch (one row) goes on to the next one.  It is
written under the batch id in the shared folder, so a batch that is replayed
after a failure starts from the same state and gives the same ids.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.capture import prepare_rows
from ..operators.order import Slices
from ..operators.position import after
from ..operators.txn import assign_txn, end_state
from ..plans.change_events import published
from ..sinks.publisher import Publisher, missing_publishers, publish, validate
from ..sources.position_index import EARLIEST, LATEST, exists, resolve_start, update_index

STATE_SCHEMA = ("batch BIGINT, _open BOOLEAN, _edge_file BIGINT, _edge_pos BIGINT, _edge_begin BOOLEAN, "
                "_map_db STRING, _last_file BIGINT, _last_pos BIGINT")

# Saved states are reused in turn; a replay never goes back further than one batch.
STATE_SLOTS = 100


class CarriedState:
    """Transaction state at the end of each batch, one small file per batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _slot(self, batch_id: int) -> str:
        return f"{self.folder}/slot-{batch_id % STATE_SLOTS}"

    def load(self, batch_id: int) -> dict[str, object]:
        """State before ``batch_id``; empty before the first batch."""
        if batch_id == 0:
            return {}
        saved = self.spark.read.schema(STATE_SCHEMA).parquet(self._slot(batch_id - 1)).first()
        if saved is None or saved.batch != batch_id - 1:
            raise RuntimeError(f"no transaction state of batch {batch_id - 1} in {self.folder}")
        return {k: v for k, v in saved.asDict().items() if k != "batch" and v is not None}

    def save(self, batch_id: int, state: Mapping[str, object]) -> None:
        row = self.spark.createDataFrame([{**dict.fromkeys(STATE_COLUMNS), **state, "batch": batch_id}], STATE_SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id))


STATE_COLUMNS = [c.split()[0] for c in STATE_SCHEMA.split(", ")]


def pinned_start(spark: SparkSession, checkpoint: str, log: str | None, start: tuple[str, int] | str | None) -> tuple[str, int] | None:
    """The place after which a query reads, resolved when it first starts and then kept with its checkpoint.

    ``latest`` is where the log ended then, by its position index, so a restart loses nothing that came
    since. None and ``earliest`` are the beginning.
    """
    if start is None or start == EARLIEST:
        return None
    saved = f"{checkpoint.rstrip('/')}/start"
    if not exists(spark, saved):
        if start == LATEST and log is None:
            raise ValueError("a start at the current end needs the folder of the log, for its position index")
        mark = resolve_start(update_index(spark, log) if start == LATEST else None, start=start)
        spark.createDataFrame([mark or (None, None)], "log_file STRING, position BIGINT").coalesce(1).write.parquet(saved)
    kept = spark.read.schema("log_file STRING, position BIGINT").parquet(saved).first()
    return (kept.log_file, kept.position) if kept.log_file is not None else None


def _advance(batch: DataFrame, before: Mapping[str, object], batch_id: int) -> dict[str, object]:
    """State after a batch; a batch that starts before the last one ended is an error."""
    found = {k: v for k, v in end_state(batch).first().asDict().items() if v is not None}
    first = (found.pop("_first_file", None), found.pop("_first_pos", None))
    if "_last_file" in before and None not in first and first <= (before["_last_file"], before["_last_pos"]):
        raise RuntimeError(
            f"batch {batch_id} starts at file {first[0]}, position {first[1]}, which is not after file "
            f"{before['_last_file']}, position {before['_last_pos']}: the log arrived out of order")
    return {**before, **found}


def assign_txn_stream(
    log: DataFrame,
    rules: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    source: str = "log",
    slices: Slices | None = None,
    trigger: Mapping[str, object] | None = None,
    start: tuple[str, int] | str | None = None,
    log_path: str | None = None,
) -> StreamingQuery:
    """Run ``handle(assigned_batch, batch_id)`` on each micro-batch of a log stream.

    The log must arrive in order, and a late file is an error, since ids that
    were already handed out would be wrong.  Inside a batch any order is fine.
    ``start`` is a place (file, position) or its two-line text, ``earliest`` or ``latest``; events up to it are
    skipped. It counts when the query first starts; ``latest`` needs ``log_path``, the folder of the log.
    """
    if (mark := pinned_start(log.sparkSession, checkpoint, log_path, start)) is not None:
        log = after(log, mark)
    state = CarriedState(log.sparkSession, f"{checkpoint.rstrip('/')}/txn-state")

    def run(batch: DataFrame, batch_id: int) -> None:
        before = state.load(batch_id)
        # Read three times below: kept trimmed, so that the source is read once.
        ready = prepare_rows(batch, rules).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            after = _advance(ready, before, batch_id)
            handle(assign_txn(ready, source, slices, before), batch_id)
            state.save(batch_id, after)
        finally:
            ready.unpersist()

    return (
        log.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_pipeline(
    log: DataFrame,
    rules: DataFrame,
    routes: DataFrame,
    publishers: Mapping[str, Publisher],
    checkpoint: str,
    source: str = "log",
    slices: Slices | None = None,
    trigger: Mapping[str, object] | None = None,
    deliveries: str | None = None,
    retry_failed: bool = True,
    on_outcomes: Callable[[list], None] | None = None,
    start: tuple[str, int] | str | None = None,
    log_path: str | None = None,
) -> StreamingQuery:
    """Capture, assign transactions, build documents, route and publish.

    The checkpoint moves on only after every publisher has had the batch; sinks
    get the batch id, so a repeated batch can be recognised.  A publisher that
    fails does not hold up the others, but with ``retry_failed`` the query then
    stops and the batch is repeated on restart, so nothing is lost.
    Delivery reports are always stored, one part per batch and publisher, in the
    folder ``deliveries`` or below the checkpoint; a record that failed makes the batch fail.
    An active route without a publisher raises before the first batch. ``start`` and ``log_path``
    are those of :func:`assign_txn_stream`.
    """
    if lost := missing_publishers(routes, publishers):
        raise ValueError(f"no publisher for active routes {', '.join(lost)}")
    reports = deliveries or f"{checkpoint.rstrip('/')}/deliveries"
    for publisher in publishers.values():
        validate(publisher)
        publisher.start()

    def handle(assigned: DataFrame, batch_id: int) -> None:
        outcomes = publish(published(assigned, rules), routes, publishers, reports, batch_id)
        if on_outcomes:
            on_outcomes(outcomes)
        failed = [o for o in outcomes if not o.ok]
        if failed and retry_failed:
            raise RuntimeError(f"batch {batch_id} failed at " + "; ".join(f"{o.publisher}: {o.error}" for o in failed))

    return assign_txn_stream(log, rules, checkpoint, handle, source, slices, trigger, start, log_path)


def drain_and_stop(query: StreamingQuery, publishers: Mapping[str, Publisher] | None = None) -> None:
    """Finish what has arrived, then stop the query and its publishers."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    for publisher in (publishers or {}).values():
        publisher.stop()
        publisher.cleanup()

"""Publisher contract and multi-sink publishing."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from .deliver import python_deliver

REQUIRED = ["name", "init", "publish_batch"]
EVENT = ("txn", "db", "table", "json", "log_file", "position")


class Publisher:
    """A destination.  ``name``, ``init`` and ``publish_batch`` are required.

    ``publish_batch`` receives one DataFrame per batch and writes it with Spark,
    so work stays on the executors; it returns None or a DELIVERIES table.
    """

    name: str = ""
    version: str = "1.0"

    def init(self, options: Mapping[str, str]) -> None:
        """Take the publisher's settings; raise on a bad one."""

    def start(self) -> None:
        """Called once before the first batch."""

    def publish_batch(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        raise NotImplementedError

    def stop(self) -> None:
        """Called once after the last batch."""

    def cleanup(self) -> None:
        """Release what ``init`` took."""

    def health_check(self) -> bool:
        return True


class EventPublisher(Publisher):
    """A destination that takes one event at a time.

    ``publish`` runs inside tasks on a dict of ``txn, db, table, json, log_file,
    position`` and returns 0 for success; the object itself must be picklable.
    """

    def publish(self, event: dict) -> int:
        raise NotImplementedError

    def publish_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return python_deliver(batch, self.publish, self.name, fields=EVENT)


def validate(publisher: object) -> None:
    """Raise unless the required members are there."""
    missing = [m for m in REQUIRED if not getattr(publisher, m, None)]
    if isinstance(publisher, Publisher) and type(publisher).publish_batch is Publisher.publish_batch:
        missing.append("publish_batch")
    if isinstance(publisher, EventPublisher) and type(publisher).publish is EventPublisher.publish:
        missing.append("publish")
    if missing:
        raise TypeError(f"publisher lacks {', '.join(dict.fromkeys(missing))}")


@dataclass(frozen=True)
class Outcome:
    """What publishing one batch to one publisher came to; ``ok`` means that no record failed."""

    publisher: str
    batch_id: int
    ok: bool
    error: str | None = None
    delivered: int | None = None
    failed: int | None = None
    dropped: int | None = None


def missing_publishers(routes: DataFrame, publishers: Mapping[str, Publisher]) -> list[str]:
    """Active routes that no publisher serves: their events would vanish."""
    active = routes.where("active").select("publisher").distinct()
    return sorted(r.publisher for r in active.toLocalIterator() if r.publisher not in publishers)


def _one(batch: DataFrame, routes: DataFrame, name: str, publisher: Publisher, batch_id: int, reports: str) -> Outcome:
    """Publish to one publisher and count its stored report."""
    try:
        listens = routes.where(F.col("active") & (F.col("publisher") == name)).select(
            F.explode(F.when(F.coalesce(F.size("databases"), F.lit(0)) == 0, F.array(F.lit(None).cast("string"))).otherwise(
                F.array_distinct("databases"))).alias("_db")).distinct()
        everything = listens.where("_db is null").limit(1).count() > 0
        mine = batch.where("db is not null")
        mine = mine if everything else mine.join(listens, F.col("db") == F.col("_db"), "left_semi")
        report = publisher.publish_batch(mine, batch_id)
        if report is None:
            return Outcome(name, batch_id, True)
        path = f"{reports.rstrip('/')}/batch={batch_id}/sender={name}"
        report.write.mode("overwrite").parquet(path)
        stored = batch.sparkSession.read.schema(report.schema).parquet(path)
        sums = stored.agg(F.count_if("ok").alias("delivered"), F.count_if("dropped").alias("dropped"),
                          F.count_if(~F.col("ok") & ~F.col("dropped")).alias("failed")).first()
        error = f"{sums.failed} records failed, see {path}" if sums.failed else None
        return Outcome(name, batch_id, not sums.failed, error, sums.delivered, sums.failed, sums.dropped)
    except Exception as error:
        return Outcome(name, batch_id, False, str(error))


def publish(ev: DataFrame, routes: DataFrame, publishers: Mapping[str, Publisher], reports: str, batch_id: int = 0) -> list[Outcome]:
    """Write one batch to every publisher it is routed to.

    The batch is kept once and each publisher reads the events of its databases from
    it; publishers do not depend on each other and run side by side.  A failing
    publisher is recorded and does not hold up the others.  The DELIVERIES a
    publisher returns are stored below the folder ``reports``; records that failed
    make its outcome fail, those it can never take (``dropped``) are counted and stay in the report.  An active route without a publisher raises.
    """
    if lost := missing_publishers(routes, publishers):
        raise ValueError(f"no publisher for active routes {', '.join(lost)}")
    batch = ev.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max(1, min(len(publishers), 8))) as pool:
            jobs = [pool.submit(_one, batch, routes, name, publisher, batch_id, reports) for name, publisher in publishers.items()]
            return [job.result() for job in jobs]
    finally:
        batch.unpersist()


def backlog_healthy(pending: int, batch_size: int) -> bool:
    """Unhealthy once more than ten batches are waiting."""
    return pending <= batch_size * 10


def health(query, publishers: Mapping[str, Publisher] | None = None) -> dict[str, object]:
    """State of a running pipeline: query, rates and each publisher's own check."""
    progress = query.lastProgress or {}
    rate_in = progress.get("inputRowsPerSecond") or 0.0
    rate_out = progress.get("processedRowsPerSecond") or 0.0
    return {
        "active": query.isActive,
        "failed": query.exception() is not None,
        "received": sum(p["numInputRows"] for p in query.recentProgress),
        "input_rate": rate_in,
        "processed_rate": rate_out,
        "keeping_up": rate_out >= rate_in,
        "publishers": {n: bool(p.health_check()) for n, p in (publishers or {}).items()},
    }

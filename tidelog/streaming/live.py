"""Live metrics of running queries: observed with the batch, kept by a listener, asked for health."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.metrics import COUNTERS
from ..sinks.publisher import backlog_healthy

SCHEMA = "query STRING, batch BIGINT, name STRING, metric STRING, value BIGINT"
# Batches of each query that are remembered; older ones only stay in the totals.
KEPT = 1000


def observe_events(ev: DataFrame, name: str = "events") -> DataFrame:
    """``ev`` unchanged; every run of it reports how many events went by, and of which types."""
    kind = F.upper("type")
    return ev.observe(name, F.count(F.lit(1)).alias("received"), *[F.count_if(kind == t).alias(n) for n, t in COUNTERS.items()])


def observe_deliveries(reports: DataFrame, name: str = "deliveries") -> DataFrame:
    """``reports`` (DELIVERIES) unchanged; every run of it reports what was delivered."""
    failed = ~F.col("ok") & ~F.col("dropped")
    return reports.observe(name, F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("published"), F.count_if("dropped").alias("dropped"),
                           F.count_if(failed).alias("errors"), F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("bytes"))


class LiveMetrics(StreamingQueryListener):
    """Observations of all queries of a session, by query and batch. A batch that is run again replaces its own.

    Only numbers come to the driver, a row a batch. Queries are known by the id in their
    checkpoint, so a restarted one goes on.
    """

    def __init__(self) -> None:
        self.lock = threading.Lock()
        self.batches: dict[str, dict[int, dict[str, dict[str, int]]]] = {}
        self.before: dict[str, dict[str, dict[str, int]]] = {}
        self.backlog: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.ended.pop(str(event.id), None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = {name: {k: int(v) for k, v in row.asDict().items() if v is not None} for name, row in progress.observedMetrics.items()}
        with self.lock:
            held = self.batches.setdefault(str(progress.id), {})
            if seen:
                held[progress.batchId] = seen
            waiting = [s.metrics.get("numFilesOutstanding", s.metrics.get("maxOffsetsBehindLatest")) for s in progress.sources if s.metrics]
            self.backlog[str(progress.id)] = sum(int(w) for w in waiting if w is not None)
            while len(held) > KEPT:
                _add(self.before.setdefault(str(progress.id), {}), held.pop(min(held)))

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended[str(event.id)] = event.exception

    def attach(self, spark: SparkSession) -> "LiveMetrics":
        spark.streams.addListener(self)
        return self

    def wait_for_end(self, query_id: str, seconds: float = 30.0) -> None:
        """Events reach a listener a little later than the query's own end."""
        until = time.monotonic() + seconds
        while query_id not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of query {query_id} was reported in {seconds} s")
            time.sleep(0.02)

    def totals(self, query_id: str, name: str) -> dict[str, int]:
        """Sums over all batches of a query."""
        with self.lock:
            out: dict[str, dict[str, int]] = {}
            for seen in [self.before.get(query_id, {}), *self.batches.get(query_id, {}).values()]:
                _add(out, seen)
            return out.get(name, {})

    def table(self, spark: SparkSession) -> DataFrame:
        """The remembered observations as rows (query, batch, name, metric, value)."""
        with self.lock:
            rows = [(query, batch, name, metric, value) for query, held in self.batches.items() for batch, seen in held.items()
                    for name, metrics in seen.items() for metric, value in metrics.items()]
        return spark.createDataFrame(rows, SCHEMA)

    def healthy(self, query_id: str, batch_size: int) -> bool:
        """Running or ended well, and with no more than ten batches waiting."""
        with self.lock:
            return self.ended.get(query_id) is None and backlog_healthy(self.backlog.get(query_id, 0), batch_size)


def _add(sums: dict[str, dict[str, int]], more: dict[str, dict[str, int]]) -> None:
    for name, metrics in more.items():
        into = sums.setdefault(name, {})
        for metric, value in metrics.items():
            into[metric] = into.get(metric, 0) + value

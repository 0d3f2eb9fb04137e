"""A sink that delivers in batches and commits its reports once: a data source writer.

Every task sends its records in batches over a bounded number of calls at a time, keeps what failed in a
queue until its next try is due while others go on, and leaves one file of reports. The files of all
tasks become the reports of a batch id together, by one manifest that is written last: a task that is lost or runs
twice leaves neither a second report nor a gap, and a batch id that is written again replaces its reports.
"""

from __future__ import annotations

import heapq
import importlib
import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..schemas import DELIVERIES
from ..sources.positioned import filesystem
from .deliver import DEFAULT_RETRIES, FIRST_BACKOFF_SECONDS

REPORT = pa.schema([
    ("publisher", pa.string()), ("log_file", pa.string()), ("position", pa.int64()), ("ok", pa.bool_()), ("dropped", pa.bool_()),
    ("attempts", pa.int32()), ("status", pa.int32()), ("bytes", pa.int64()), ("error", pa.string())])
MANIFEST = "committed.json"
# Reports held before they go to the task's file.
FLUSH_ROWS = 10_000

# Takes a list of records, gives a status for each; 2xx is delivered. An exception fails the whole list.
SendBatch = Callable[[list[dict]], list[int]]


@dataclass
class Sending:
    """One group of records on its way."""

    records: list[dict]
    attempt: int


def send_all(records: Iterator[dict], send: SendBatch, size: int, in_flight: int, retries: int, backoff: float,
             clock: Callable[[], float] = time.monotonic) -> Iterator[tuple[dict, bool, int, int | None, str | None]]:
    """(record, ok, attempts, status, error) of every record, in the order they are settled.

    At most ``in_flight`` calls of ``size`` records run at a time, and new records are only taken while
    fewer groups than twice that are under way or waiting for another try, so memory is bounded by
    these numbers. A record that failed waits ``backoff`` seconds, twice as long each time.
    """
    running: dict[Future, Sending] = {}
    waiting: list[tuple[float, int, Sending]] = []
    source, more, number = iter(records), True, 0
    with ThreadPoolExecutor(in_flight) as pool:
        def start(group: Sending) -> None:
            running[pool.submit(send, group.records)] = group

        while more or running or waiting:
            while waiting and len(running) < in_flight and waiting[0][0] <= clock():
                start(heapq.heappop(waiting)[2])
            while more and len(running) < in_flight and len(running) + len(waiting) < 2 * in_flight:
                group = [r for _, r in zip(range(size), source)]
                more = len(group) == size
                if group:
                    start(Sending(group, 1))
            if not running:
                if waiting:
                    time.sleep(max(0.0, waiting[0][0] - clock()))
                continue
            pause = max(0.0, waiting[0][0] - clock()) if waiting and len(running) < in_flight else None
            for done in wait(running, timeout=pause, return_when=FIRST_COMPLETED).done:
                group = running.pop(done)
                error, statuses = None, [None] * len(group.records)
                if (failure := done.exception()) is not None:
                    if not isinstance(failure, Exception):
                        raise failure
                    error = str(failure)
                else:
                    statuses = list(done.result())
                    if len(statuses) != len(group.records):
                        error, statuses = f"{len(statuses)} answers for {len(group.records)} records", [None] * len(group.records)
                again = []
                for record, status in zip(group.records, statuses):
                    ok = status is not None and 200 <= status < 300
                    if ok or group.attempt > retries:
                        yield record, ok, group.attempt, status, error
                    else:
                        again.append(record)
                if again:
                    number += 1
                    heapq.heappush(waiting, (clock() + backoff * 2 ** (group.attempt - 1), number, Sending(again, group.attempt + 1)))


@dataclass
class Reported(WriterCommitMessage):
    path: str | None
    rows: int = 0


def load(name: str) -> Callable[[], SendBatch]:
    """The factory of a transport, ``package.module:function``; it is called once in every task."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class DeliveryWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        self.publisher, self.transport = options["publisher"], options["transport"]
        self.folder = f"{options['reports'].rstrip('/')}/batch={int(options['batchId'])}/sender={self.publisher}"
        self.size, self.in_flight = int(options.get("batchSize", 100)), int(options.get("inFlight", 4))
        self.retries, self.backoff = int(options.get("retries", DEFAULT_RETRIES)), float(options.get("backoff", FIRST_BACKOFF_SECONDS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Reported:
        send = load(self.transport)()
        settled = send_all((r for batch in iterator for r in batch.to_pylist()), send, self.size, self.in_flight, self.retries, self.backoff)
        fs, base = filesystem(self.folder)
        fs.create_dir(base, recursive=True)
        name, rows, total, writer = f"part-{uuid.uuid4().hex}.parquet", [], 0, None
        try:
            for record, ok, attempts, status, error in settled:
                size = len((record.get("json") or "").encode("utf-8", "surrogatepass")) if ok else 0
                rows.append((self.publisher, record.get("log_file"), record.get("position"), ok, False, attempts, status, size, error))
                if len(rows) >= FLUSH_ROWS:
                    writer = writer or pq.ParquetWriter(f"{base}/{name}", REPORT, filesystem=fs)
                    writer.write_table(_table(rows))
                    total, rows = total + len(rows), []
            if rows:
                writer = writer or pq.ParquetWriter(f"{base}/{name}", REPORT, filesystem=fs)
                writer.write_table(_table(rows))
                total += len(rows)
        finally:
            if writer:
                writer.close()
        return Reported(name if writer else None, total)

    def commit(self, messages: list[Reported | None]) -> None:
        """All tasks are done: their files become the reports of the batch, and files of other runs go."""
        fs, base = filesystem(self.folder)
        fs.create_dir(base, recursive=True)
        names = sorted(m.path for m in messages if m is not None and m.path)
        draft = f"{base}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps({"files": names, "rows": sum(m.rows for m in messages if m is not None)}).encode())
        fs.move(draft, f"{base}/{MANIFEST}")
        for info in fs.get_file_info(pafs.FileSelector(base)):
            if info.base_name.startswith("part-") and info.base_name not in names:
                fs.delete_file(info.path)

    def abort(self, messages: list[Reported | None]) -> None:
        """Some task failed for good: what the others reported is dropped, an earlier commit of the batch stays."""
        fs, base = filesystem(self.folder)
        for m in messages:
            if m is not None and m.path and fs.get_file_info(f"{base}/{m.path}").type == pafs.FileType.File:
                fs.delete_file(f"{base}/{m.path}")


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), REPORT)], schema=REPORT)


class DeliverySink(DataSource):
    """``df.write.format("delivery")`` with publisher, transport, reports, batchId, batchSize, inFlight, retries, backoff."""

    @classmethod
    def name(cls) -> str:
        return "delivery"

    def writer(self, schema, overwrite):
        return DeliveryWriter(self.options)


def deliver_batch(records: DataFrame, publisher: str, transport: str, reports: str, batch_id: int = 0, **options: object) -> DataFrame:
    """Send ``records`` and return the committed reports of this batch (DELIVERIES).

    ``records`` has log_file, position and what the transport needs (json counts as its bytes); each record is sent at least once and
    reported exactly once. ``transport`` names a factory that workers can import. Raises if a task
    fails; records that the endpoint refuses to the end are reports with ``ok`` false.
    """
    spark = records.sparkSession
    spark.dataSource.register(DeliverySink)
    writer = records.write.format("delivery").mode("append").option("publisher", publisher).option("transport", transport)
    writer = writer.option("reports", reports).option("batchId", str(batch_id))
    for name, value in options.items():
        writer = writer.option(name, str(value))
    writer.save()
    return read_reports(spark, reports, batch_id, publisher)


def read_reports(spark: SparkSession, reports: str, batch_id: int | None = None, publisher: str | None = None) -> DataFrame:
    """Committed reports of one batch and publisher, or of all: only files that a manifest names."""
    fs, base = filesystem(reports.rstrip("/"))
    prefix = reports.rstrip("/")[:len(reports.rstrip("/")) - len(base)]
    files = []
    for info in fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
        place = info.path[len(base):].strip("/").split("/")
        if info.base_name != MANIFEST or len(place) != 3:
            continue
        if batch_id is not None and place[0] != f"batch={batch_id}" or publisher is not None and place[1] != f"sender={publisher}":
            continue
        folder = info.path.rsplit("/", 1)[0]
        with fs.open_input_stream(info.path) as stream:
            files += [f"{prefix}{folder}/{name}" for name in json.loads(stream.readall())["files"]]
    return spark.read.schema(DELIVERIES).parquet(*files) if files else spark.createDataFrame([], DELIVERIES)

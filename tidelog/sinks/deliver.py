"""Delivery through transports given by the caller (K3-K7 writers, K5, U1).

A transport is a picklable ``send(record: dict) -> int | None`` run inside tasks; it
returns a status code, or None for success without one.  Delivery is
at-least-once: a retried task sends again, and ``(publisher, log_file, position)``
identifies a message for de-duplication.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..schemas import DELIVERIES

# --- Fixed values: retry settings ----------------------------------------------
DEFAULT_RETRIES = 3
FIRST_BACKOFF_SECONDS = 0.1

SIZE = "_payload_bytes"


def is_success(status: int | None) -> bool:
    """2xx, or a transport that reports nothing."""
    return status is None or 200 <= status < 300


def attempt(send: Callable[[dict], int | None], record: dict, retries: int, backoff: float) -> tuple[bool, int, int | None, str | None]:
    """Send once and up to ``retries`` more times, doubling the pause."""
    status = error = None
    for n in range(retries + 1):
        try:
            status, error = send(record), None
            if is_success(status):
                return True, n + 1, status, None
        except Exception as failure:
            status, error = None, f"{type(failure).__name__}: {failure}"
        if n < retries and backoff > 0:
            time.sleep(backoff * 2**n)
    return False, retries + 1, status, error


def deliver(
    records: DataFrame,
    publisher: str,
    open_transport: Callable[[], Callable[[dict], int | None]],
    payload: str = "json",
    retries: int = 0,
    backoff: float = FIRST_BACKOFF_SECONDS,
) -> DataFrame:
    """Send each record and report it; ``open_transport`` runs once per task.

    Sending happens when the result is evaluated: write it to a table once and
    read statistics from there.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = open_transport()
        for batch in batches:
            out = []
            for record in batch.to_dict("records"):
                ok, attempts, status, error = attempt(send, {k: v for k, v in record.items() if k != SIZE}, retries, backoff)
                size = record[SIZE] if ok else 0
                out.append((publisher, record["log_file"], record["position"], ok, False, attempts, status, size, error))
            frame = pd.DataFrame(out, columns=["publisher", "log_file", "position", "ok", "dropped",
                                               "attempts", "status", "bytes", "error"])
            frame["status"] = frame["status"].astype("Int32")
            yield frame

    return records.withColumn(SIZE, F.coalesce(F.octet_length(payload), F.lit(0))).mapInPandas(run, DELIVERIES)


def webhook_headers(token: str | None = None) -> dict[str, str]:
    """Headers of a POST; a token only when there is one."""
    headers = {"Content-Type": "application/json"}
    if token:
        headers["Authorization"] = f"Bearer {token}"
    return headers


def webhook_deliver(ev: DataFrame, open_transport: Callable[[], Callable[[dict], int]], retries: int = DEFAULT_RETRIES,
                    token: str | None = None, backoff: float = FIRST_BACKOFF_SECONDS,
                    publisher: str = "webhook") -> DataFrame:
    """POST each document: 2xx succeeds, anything else is tried again.

    The transport receives ``{"log_file", "position", "json", "headers"}``.
    """
    headers = webhook_headers(token)

    def with_headers():
        send = open_transport()
        return lambda record: send({**record, "headers": headers})

    return deliver(ev.select("log_file", "position", "json"), publisher, with_headers,
                   retries=retries, backoff=backoff)


def callback_status(result: object) -> int:
    """Status of a user callback: 0 is success, any other int failure, non-ints success.

    Booleans are ints here, so returning True reports a failure.
    """
    return 500 if isinstance(result, int) and result != 0 else 200


EVENT_FIELDS = ("txn", "db", "table", "json")


def python_deliver(ev: DataFrame, on_event: Callable[[dict], object], publisher: str = "python",
                   on_start: Callable[[], object] | None = None,
                   fields: tuple[str, ...] = EVENT_FIELDS) -> DataFrame:
    """Batch form of the per-event callback; an exception counts as a failure."""

    def open_transport():
        if on_start:
            on_start()

        def send(record):
            return callback_status(on_event({k: record[k] for k in fields}))

        return send

    return deliver(ev.select("log_file", "position", *EVENT_FIELDS), publisher, open_transport)


class PythonSink:
    """Streaming form of the per-event callback, for ``DataStreamWriter.foreach``.

    Hooks are looked up by name on ``script`` (a module, class or object).
    """

    def __init__(self, script: object, on_event: str = "on_event", on_start: str = "on_start",
                 on_stop: str = "on_stop"):
        self.script = script
        self.names = {"event": on_event, "start": on_start, "stop": on_stop}
        if not callable(getattr(script, on_event, None)):
            raise ValueError(f"no callable {on_event}")

    def _hook(self, which: str):
        return getattr(self.script, self.names[which], None)

    def open(self, partition_id: int, epoch_id: int) -> bool:
        hook = self._hook("start")
        return hook is None or callback_status(hook()) == 200

    def process(self, row) -> None:
        event = {k: row[k] for k in EVENT_FIELDS}
        if callback_status(self._hook("event")(event)) != 200:
            raise RuntimeError(f"callback failed at {row['log_file']}:{row['position']}")

    def close(self, error) -> None:
        hook = self._hook("stop")
        if hook is not None:
            hook()

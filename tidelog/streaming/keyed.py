"""Keyed state on streams: transactions of many sources, event-time windows with late rows apart, live lag.

Each is one stateful operator of a single query, so the state store, the watermark and the checkpoint are Spark's.
Python sees the few narrow columns that move the state, in batches; documents and ids are expressions before
and after it.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from ..operators.metrics import COUNTERS
from ..operators.order import file_no
from ..operators.txn import signals, with_ids
from ..schemas import ROW_KINDS

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROW_IMAGES = "ARRAY<MAP<STRING,VARIANT>>"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the store that keeps more than memory holds."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _frame(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True)


# Signals as numbers; others are 0. Those above ROW are the boundaries.
ROW, BEGIN, CLOSE = 1, 2, 3
SIGNALS = {"row": ROW, "begin": BEGIN, "close": CLOSE}


class SourceTransactions(StatefulProcessor):
    """Carries of one source: what the transaction state was before each of its events."""

    CARRIED = ("open", "edge_file", "edge_pos", "edge_begin", "map_db")

    def init(self, handle) -> None:
        self.state = handle.getValueState(
            "txn", "open BOOLEAN, edge_file BIGINT, edge_pos BIGINT, edge_begin BOOLEAN, map_db STRING, last_file BIGINT, last_pos BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Only numbers of the events are held; the events themselves wait in a local file and go on as they came.
        with tempfile.TemporaryFile() as waiting:
            dbs, held, parts = {}, [], 0
            for part in rows:
                pickle.dump(part, waiting, pickle.HIGHEST_PROTOCOL)
                parts += 1
                held.append((part["number"].to_numpy(np.int64), part["place"].to_numpy(np.int64),
                             np.array([SIGNALS.get(s, 0) for s in part["signal"]], np.int8),
                             np.array([dbs.setdefault(d, len(dbs)) if isinstance(d, str) else -1 for d in part["row_db"]], np.int32)))
            file, place, signal, db = (np.concatenate(c) for c in zip(*held))
            del held
            order = np.lexsort((place, file))
            file, place, signal, db = file[order], place[order], signal[order], db[order]
            before = list(self.state.get()) if self.state.exists() else [None] * 7
            if before[5] is not None and (file[0], place[0]) <= (before[5], before[6]):
                raise RuntimeError(f"source {key[0]} goes back to file {file[0]}, position {place[0]}, "
                                   f"behind file {before[5]}, position {before[6]}: the log arrived out of order")

            def latest(marked: np.ndarray) -> np.ndarray:
                """By event, the last marked one up to it; -1 before the first."""
                return np.maximum.accumulate(np.where(marked, np.arange(len(marked), dtype=np.int32), np.int32(-1)))

            names = [*dbs]
            states = latest(signal > 0), latest(signal > ROW), latest(db >= 0)

            def carried(at: np.ndarray) -> list[list]:
                """The carried values after the events ``at``, in log order; -1 is before the first."""
                opened, edge, row = (np.where(at >= 0, s[at], -1).tolist() for s in states)
                return [[before[0] if i < 0 else bool(signal[i] != CLOSE) for i in opened],
                        [before[1] if i < 0 else int(file[i]) for i in edge], [before[2] if i < 0 else int(place[i]) for i in edge],
                        [before[3] if i < 0 else bool(signal[i] == BEGIN) for i in edge], [before[4] if i < 0 else names[db[i]] for i in row]]

            self.state.update((*(v[0] for v in carried(np.array([len(order) - 1]))), int(file[-1]), int(place[-1])))
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            waiting.seek(0)
            start = 0
            for _ in range(parts):
                part = pickle.load(waiting)
                values = carried(rank[start:start + len(part)] - 1)
                start += len(part)
                for name, column in zip(self.CARRIED, values):
                    part[name] = pd.Series(column, index=part.index, dtype="Int64" if name in ("edge_file", "edge_pos") else object)
                yield part


def assign_txn_sources(log: DataFrame, source: str = "source") -> DataFrame:
    """The stream ``log`` with txn, in_txn and map_db, each value of column ``source`` being a log of its own.

    Needs ``captured``. Ids equal those of the batch operator with the same sources. Events of a source
    must arrive in the order of its log, in any mixture with others; inside a batch any order is fine. One
    source is one task at a time: for a single huge source use :func:`assign_txn_stream`, whose
    batches are parallel inside.
    """
    use_state_store(log.sparkSession)
    marked = signals(log)
    if "rows" in log.columns:  # Python reads no variants
        marked = marked.withColumn("rows", F.to_json("rows"))
    # Own names for what goes through: a table's may not be fit for Python.
    given = marked.columns
    row_db = F.when(F.col("kind").isin(ROW_KINDS), F.col("db"))
    narrow = marked.select(F.col(source).alias("key"), file_no().alias("number"), F.col("position").alias("place"), F.col("_signal").alias("signal"),
                           row_db.alias("row_db"), *[F.col(c).alias(f"given{i}") for i, c in enumerate(given)])
    out = StructType([*narrow.schema.fields, StructField("open", BooleanType()), StructField("edge_file", LongType()), StructField("edge_pos", LongType()),
                      StructField("edge_begin", BooleanType()), StructField("map_db", StringType())])
    found = narrow.groupBy("key").transformWithStateInPandas(SourceTransactions(), out, "append", "None")
    carried = found.select(*[F.col(f"given{i}").alias(c) for i, c in enumerate(given)], *[F.col(c).alias(f"_{c}") for c in SourceTransactions.CARRIED])
    if "rows" in log.columns:
        carried = carried.withColumn("rows", F.from_json("rows", ROW_IMAGES))
    return with_ids(carried, F.col(source), [c for c in log.columns if c not in ("in_txn", "txn", "map_db")])


class WindowCounters(StatefulProcessor):
    """Counters of one window: closed by the watermark, rows after that are counted as late."""

    NAMES = ("total", *COUNTERS)

    def __init__(self, keys: int):
        self.keys = keys

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("counts", ", ".join(f"{n} BIGINT" for n in self.NAMES))

    def _row(self, key, counts, late: bool) -> pd.DataFrame:
        values = dict(zip((f"k{i}" for i in range(self.keys)), key))
        values |= {"end": key[self.keys], "salt": key[self.keys + 1], "late": late} | dict(zip(self.NAMES, counts))
        return pd.DataFrame([values])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kinds = _frame(rows)["kind"]
        counts = [len(kinds), *(int((kinds == t).sum()) for t in COUNTERS.values())]
        end = key[self.keys] // 1000
        if end <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, counts, True)
            return
        if self.state.exists():
            counts = [a + b for a, b in zip(self.state.get(), counts)]
        else:
            self.handle.registerTimer(end)
        self.state.update(tuple(counts))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._row(key, self.state.get(), False)
            self.state.clear()


def windowed_counters_stream(ev: DataFrame, size_seconds: int, delay: str, by: list[str] | None = None, ts: str = "ts", salts: int = 16) -> DataFrame:
    """(by…, window_start, window_end, part, late, total, inserts, updates, deletes, commits), appended as windows close.

    The watermark is the latest time of all earlier batches less ``delay``. A window is closed, and its
    counters come out, when the watermark reaches its end. A row whose window was closed before its batch is late: it is
    counted too, in a row of its own marked ``late``, and changes no window. A window's rows are dealt
    over ``salts`` parts, so that one busy window is not one task; add the parts up.
    """
    use_state_store(ev.sparkSession)
    by = by or []
    keys = [f"k{i}" for i in range(len(by))]
    marked = ev.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    micros = F.unix_micros("_ts")
    end = micros - F.pmod(micros, F.lit(size_seconds * 1_000_000)) + size_seconds * 1_000_000
    # The time column itself would make the engine drop late rows unseen.
    narrow = marked.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], end.alias("end"), F.pmod(F.xxhash64("_ts", "type"), F.lit(salts)).cast("int").alias("salt"),
                           F.upper("type").alias("kind"))
    fields = [narrow.schema[c] for c in [*keys, "end", "salt"]]
    out = StructType([*fields, StructField("late", BooleanType()), *[StructField(n, LongType()) for n in WindowCounters.NAMES]])
    found = narrow.groupBy(*keys, "end", "salt").transformWithStateInPandas(WindowCounters(len(by)), out, "append", "EventTime")

    def moment(c: Column) -> Column:
        return F.timestamp_micros(c)

    return found.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], moment(F.col("end") - size_seconds * 1_000_000).alias("window_start"),
                        moment(F.col("end")).alias("window_end"), F.col("salt").alias("part"), "late", *WindowCounters.NAMES)


class PartitionLag(StatefulProcessor):
    """The previous sample of one topic partition."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("previous", "end_offset BIGINT, us BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        samples = _frame(rows).sort_values(["us", "end_offset"], kind="stable", ignore_index=True)
        before = self.state.get() if self.state.exists() else (None, None)
        samples["prev_end"] = pd.Series([before[0], *samples["end_offset"].iloc[:-1]], dtype="Int64")
        samples["prev_us"] = pd.Series([before[1], *samples["us"].iloc[:-1]], dtype="Int64")
        last = (int(samples["end_offset"].iat[-1]), int(samples["us"].iat[-1]))
        if before[1] is None or last[1] >= before[1]:
            self.state.update(last)
        yield samples


def partition_lag_stream(offsets: DataFrame) -> DataFrame:
    """Lag and rate of every sample of a stream of offset samples (topic, partition, end_offset, committed, sampled_at).

    The same as :func:`tidelog.operators.metrics.partition_lag`, however the samples are cut into batches, as
    long as those of a partition arrive in time order. A sample that comes after a later one has rate 0.
    """
    use_state_store(offsets.sparkSession)
    narrow = offsets.select("topic", "partition", "end_offset", "committed", "sampled_at", F.unix_micros(F.col("sampled_at").cast("timestamp")).alias("us"))
    out = StructType([*(f if f.name != "sampled_at" else StructField(f.name, TimestampType()) for f in narrow.withColumn(
        "sampled_at", F.col("sampled_at").cast("timestamp")).schema.fields), StructField("prev_end", LongType()), StructField("prev_us", LongType())])
    narrow = narrow.withColumn("sampled_at", F.col("sampled_at").cast("timestamp"))
    found = narrow.groupBy("topic", "partition").transformWithStateInPandas(PartitionLag(), out, "append", "None")
    dt = (F.col("us") - F.col("prev_us")) / F.lit(1000000.0)
    return found.select(
        "topic", "partition", "end_offset", "committed", "sampled_at",
        F.when(F.col("committed").isNotNull(), F.greatest(F.lit(0).cast("bigint"), F.col("end_offset") - F.col("committed"))).alias("lag"),
        F.when(dt > 0, (F.col("end_offset") - F.col("prev_end")) / dt).otherwise(F.lit(0.0)).alias("rate"))


# Rows that one state key of OpenChunks holds: statements that begin in one span of log, and of a long one a block of its chunks.
SPAN_BYTES = 1 << 13
BLOCK_ROWS = 1 << 12


class OpenChunks(StatefulProcessor):
    """Rows of the incomplete chunks of neighbouring statements."""

    def __init__(self, max_rows: int, names: list[str], held: str):
        self.max_rows, self.names, self.held = max_rows, names, held

    def init(self, handle) -> None:
        self.state = handle.getListState("rows", self.held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = [*self.names, "number", "image", "last"]
        new = _frame(rows)[columns]
        before = pd.DataFrame(list(self.state.get()) if self.state.exists() else [], columns=columns)
        # A row that comes again replaces the one that is held.
        found = (pd.concat([before, new], ignore_index=True) if len(before) else new).drop_duplicates([*self.names, "number"], keep="last")
        found = found.assign(group=found.groupby(self.names, sort=False, dropna=False).ngroup()).sort_values(["group", "number"], ignore_index=True)
        count = found.groupby("group").size()
        ends = found.loc[found["last"].astype(bool)].groupby("group")["number"].min().reindex(count.index)
        whole = count >= (ends % self.max_rows + 1).fillna(self.max_rows)
        open_rows = found.loc[~found["group"].map(whole)]
        if len(open_rows):
            self.state.put([tuple(None if pd.isna(v) else v for v in r) for r in zip(*(open_rows[c].tolist() for c in columns))])
        elif len(before):
            self.state.clear()
        if whole.any():
            stop = count.cumsum()
            first = stop - count
            images = found["image"].tolist()
            packed = found.loc[first[whole], self.names].reset_index(drop=True)
            packed["rows"] = ["[" + ",".join(images[a:b]) + "]" for a, b in zip(first[whole].tolist(), stop[whole].tolist())]
            packed["last_chunk"] = ends[whole].notna().tolist()
            yield packed


def pack_rows_stream(changes: DataFrame, max_rows: int) -> DataFrame:
    """:func:`tidelog.operators.rows.pack_rows` for a stream whose statements may be cut by batch borders.

    ``changes`` has log_file, position, kind, db, table, row_no, row, and ``last_row``, true for a statement's
    last row. An event comes out in the batch in which its chunk is complete: with ``max_rows`` rows, or with all rows up
    to the last one of the statement. Rows may come in any order; one that comes again replaces itself while its chunk is
    open. A state key is a span of SPAN_BYTES of log, as a call to Python and its state costs far more than the few rows of a
    chunk; a long statement is spread over keys of about BLOCK_ROWS rows each. State is the rows of open chunks only.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    use_state_store(changes.sparkSession)
    names = ["log_file", "position", "kind", "db", "table", "chunk"]
    keys = [f"k{i}" for i in range(len(names))]
    keyed = changes.withColumn("chunk", F.floor(F.col("row_no") / max_rows))
    narrow = keyed.select(F.col("log_file").alias("file"), F.expr(f"position div {SPAN_BYTES}").alias("span"),
                          F.expr(f"chunk div {max(1, BLOCK_ROWS // max_rows)}").alias("block"), *[F.col(c).alias(k) for k, c in zip(keys, names)],
                          F.col("row_no").cast("long").alias("number"), F.to_json("row").alias("image"), F.coalesce("last_row", F.lit(False)).alias("last"))
    held = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[3:])
    out = StructType([*[StructField(k, narrow.schema[k].dataType) for k in keys], StructField("rows", StringType()), StructField("last_chunk", BooleanType())])
    found = narrow.groupBy("file", "span", "block").transformWithStateInPandas(OpenChunks(max_rows, keys, held), out, "append", "None")
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, names)], F.from_json("rows", ROW_IMAGES).alias("rows"), "last_chunk")

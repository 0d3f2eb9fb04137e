"""Keyed state on streams against the batch operators, and starts by the position index."""

import datetime
import tracemalloc

import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_order_and_txn import frame, random_log
from tidelog.operators import metrics
from tidelog.operators.order import source_slices
from tidelog.operators.txn import assign_txn
from tidelog.sources.position_index import end_mark, needed_files, position_index, read_from, resolve_start, update_index
from tidelog.operators.rows import pack_rows
from tidelog.streaming import keyed
from tidelog.streaming.keyed import assign_txn_sources, pack_rows_stream, partition_lag_stream, windowed_counters_stream
from tidelog.streaming.pipeline import assign_txn_stream


def feed(spark, folder, parts, transform):
    """Each part arrives alone, and the query restarts for it."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        found = transform(spark.readStream.schema(part.schema).parquet(f"{folder}/in"))
        writer = found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def sources_log(spark):
    logs = [frame(spark, random_log(seed, n=60)).withColumn("source", F.lit(name)) for seed, name in ((1, "a"), (2, "b"), (3, None))]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


def test_sources_equal_the_batch(spark, tmp_path):
    log = sources_log(spark)
    columns = ["source", "seq", "txn", "in_txn", "map_db"]
    want = assign_txn(log, F.col("source"), source_slices("source")).select(columns)
    got = feed(spark, str(tmp_path), [log.where("seq < 20"), log.where("seq >= 20 AND seq < 45"), log.where("seq >= 45")], assign_txn_sources).select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("txn IS NOT NULL").count() > 20


def test_a_source_that_goes_back_is_an_error(spark, tmp_path):
    log = sources_log(spark)
    with pytest.raises(Exception, match="out of order"):
        feed(spark, str(tmp_path), [log.where("seq >= 30"), log.where("seq < 30 AND source = 'b'")], assign_txn_sources)


def at(*seconds):
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    return [(start + datetime.timedelta(seconds=s), k, d) for s, k, d in seconds]


def test_windows_close_by_the_watermark_and_late_rows_are_counted(spark, tmp_path):
    schema = "ts TIMESTAMP, type STRING, db STRING"
    parts = [spark.createDataFrame(at(*rows), schema) for rows in (
        [(1, "INSERT", "x"), (5, "update", "x"), (12, "DELETE", None), (40, "COMMIT", "x")],  # watermark 30 afterwards
        [(3, "INSERT", "x"), (25, "INSERT", "x"), (31, "INSERT", "x"), (33, "ALTER", "x")],
        [(90, "INSERT", "y"), (38, "INSERT", "x")])]
    out = feed(spark, str(tmp_path), parts, lambda s: windowed_counters_stream(s, 10, "10 seconds", by=["db"], salts=3))
    whole = out.groupBy("db", F.unix_timestamp("window_end") % 86400, "late").agg(
        *[F.sum(c) for c in ("total", "inserts", "updates", "deletes", "commits")])
    assert sorted(map(tuple, whole.collect()), key=str) == sorted([
        ("x", 10, False, 2, 1, 1, 0, 0), (None, 20, False, 1, 0, 0, 1, 0), ("x", 10, True, 1, 1, 0, 0, 0), ("x", 30, True, 1, 1, 0, 0, 0),
        ("x", 40, False, 3, 2, 0, 0, 0), ("x", 50, False, 1, 0, 0, 0, 1)], key=str)


def test_lag_over_any_cut(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [("t", k % 2, 10 * k + k % 3, None if k % 5 == 0 else 10 * k - 4, start + datetime.timedelta(seconds=k // 2 * 7)) for k in range(24)]
    samples = spark.createDataFrame(rows, "topic STRING, partition INT, end_offset BIGINT, committed BIGINT, sampled_at TIMESTAMP")
    columns = ["topic", "partition", "end_offset", "lag", "rate"]
    got = feed(spark, str(tmp_path), [samples.where("end_offset < 60"), samples.where("end_offset >= 60 AND end_offset < 75"), samples.where("end_offset >= 75")],
               partition_lag_stream).select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, metrics.partition_lag(samples).select(columns).collect()))


@pytest.fixture
def stored(spark, tmp_path):
    folder = str(tmp_path / "log")
    log = spark.range(400).selectExpr("concat('bin.', lpad(cast(id div 100 + 1 as string), 6, '0')) as log_file", "4 + id % 100 * 10 as position", "id as seq")
    for k in range(4):
        log.where(f"seq div 100 = {k}").repartitionByRange(2, "position").write.mode("append").parquet(folder)
    return folder


def test_index_prunes_files_and_grows(spark, stored):
    index = update_index(spark, stored)
    assert index.count() == 8 and update_index(spark, stored).count() == 8
    assert index.agg(F.sum("events")).first()[0] == 400 and end_mark(index) == ("bin.000004", 994)
    assert len(needed_files(index, None)) == 8 and len(needed_files(index, ("bin.000003", 700))) == 3 and needed_files(index, ("bin.000004", 994)) == []
    rest = read_from(spark, stored, checkpoint="bin.000003\n700\n", start=("bin.000001", 4))
    assert rest.count() == 30 + 100 and len(rest.inputFiles()) == 3
    spark.createDataFrame([("bin.000005", 4, 400)], "log_file STRING, position BIGINT, seq BIGINT").write.mode("append").parquet(stored)
    assert read_from(spark, stored, start=("bin.000004", 994)).count() == 1
    assert position_index(spark, stored).count() == 9 and spark.read.parquet(stored).count() == 401
    assert read_from(spark, stored).count() == 0 and read_from(spark, stored, start="earliest").count() == 401


def test_resolving_a_start(spark, stored):
    index = update_index(spark, stored)
    assert resolve_start(index, "f.000001\n7", "latest") == ("f.000001", 7)
    assert resolve_start(index, None, "earliest") is None and resolve_start(index, None, ("bin.000002", 5)) == ("bin.000002", 5)
    assert resolve_start(index) == resolve_start(index, start="latest") == ("bin.000004", 994)


RULES = ("db STRING, capture_dml BOOLEAN, capture_ddl BOOLEAN, `table` STRING, primary_key ARRAY<STRING>, all_columns BOOLEAN, columns ARRAY<STRING>")


@pytest.mark.parametrize("start, n", [(None, 90), ("earliest", 90), ("latest", 30), ("mark", 49)])
def test_stream_starts(spark, tmp_path, start, n):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    entries = frame(spark, random_log(5, n=90)).drop("captured")
    rules = spark.createDataFrame([("a", True, True, "t", [], True, [])], RULES)
    if start == "mark":
        start = tuple(entries.where("seq = 40").select("log_file", "position").first())

    def handle(assigned, batch_id):
        assigned.select("seq").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for part in ("seq < 60", "seq >= 60"):
        entries.where(part).coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(entries.schema).parquet(log)
        assign_txn_stream(stream, rules, str(tmp_path / "check"), handle, start=start, log_path=log).awaitTermination()
    assert spark.read.schema("seq BIGINT").parquet(out).count() == n


def test_statements_across_batches_pack_as_in_one(spark, tmp_path):
    log = spark.range(50).selectExpr(
        "'bin.000001' as log_file", "id div 11 as position", "'INSERT' as kind", "'d' as db", "if(id div 11 = 2, null, 't') as `table`", "id % 11 as row_no",
        "map('n', cast(id as variant), 'none', cast(null as variant)) as row", "id % 11 = 10 or id = 49 as last_row")
    parts = [log.where((F.col("row_no") * 7 + F.col("position")) % 3 == k) for k in range(3)]
    stored = feed(spark, str(tmp_path), [p.withColumn("row", F.to_json("row")) for p in parts],
                  lambda s: pack_rows_stream(s.withColumn("row", F.from_json("row", "MAP<STRING,VARIANT>")), 4))
    columns = ["log_file", "position", "kind", "db", "table", "chunk", "last_chunk"]
    got = stored.select(*columns, F.to_json("rows").alias("rows"))
    want = pack_rows(log.drop("last_row"), 4).select(*columns, F.to_json("rows").alias("rows"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 14
    assert spark.read.parquet(f"{tmp_path}/out").count() == 14


def test_chunks_of_a_span_share_a_state_key(spark, tmp_path, monkeypatch):
    log = spark.range(6000).selectExpr(
        "'bin.000001' as log_file", "id div 3 as position", "'INSERT' as kind", "'d' as db", "'t' as `table`", "id % 3 as row_no",
        "map('n', cast(id as variant)) as row", "id % 3 = 2 as last_row")
    out = {}
    for bytes_of in (keyed.SPAN_BYTES, 100):
        monkeypatch.setattr(keyed, "SPAN_BYTES", bytes_of)
        folder = str(tmp_path / str(bytes_of))
        parts = [log.where(p).withColumn("row", F.to_json("row")) for p in ("position % 50 < 49 or row_no = 1", "position % 50 = 49 and row_no <> 1")]
        stored = feed(spark, folder, parts, lambda s: pack_rows_stream(s.withColumn("row", F.from_json("row", "MAP<STRING,VARIANT>")), 2))
        out[bytes_of] = sorted(map(str, stored.select("position", "chunk", "last_chunk", F.to_json("rows").alias("rows")).collect()))
        keys = spark.read.format("statestore").option("batchId", "0").option("stateVarName", "rows").option("flattenCollectionTypes", "true").load(f"{folder}/check")
        # The second row of every 50th statement is held, one chunk has come whole.
        assert keys.count() == 40 and keys.select("key").distinct().count() == -(-2000 // bytes_of)
    assert len(set(map(str, out.values()))) == 1 and len(out[100]) == 4000


def test_a_source_keeps_numbers_of_a_batch_not_its_events():
    class Handle:
        def getValueState(self, name, schema):
            return self

        def exists(self):
            return False

        def update(self, value):
            self.value = value

    def parts():
        for k in reversed(range(50)):
            at = range(k * 1000, k * 1000 + 1000)
            yield pd.DataFrame({"number": 1, "place": at, "signal": "row", "row_db": "d", "given0": [f"{i}" * 400 for i in at]})

    handle, processor, n = Handle(), keyed.SourceTransactions(), 0
    processor.init(handle)
    tracemalloc.start()
    for part in processor.handleInputRows(("s",), parts(), None):
        n += len(part)
        assert part["open"].iloc[1:].eq(True).all() and part["given0"].iat[0] == str(part["place"].iat[0]) * 400
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 50_000 and handle.value == (True, None, None, None, "d", 1, 49_999) and peak < 30 << 20

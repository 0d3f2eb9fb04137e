"""Observations kept by the listener against counts over the same rows."""

from tidelog.streaming.live import LiveMetrics, observe_deliveries, observe_events


def run(spark, folder, stream):
    live = LiveMetrics().attach(spark)
    try:
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check").trigger(
            availableNow=True).start()
        query.awaitTermination()
        live.wait_for_end(str(query.id))
    finally:
        spark.streams.removeListener(live)
    return live, str(query.id)


def test_events_of_all_batches(spark, tmp_path):
    rows = [(k, ["INSERT", "update", "DELETE", None][k % 4]) for k in range(40)]
    spark.createDataFrame(rows, "n INT, type STRING").repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("n INT, type STRING").option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
    live, query = run(spark, str(tmp_path), observe_events(stream))
    assert live.totals(query, "events") == {"received": 40, "inserts": 10, "updates": 10, "deletes": 10, "commits": 0}
    assert live.table(spark).where("metric = 'received'").count() == 4 and live.healthy(query, 1)
    assert live.totals("unknown", "events") == {}


def test_deliveries(spark, tmp_path):
    rows = [("p", "f.1", k, k % 3 > 0, k % 9 == 0, 1, 200, 10, None) for k in range(27)]
    schema = "publisher STRING, log_file STRING, position BIGINT, ok BOOLEAN, dropped BOOLEAN, attempts INT, status INT, bytes BIGINT, error STRING"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    live, query = run(spark, str(tmp_path), observe_deliveries(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")))
    assert live.totals(query, "deliveries") == {"total": 27, "published": 18, "dropped": 3, "errors": 6, "bytes": 270}


def test_failed_query_is_unhealthy_and_old_batches_stay_in_totals(monkeypatch):
    from tidelog.streaming import live as module

    class Event:
        def __init__(self, **values):
            self.__dict__.update(values)

    class Row:
        def __init__(self, n):
            self.n = n

        def asDict(self):
            return {"received": self.n, "nothing": None}

    monkeypatch.setattr(module, "KEPT", 3)
    live = LiveMetrics()
    for batch in [*range(10), 9]:
        source = Event(metrics={"numFilesOutstanding": "25"})
        live.onQueryProgress(Event(progress=Event(id="q", batchId=batch, observedMetrics={"events": Row(batch)}, sources=[source])))
    assert live.totals("q", "events") == {"received": 45} and len(live.batches["q"]) == 3
    assert not live.healthy("q", 2) and live.healthy("q", 3)
    live.onQueryTerminated(Event(id="q", exception="broken"))
    assert not live.healthy("q", 3)
    live.onQueryStarted(Event(id="q"))
    assert live.healthy("q", 3)

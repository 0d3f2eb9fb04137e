"""Batch delivery: bounded calls, retries that do not block, reports that commit once."""

import os
import threading
import time

import pytest

import stand_in_transports as ends
from tidelog.sinks.delivery_sink import MANIFEST, deliver_batch, read_reports, send_all

HERE = os.path.dirname(os.path.abspath(__file__))


@pytest.fixture(scope="module")
def importable(spark):
    spark.sparkContext.addPyFile(f"{HERE}/stand_in_transports.py")
    return spark


def records(n):
    return [{"log_file": "f.1", "position": k, "json": "x" * k} for k in range(n)]


def test_calls_are_bounded_and_every_record_settles_once():
    taken, settled = [0], []

    def source():
        for r in records(500):
            taken[0] += 1
            yield r

    for record, ok, attempts, status, error in send_all(source(), ends.counting, 10, 3, 3, 0.0):
        settled.append(record["position"])
        # At most twice the calls in flight are taken ahead of what has been settled.
        assert taken[0] - len(settled) <= 10 * 2 * 3
    assert sorted(settled) == list(range(500)) and ends.MOST[0] <= 3


def test_failures_wait_without_holding_up_others():
    order, lock = [], threading.Lock()

    def send(group):
        with lock:
            order.append([r["position"] for r in group])
        return [500 if r["position"] == 0 and sum(0 in g for g in order) < 3 else 200 for r in group]

    begin = time.monotonic()
    got = {r["position"]: (ok, n, s) for r, ok, n, s, _ in send_all(iter(records(40)), send, 4, 2, 3, 0.05)}
    assert got[0] == (True, 3, 200) and all(got[k] == (True, 1, 200) for k in range(1, 40))
    assert order.index([0, 1, 2, 3]) == 0 or [0, 1, 2, 3] in order[:2]
    assert [0] not in order[:8] and time.monotonic() - begin >= 0.15


def test_refused_raised_and_wrong_answers():
    def send(group):
        if group[0]["position"] == 2:
            raise ValueError("no route")
        return [200] if group[0]["position"] == 4 else [404] * len(group)

    got = {r["position"]: (ok, n, s, e) for r, ok, n, s, e in send_all(iter(records(6)), send, 2, 2, 1, 0.0)}
    assert got[0] == got[1] == (False, 2, 404, None)
    assert got[2] == got[3] == (False, 2, None, "no route") and got[4] == got[5] == (False, 2, None, "1 answers for 2 records")
    assert list(send_all(iter([]), send, 2, 2, 1, 0.0)) == []


def frame(spark, n):
    return spark.range(n).selectExpr("'f.000001' as log_file", "id as position", "repeat('é', cast(id as int)) as json").repartition(4)


def test_reports_are_committed_with_the_batch(importable, tmp_path):
    reports = str(tmp_path / "reports")
    got = deliver_batch(frame(importable, 60), "hook", "stand_in_transports:flaky", reports, 7, batchSize=5, backoff=0.001)
    rows = {r.position: (r.ok, r.attempts, r.status, r.bytes) for r in got.collect()}
    assert rows == {k: (k % 6 <= 3, min(k % 6, 3) + 1, 204 if k % 6 <= 3 else 503, 2 * k if k % 6 <= 3 else 0) for k in range(60)}
    deliver_batch(frame(importable, 10), "hook", "stand_in_transports:good", reports, 8)
    deliver_batch(frame(importable, 10), "other", "stand_in_transports:good", reports, 8)
    assert read_reports(importable, reports).count() == 80 and read_reports(importable, reports, 8, "hook").count() == 10
    # The batch again: its reports are replaced, not added.
    assert deliver_batch(frame(importable, 60), "hook", "stand_in_transports:good", reports, 7).where("ok").count() == 60
    assert read_reports(importable, reports, 7).count() == 60
    assert read_reports(importable, str(tmp_path / "none")).count() == 0


def test_a_lost_task_leaves_no_reports(importable, tmp_path):
    reports = str(tmp_path / "reports")
    with pytest.raises(Exception):
        deliver_batch(frame(importable, 100), "hook", "stand_in_transports:breaking", reports, 1, batchSize=1)
    assert read_reports(importable, reports).count() == 0
    assert not any(MANIFEST in files for _, _, files in os.walk(reports))
    got = deliver_batch(frame(importable, 100), "hook", "stand_in_transports:good", reports, 1)
    assert got.count() == 100 and got.select("position").distinct().count() == 100
    # Whatever the lost run left behind is gone with the commit.
    assert sum(f.startswith("part-") for _, _, files in os.walk(reports) for f in files) <= 4


def test_empty_batch(importable, tmp_path):
    assert deliver_batch(frame(importable, 0), "hook", "stand_in_transports:good", str(tmp_path / "r")).count() == 0

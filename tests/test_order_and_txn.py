"""Ordered operators against a plain replay, with slices small enough to cross often."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from replay import replay
from tidelog.operators.order import (
    Slices, event_sequence, file_slices, in_log_order, log_slices, sequence_slices, with_carry,
)
from tidelog.operators.position import after, checkpoint_trail, high_water_mark, parse_mark, resume_from, track_position
from tidelog.operators.txn import assign_txn, commit_events, end_state, txn_outcome

SCHEMA = ("seq INT, log_file STRING, position BIGINT, kind STRING, query STRING, db STRING, "
          "`table` STRING, captured BOOLEAN, xid BIGINT")
STATEMENTS = ["BEGIN", "begin work", "COMMIT", "rollback", "CREATE TABLE t", "alter x", "SET a = 1", " BEGIN", "DROPX"]
TINY = log_slices(slice_bytes=100, files=2)


def random_log(seed, n=400, files=7):
    rng = random.Random(seed)
    entries, file, position = [], 1, 4
    for i in range(n):
        kind = rng.choices(["QUERY", "XID", "INSERT", "UPDATE", "DELETE", "TABLE_MAP", "FORMAT"],
                           [5, 2, 3, 2, 1, 1, 1])[0]
        row = kind in ("INSERT", "UPDATE", "DELETE", "TABLE_MAP")
        entries.append({
            "seq": i, "log_file": f"bin.{file:06d}", "position": position, "kind": kind,
            "query": rng.choice(STATEMENTS) if kind == "QUERY" else None,
            "db": rng.choice(["a", "b"]) if row else None, "table": "t" if row else None,
            "captured": row and rng.random() < 0.6, "xid": i if kind == "XID" else None,
        })
        position += rng.randint(19, 60)
        if rng.random() < files / n:
            file, position = file + rng.randint(1, 3), 4
    return entries


def frame(spark, entries):
    rows = [tuple(e[c] for c in ("seq", "log_file", "position", "kind", "query", "db", "table", "captured", "xid"))
            for e in entries]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def same_grouping(ids, numbers):
    """Two labellings name the same groups."""
    forward, backward = defaultdict(set), defaultdict(set)
    for a, b in zip(ids, numbers):
        assert (a is None) == (b is None)
        forward[a].add(b)
        backward[b].add(a)
    return all(len(v) == 1 for v in forward.values()) and all(len(v) == 1 for v in backward.values())


@pytest.mark.parametrize("seed", range(6))
def test_txn_matches_replay(spark, seed):
    entries = random_log(seed)
    got = assign_txn(frame(spark, entries), slices=TINY).orderBy("seq").collect()
    want = list(replay(entries))
    assert [r.in_txn for r in got] == [w[0] for w in want]
    assert same_grouping([r.txn for r in got], [w[1] for w in want])
    assert [r.map_db for r in got] == [w[2] for w in want]
    assert all(r.txn is None or len(r.txn) == 36 for r in got)


def test_slices_do_not_change_ids(spark):
    log = frame(spark, random_log(99))
    small = assign_txn(log, slices=TINY).select("seq", "txn", "in_txn", "map_db")
    large = assign_txn(log).select("seq", "txn", "in_txn", "map_db")
    assert sorted(small.collect()) == sorted(large.collect())


def test_state_continues_across_parts(spark):
    entries = random_log(5)
    whole = {r.seq: (r.txn, r.in_txn, r.map_db) for r in assign_txn(frame(spark, entries), slices=TINY).collect()}
    parts, state = {}, {}
    for at in range(0, len(entries), 60):
        part = frame(spark, entries[at:at + 60])
        for r in assign_txn(part, slices=TINY, initial=state).collect():
            parts[r.seq] = (r.txn, r.in_txn, r.map_db)
        end = end_state(part).first().asDict()
        state = {**state, **{k: v for k, v in end.items() if v is not None}}
    assert parts == whole


def test_commit_needs_a_transaction_and_a_database(spark):
    entries = [
        dict(seq=0, kind="XID"), dict(seq=1, kind="QUERY", query="BEGIN"), dict(seq=2, kind="XID", xid=7),
        dict(seq=3, kind="INSERT", db="a", table="t", captured=True), dict(seq=4, kind="INSERT", db="b", table="t"),
        dict(seq=5, kind="XID", xid=8), dict(seq=6, kind="XID", xid=9),
    ]
    full = [{"log_file": "f.1", "position": 4 + 50 * e["seq"], "query": None, "db": None, "table": None,
             "captured": False, "xid": None, **e} for e in entries]
    got = commit_events(assign_txn(frame(spark, full))).orderBy("seq").collect()
    assert [(r.seq, r.db, int(r.xid)) for r in got] == [(2, "", 7), (5, "b", 8)]


def test_outcomes(spark):
    entries = []
    for i, q in enumerate(["BEGIN", "SET x", "COMMIT", "BEGIN", "ROLLBACK", "CREATE TABLE z", "BEGIN", "SET y"]):
        entries.append({"seq": i, "log_file": "f.000002", "position": 4 + 40 * i, "kind": "QUERY", "query": q,
                        "db": None, "table": None, "captured": False, "xid": None})
    got = txn_outcome(assign_txn(frame(spark, entries))).orderBy("first_position").collect()
    assert [(r.outcome, r.events) for r in got] == [("COMMITTED", 3), ("ROLLED BACK", 2), ("OPEN", 1), ("OPEN", 2)]
    assert (got[0].first_file, got[0].first_position, got[0].last_position) == (2, 4, 84)


@pytest.mark.parametrize("slices", [TINY, log_slices()], ids=["tiny", "default"])
def test_sequence_numbers(spark, slices):
    entries = random_log(3, n=300)
    got = event_sequence(frame(spark, entries), slices, start=10).orderBy("seq").collect()
    assert [r.seq_no for r in got] == list(range(11, 311))
    ordered = in_log_order(frame(spark, entries)).collect()
    assert [r.seq for r in ordered] == list(range(300))


def test_carry_keeps_rows_with_null_order_keys(spark):
    df = spark.createDataFrame([("f.1", None), (None, 5), ("f.1", 9)], "log_file STRING, position BIGINT")
    assert with_carry(df, log_slices(), count={"n": F.lit(True)}).count() == 3


def test_hot_slice_bound():
    s = log_slices()
    assert isinstance(s, Slices) and s.bundle == "_file div 4096"
    assert list(file_slices().keys) == ["_name"]


def test_track_position(spark):
    rows = [(0, "QUERY", 0, None, None), (1, "QUERY", 100, None, None), (2, "QUERY", 0, None, None),
            (3, "ROTATE", 300, "bin.2", 4), (4, "QUERY", 0, None, None), (5, "QUERY", 50, None, None),
            (6, "ROTATE", 0, "", 8), (7, "QUERY", 0, None, None)]
    raw = spark.createDataFrame(rows, "seq BIGINT, kind STRING, next_pos BIGINT, rotate_file STRING, rotate_pos BIGINT")
    for slices in (None, sequence_slices("seq", rows=2, bundle=2)):
        got = track_position(raw, slices=slices, start=("bin.1", 4)).orderBy("seq").collect()
        assert [(r.log_file, r.position) for r in got] == [
            ("bin.1", 4), ("bin.1", 100), ("bin.1", 100), ("bin.2", 4), ("bin.2", 4), ("bin.2", 50),
            ("<unknown>", 8), ("<unknown>", 8)]


def test_marks_and_resume(spark):
    log = frame(spark, random_log(1))
    top = high_water_mark(log).first()
    assert parse_mark(top.text) == (top.log_file, top.position)
    middle = log.where("seq = 200").first()
    assert after(log, (middle.log_file, middle.position)).count() == 199
    assert resume_from(log, checkpoint=top.text, start=("bin.000001", 4)).count() == 0
    assert resume_from(log, start=(middle.log_file, middle.position)).count() == 199
    assert resume_from(log).count() == 0
    # numeric, not textual, order of files
    names = spark.createDataFrame([("bin.999999", 9), ("bin.1000000", 4)], "log_file STRING, position BIGINT")
    assert high_water_mark(names).first().log_file == "bin.1000000"


def test_checkpoint_trail(spark):
    entries = random_log(8, n=120)
    trail = checkpoint_trail(frame(spark, entries), every_n=10, slices=file_slices(100)).collect()
    files = defaultdict(list)
    for e in entries:
        files[e["log_file"]].append(e["position"])
    want = [(f, 4, "rotate") for f in files]
    for f, positions in files.items():
        counter = 1
        for p in positions:
            counter += 1
            if counter >= 10:
                want.append((f, p, "interval"))
                counter = 0
    want.append((entries[-1]["log_file"], entries[-1]["position"], "end"))
    assert sorted(map(tuple, trail)) == sorted(want)

"""The text log with places: byte ranges, pruning, tailing, starts."""

import os

import pytest
from pyspark.sql import functions as F

from tidelog.sources import positioned
from tidelog.sources.positioned import cut, list_files, read_lines, read_positioned_log, read_positioned_stream


def lines_of(folder, size):
    out = []
    for f in list_files(folder):
        for part in cut(f, 0, f.size, size):
            for batch in read_lines(folder, part):
                out += [(r["file_no"], r["position"], r["json"]) for r in batch.to_pylist()]
    return out


def write(folder, name, data, mode="wb"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", mode) as f:
        f.write(data)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("chunk", [1, 5, 1 << 20])
def test_ranges_find_every_line_once(tmp_path, monkeypatch, size, chunk):
    monkeypatch.setattr(positioned, "CHUNK", chunk)
    folder = str(tmp_path / "log")
    write(folder, "bin.000002", b'{"a":1}\n\n{"b":22}\r\n' + "é漢\n".encode() + b"x" * 30 + b"\nlast")
    write(folder, "bin.000010", b"one\n")
    write(folder, "bin.000003", b"")
    write(folder, "_ignored", b"no\n")
    assert lines_of(folder, size) == [(2, 8, '{"a":1}'), (2, 19, '{"b":22}'), (2, 25, "é漢"), (2, 56, "x" * 30), (2, 60, "last"), (10, 4, "one")]


def test_unclear_names_raise(tmp_path):
    folder = str(tmp_path / "log")
    write(folder, "bin.000001", b"x\n")
    write(folder, "other.000002", b"x\n")
    with pytest.raises(ValueError, match="several logs"):
        list_files(folder)
    write(str(tmp_path / "b"), "plain", b"x\n")
    with pytest.raises(ValueError, match="no number"):
        list_files(str(tmp_path / "b"))
    assert [f.number for f in list_files(str(tmp_path / "none" if os.makedirs(tmp_path / "none") else tmp_path / "none"))] == []


def documents(n, at=0):
    return "".join(f'{{"type":"INSERT","db":"d","table":"t","rows":[{{"id":{k}}}]}}\n' for k in range(at, at + n)).encode()


def test_pushed_filters_prune_files(spark, tmp_path):
    folder = str(tmp_path / "log")
    for k in range(1, 6):
        write(folder, f"bin.{k:06d}", documents(3, k * 10))
    log = read_positioned_log(spark, folder)
    assert log.count() == 15
    late = log.where("file_no > 3")
    assert late.select("log_file").distinct().count() == 2 and late.rdd.getNumPartitions() == 2
    assert log.where("file_no = 2").rdd.getNumPartitions() == 1
    assert read_positioned_log(spark, folder, start=("bin.000004", 0)).count() == 6
    assert read_positioned_log(spark, folder, start="latest").count() == 0
    second = log.where("file_no = 4").agg(F.min("position")).first()[0]
    assert read_positioned_log(spark, folder, start=f"bin.000004\n{second}\n").count() == 5


def run(spark, folder, check, out, start=None):
    stream = read_positioned_stream(spark, folder, start)
    writer = stream.select("log_file", "position", "json").writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    writer.trigger(availableNow=True).start().awaitTermination()
    return sorted((r.log_file, r.position) for r in spark.read.schema("log_file STRING, position BIGINT, json STRING").parquet(out).collect())


def test_a_growing_file_is_tailed(spark, tmp_path):
    folder, check, out = (str(tmp_path / n) for n in ("log", "check", "out"))
    write(folder, "bin.000001", documents(2) + b'{"type":"INS')  # the last line is being written
    assert len(run(spark, folder, check, out)) == 2
    write(folder, "bin.000001", b'ERT"}\n' + documents(1), "ab")
    assert len(run(spark, folder, check, out)) == 4
    write(folder, "bin.000001", documents(1), "ab")
    write(folder, "bin.000002", documents(3))
    got = run(spark, folder, check, out)
    table = sorted((r.log_file, r.position) for r in read_positioned_log(spark, folder).collect())
    assert got == table and len(got) == 8


@pytest.mark.parametrize("start, count", [("earliest", 6), ("latest", 2), (("bin.000001", 0), 6), ("bin.000002\n0", 4)])
def test_starts_hold_over_a_restart(spark, tmp_path, start, count):
    folder, check, out = (str(tmp_path / n) for n in ("log", "check", "out"))
    write(folder, "bin.000001", documents(2))
    write(folder, "bin.000002", documents(2))
    run(spark, folder, check, out, start)
    write(folder, "bin.000003", documents(2))
    assert len(run(spark, folder, check, out, start)) == count


def test_many_small_files_share_tasks(spark, tmp_path):
    folder = str(tmp_path / "log")
    for k in range(1, 301):
        write(folder, f"bin.{k:06d}", documents(3, k * 10))
    log = read_positioned_log(spark, folder, range_bytes=50)
    assert log.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, log.select("log_file", "position", "json").collect())) == sorted(
        map(tuple, read_positioned_log(spark, folder).select("log_file", "position", "json").collect())) and log.count() == 900
    assert len(run(spark, folder, str(tmp_path / "check"), str(tmp_path / "out"))) == 900


def test_ranges_are_dealt_in_order():
    files = [positioned.LogFile(k, f"bin.{k}", "", 100 << 20) for k in range(4)]
    ranges = [part for f in files for part in cut(f, 0, f.size, 16 << 20)]
    packed = positioned.pack(ranges, 3)
    assert [p for group in packed for p in group.parts] == ranges
    assert all(sum(p.stop - p.start for p in group.parts) <= positioned.TASK_BYTES for group in packed)
    assert len(positioned.pack(ranges, 1000)) == len(ranges) and positioned.pack([], 3) == []

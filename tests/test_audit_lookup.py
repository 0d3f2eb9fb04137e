"""Lookups in a stored audit table read few rows, by the scan's own count."""

import datetime

import pytest

from tidelog.sinks.files import audit_lookup, write_audit

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def audit(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("audit") / "table")
    events = spark.range(40_000).selectExpr(
        "concat('bin.', lpad(cast(id div 10000 + 1 as string), 6, '0')) as log_file", "4 + id % 10000 * 100 as position", "'INSERT' as type",
        "sha2(cast(id div 5 as string), 256) as txn", "concat('d', cast(id % 2 as string)) as db", "concat('t', cast(id % 8 as string)) as `table`",
        "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) as ts", "repeat('x', 50) as json")
    write_audit(events, "audit", folder, row_group_bytes=100_000)
    return spark.read.parquet(folder)


def scanned(df):
    """(rows found, rows that the scan gave)."""
    plan = df._jdf.queryExecution()
    found = len(df.collect())
    executed = plan.executedPlan()
    if "AdaptiveSparkPlan" in executed.nodeName():
        executed = executed.executedPlan()
    return found, executed.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_lookups_read_few_row_groups(audit):
    txn = audit.where("binlog_position = 500004").first().txn_id
    found, read = scanned(audit_lookup(audit, txn=txn))
    assert found == 5 and read < 16_000
    found, read = scanned(audit_lookup(audit, db="d1", table="t3"))
    assert found == 5_000 and read < 14_000
    found, read = scanned(audit_lookup(audit, START + datetime.timedelta(seconds=100), START + datetime.timedelta(seconds=200), db="d0", table="t2"))
    assert found in (12, 13) and read < 8_000
    assert scanned(audit_lookup(audit, txn="none"))[0] == 0 and audit_lookup(audit).count() == 40_000
    assert scanned(audit_lookup(audit, until=START))[0] == 0

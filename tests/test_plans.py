"""Properties of the physical plans that must hold at any size."""

import re

import pytest

from tidelog.plans import catalog
from tidelog.plans.derived_log import derived_events, derived_log, rules
from tidelog.operators.capture import flag_captured
from tidelog.operators.txn import assign_txn, end_state


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large(spark):
    """Settings under which nothing but relations of known small size is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"txn_assign_stream", "text_stream", "pipeline_to_files", "rotated_files"}))
def test_no_cross_joins_and_no_row_udfs(spark, sf, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop|BatchEvalPython", text)


def test_transactions_shuffle_the_log_once(large, sf):
    known = large.createDataFrame(rules(large).toArrow(), rules(large).schema)
    text = plan(assign_txn(flag_captured(derived_log(large, sf), known)))
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(_file" in line and "_slice" in line]
    scans = [line for line in text.splitlines() if "FileScan" in line]
    # One exchange of the rows; the others carry one row per slice.
    rows_side = text[: text.index("SortMergeJoin") + text[text.index("SortMergeJoin"):].index("HashAggregate")]
    assert rows_side.count("FileScan") == 1 and len(scans) == 2 and "ReusedExchange" in text
    assert len([line for line in wide if "ReusedExchange" not in line]) >= 2
    # The join uses the order and the partitioning that the window has made.
    assert not re.search(r"SortMergeJoin[^\n]*\n[^\n]*Sort \[_file[^\n]*\n[^\n]*Window", rows_side)


def test_scans_read_only_what_is_used(spark, sf):
    def schema(df):
        return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)))
    assert schema(catalog.QUERIES["capture_dml"](spark, sf)) == {"event_id", "user_id", "event_type"}
    assert schema(catalog.QUERIES["event_kinds"](spark, sf)) == {"event_id", "event_type"}
    assert "ReadSchema: struct<>" in plan(catalog.QUERIES["received_total"](spark, sf))


def test_filters_reach_the_scan(spark, sf, tmp_path):
    ev = derived_events(spark, sf).select("log_file", "position", "db", "type", "json")
    ev.write.parquet(str(tmp_path / "log"))
    text = plan(spark.read.parquet(str(tmp_path / "log")).where("db = 'web'").select("position"))
    assert "EqualTo(db,web)" in text and "ReadSchema: struct<position:bigint,db:string>" in text


def test_routing_touches_events_once(spark, sf):
    text = plan(catalog.QUERIES["route_fanout"](spark, sf))
    events_side = text[text.rindex("FileScan") - 2000:]
    assert text.count("FileScan") == 1 and "Expand" not in text
    assert "Generate" not in "".join(line for line in events_side.splitlines() if "explode(array(concat" in line)


def test_last_event_hashes(spark, sf):
    for name in ("last_event", "last_event_overall"):
        text = plan(catalog.QUERIES[name](spark, sf))
        assert "max_by" not in text and re.search(r" HashAggregate\(keys=\[[^\]]*\], functions=\[partial_max\(_place", text)


def test_counters_combine_before_the_shuffle(spark, sf):
    for name in ("table_counts", "event_counters_by_table", "delivery_stats", "txn_outcome"):
        text = plan(catalog.QUERIES[name](spark, sf))
        assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", text), name


def test_documents_of_their_own_keys_are_not_sorted(spark):
    from tidelog.sources.config import rules_tables

    def doc(db, table, key):
        return '{"capture":{"databases":[{"%s":{"tables":[{"%s":{"primary_key":"%s"}}]}},{"other":{}}]}}' % (db, table, key)

    docs = spark.createDataFrame([(1, doc("a", "t", "z")), (2, doc("a", "t", "y")), (2, doc("a", "t", "x")), (2, doc("b", "t", "x")), (None, doc("a", "t", "n")),
                                  (None, doc("a", "t", "m")), (3, doc("c", "t", "w"))], "k INT, doc STRING")

    def found(rows):
        rules = rules_tables(rows, keep=["k"])[0]
        got = sorted((str(r.k), r.db, str(r.table), *r.primary_key) for r in rules.collect())
        return got, rules._jdf.queryExecution().optimizedPlan().toString()

    assert found(docs)[0] == [("1", "a", "t", "z"), ("1", "other", "None"), ("2", "a", "t", "x"), ("2", "b", "t", "x"), ("2", "other", "None"), ("3", "c", "t", "w"),
                              ("3", "other", "None"), ("None", "a", "t", "m"), ("None", "other", "None")]
    got, plan = found(docs.where("k in (1, 3)"))
    # The window is over documents that share keys; the others pass it by.
    assert len(got) == 4 and "LeftAnti" in plan and "LeftSemi" in plan


def test_end_of_a_batch_is_a_hash_aggregate_of_the_log(spark, sf):
    log = flag_captured(derived_log(spark, sf), rules(spark))
    text = plan(end_state(log))
    # The lowest aggregate is the one that reads the log.
    assert re.findall(r"(\w+Aggregate)\(", text)[-1] == "HashAggregate"
    places = [(int(r.log_file), r.position) for r in log.select("log_file", "position").collect()]
    found = end_state(log).first()
    assert (found._first_file, found._first_pos) == min(places) and (found._last_file, found._last_pos) == max(places)
    assert end_state(log.limit(0)).first()._last_file is None


def test_transaction_digest_is_computed_once(spark, sf):
    assigned = assign_txn(flag_captured(derived_log(spark, sf), rules(spark))).select("txn")
    tree = assigned._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("md5(") == 1

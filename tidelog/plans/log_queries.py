"""Queries over the log itself: capture, transactions, positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classify import classify_query, is_ddl
from ..functions.text import short_txn
from ..operators.capture import capture_tables, emit_only, flag_captured
from ..operators.order import event_sequence, in_log_order
from ..operators.position import after, checkpoint_trail, high_water_mark, resume_from, track_position
from ..operators.txn import assign_txn, commit_events, txn_outcome
from .derived_log import E, L, RULES, T, derived_log, rules
from .registry import query, table

MARK = ("000001", 50004)


def assigned(spark, sf):
    return assign_txn(flag_captured(derived_log(spark, sf), rules(spark)))


@query("capture_dml", f"""WITH {L}, {RULES}
SELECT log_file, position, kind, L.db AS db, L."table" AS "table" FROM L JOIN RULES r
  ON L.db = r.db AND L."table" = r."table" AND r.capture_dml""")
def capture_dml(spark, sf):
    return capture_tables(derived_log(spark, sf), rules(spark)).select("log_file", "position", "kind", "db", "table")


@query("capture_ddl_commit", f"""WITH {E}
SELECT log_file, position, db, "table", txn FROM E WHERE kind IN ('QUERY', 'XID')""")
def capture_ddl_commit(spark, sf):
    emitted = emit_only(assigned(spark, sf), rules(spark))
    return emitted.where("kind in ('QUERY', 'XID')").select("log_file", "position", "db", "table", "txn")


@query("event_kinds", f"WITH {L} SELECT seq, code, kind FROM L")
def event_kinds(spark, sf):
    return derived_log(spark, sf).select("seq", "code", "kind")


@query("query_class", f"""WITH {L}, Q AS (
  SELECT seq, 'q' AS source, query FROM L WHERE kind = 'QUERY'
  UNION ALL SELECT doc_id, 'd', text FROM documents)
SELECT seq, source, class AS statement_class, class IN ('CREATE', 'ALTER', 'DROP', 'TRUNCATE', 'RENAME') AS is_ddl FROM (
  SELECT *, CASE WHEN upper(query) LIKE 'BEGIN%' THEN 'BEGIN' WHEN upper(query) LIKE 'COMMIT%' THEN 'COMMIT'
    WHEN upper(query) LIKE 'ROLLBACK%' THEN 'ROLLBACK' WHEN upper(query) LIKE 'CREATE%' THEN 'CREATE'
    WHEN upper(query) LIKE 'ALTER%' THEN 'ALTER' WHEN upper(query) LIKE 'DROP%' THEN 'DROP'
    WHEN upper(query) LIKE 'TRUNCATE%' THEN 'TRUNCATE' WHEN upper(query) LIKE 'RENAME%' THEN 'RENAME'
    ELSE 'QUERY' END AS class FROM Q)""")
def query_class(spark, sf):
    statements = derived_log(spark, sf).where("kind = 'QUERY'").selectExpr("seq", "'q' as source", "query")
    texts = table(spark, sf, "documents").selectExpr("doc_id as seq", "'d' as source", "text as query")
    return statements.unionByName(texts).select(
        "seq", "source", classify_query("query").alias("statement_class"),
        is_ddl(classify_query("query")).alias("is_ddl"))


@query("txn_assign", f"""WITH {T}
SELECT log_file, position, kind, txn, in_txn, map_db FROM T""")
def txn_assign(spark, sf):
    return assigned(spark, sf).select("log_file", "position", "kind", "txn", "in_txn", "map_db")


@query("txn_outcome", f"""WITH {T}
SELECT txn, CASE WHEN bool_or(kind = 'XID') THEN 'COMMITTED' ELSE 'OPEN' END AS outcome, count(*) AS events,
  min(file_no) AS first_file, arg_min(position, seq) AS first_position,
  max(file_no) AS last_file, arg_max(position, seq) AS last_position
FROM T WHERE txn IS NOT NULL GROUP BY txn""")
def outcome(spark, sf):
    return txn_outcome(assigned(spark, sf))


@query("commit_events", f"""WITH {T}
SELECT log_file, position, txn, coalesce(map_db, '') AS db, xid FROM T WHERE kind = 'XID' AND txn IS NOT NULL""")
def commits(spark, sf):
    return commit_events(assigned(spark, sf)).select(
        "log_file", "position", "txn", "db", F.col("xid").cast("bigint").alias("xid"))


@query("short_txn", f"""WITH {T}
SELECT log_file, position, substr(txn, 1, 8) AS short8, substr(txn, 1, 32) AS short32 FROM T WHERE txn IS NOT NULL""")
def short(spark, sf):
    return assigned(spark, sf).where("txn is not null").select(
        "log_file", "position", short_txn("txn").alias("short8"), short_txn("txn", 32).alias("short32"))


def raw_log(spark, sf):
    """Events as they arrive: some without an end offset, a rotation every 500."""
    return table(spark, sf, "events").selectExpr(
        "event_id as seq",
        "case when event_id % 500 = 499 then 'ROTATE' else 'QUERY' end as kind",
        "case when event_id % 7 = 0 then 0 else 4 + (event_id % 500) * 100 end as next_pos",
        """case when event_id % 4000 = 3999 then ''
                when event_id % 500 = 499 then concat('bin.', lpad(cast(event_id div 500 + 2 as string), 9, '0'))
           end as rotate_file""",
        "case when event_id % 500 = 499 then 4L end as rotate_pos",
    )


@query("position_track", """WITH R AS (
  SELECT event_id AS seq, event_id % 500 = 499 AS rotate,
    CASE WHEN event_id % 7 = 0 THEN 0 ELSE 4 + (event_id % 500) * 100 END AS next_pos,
    CASE WHEN event_id % 500 = 499 THEN CASE WHEN event_id % 4000 = 3999 THEN '<unknown>'
      ELSE 'bin.' || lpad(CAST(event_id // 500 + 2 AS VARCHAR), 9, '0') END END AS rotate_file
  FROM events)
SELECT seq, coalesce(last_value(rotate_file IGNORE NULLS) OVER w, 'bin.000000001') AS log_file,
  coalesce(last_value(CASE WHEN rotate THEN 4 WHEN next_pos > 0 THEN next_pos END IGNORE NULLS) OVER w, 4) AS position
FROM R WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def position_track(spark, sf):
    return track_position(raw_log(spark, sf), start=("bin.000000001", 4)).select("seq", "log_file", "position")


@query("high_water_mark", f"""WITH {L}
SELECT log_file, position, log_file || chr(10) || position AS text FROM L ORDER BY file_no DESC, position DESC LIMIT 1""")
def hwm(spark, sf):
    return high_water_mark(derived_log(spark, sf))


@query("resume_after", f"""WITH {L}
SELECT log_file, position, kind FROM L WHERE file_no > 1 OR (file_no = 1 AND position > 50004)""")
def resume_after(spark, sf):
    return after(derived_log(spark, sf), MARK).select("log_file", "position", "kind")


@query("resume_from_checkpoint", f"""WITH {L}
SELECT log_file, count(*) AS events FROM L WHERE file_no > 1 OR (file_no = 1 AND position > 50004) GROUP BY log_file""")
def resume_checkpoint(spark, sf):
    rest = resume_from(derived_log(spark, sf), checkpoint=f"{MARK[0]}\n{MARK[1]}\n", start=("000001", 4))
    return rest.groupBy("log_file").agg(F.count("*").alias("events"))


@query("checkpoint_trail", f"""WITH {L}, N AS (
  SELECT log_file, position, row_number() OVER (PARTITION BY log_file ORDER BY position) AS n FROM L)
SELECT DISTINCT log_file, CAST(4 AS BIGINT) AS position, 'rotate' AS reason FROM L
UNION ALL SELECT log_file, position, 'interval' FROM N WHERE (n + 1) % 100 = 0
UNION ALL SELECT * FROM (SELECT log_file, position, 'end' FROM L ORDER BY file_no DESC, position DESC LIMIT 1)""")
def trail(spark, sf):
    return checkpoint_trail(derived_log(spark, sf), every_n=100)


@query("checkpoint_every_event", f"""WITH {L}
SELECT DISTINCT log_file, CAST(4 AS BIGINT) AS position, 'rotate' AS reason FROM L
UNION ALL SELECT log_file, position, 'interval' FROM L
UNION ALL SELECT * FROM (SELECT log_file, position, 'end' FROM L ORDER BY file_no DESC, position DESC LIMIT 1)""")
def trail_every(spark, sf):
    return checkpoint_trail(derived_log(spark, sf))


@query("event_sequence", f"""WITH {L}
SELECT log_file, position, row_number() OVER (ORDER BY file_no, position) AS seq_no FROM L""")
def sequence(spark, sf):
    return event_sequence(derived_log(spark, sf).select("log_file", "position"))


@query("log_order", f"WITH {L} SELECT log_file, position, kind FROM L ORDER BY file_no, position")
def log_order(spark, sf):
    return in_log_order(derived_log(spark, sf)).select("log_file", "position", "kind")

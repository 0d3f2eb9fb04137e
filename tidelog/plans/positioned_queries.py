"""Queries over a text log read with its places."""

from __future__ import annotations

from ..operators.capture import flag_captured
from ..operators.order import event_sequence
from ..operators.position import checkpoint_trail
from ..operators.txn import assign_txn
from ..sinks.files import rotation_plan
from ..sources.positioned import read_positioned_log, read_positioned_stream
from .derived_log import J, derived_events, rules
from .registry import query
from .stream_queries import work_folder

# Small ranges, so that lines cross them.
RANGE = 50_000

# The text log: documents one a line, a place is the end of the line.
P = f"""{J},
P AS (
  SELECT log_file, file_no, seq, kind, db,
    CAST(sum(octet_length(encode(json)) + 1) OVER (PARTITION BY log_file ORDER BY seq) AS BIGINT) AS position
  FROM J)"""


def text_log(spark, sf) -> str:
    """The derived events as a text log, one file per log file."""
    folder = f"{work_folder(spark)}/log"
    events = derived_events(spark, sf).select("log_file", "position", "json")
    ordered = events.repartition("log_file").sortWithinPartitions("log_file", "position").select("log_file", "json")
    # Tasks move their own files: the driver moving a folder per log file, one after another, would grow with the log.
    ordered.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("log_file").text(folder)
    return folder


@query("positioned_sequence", f"""WITH {P}, N AS (
  SELECT log_file, position, kind, row_number() OVER (ORDER BY file_no, position) AS seq_no, count(*) OVER () AS n FROM P),
S AS (SELECT *, (seq_no - 1) // 150 AS segment, (n - 1) // 150 - 1 - (seq_no - 1) // 150 AS suffix FROM N)
SELECT log_file, position, kind, seq_no, segment, CASE WHEN suffix >= 0 THEN suffix END AS suffix, suffix < 5 AS kept FROM S""")
def positioned_sequence(spark, sf):
    """Sequence numbers and the rotation plan of a text log."""
    events = read_positioned_log(spark, text_log(spark, sf), range_bytes=RANGE).select("log_file", "position", "kind")
    return rotation_plan(event_sequence(events), 150)


@query("positioned_txn", f"""WITH {P}, X AS (
  SELECT *, coalesce(last_value(CASE WHEN kind = 'XID' THEN false WHEN kind <> 'QUERY' THEN true END IGNORE NULLS) OVER w, false) AS in_txn,
    last_value(CASE WHEN kind = 'XID' THEN file_no || '|' || position END IGNORE NULLS) OVER w AS edge
  FROM P WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
Y AS (
  SELECT *, md5(CASE WHEN kind = 'QUERY' AND NOT in_txn THEN 'log|at|' || file_no || '|' || position
                     WHEN kind <> 'XID' OR in_txn THEN 'log|after|' || coalesce(edge, '-1|-1') END) AS digest FROM X)
SELECT log_file, position, kind, in_txn, substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4) || '-' ||
  substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS txn FROM Y""")
def positioned_txn(spark, sf):
    """Transactions of a text log by its own places."""
    events = read_positioned_log(spark, text_log(spark, sf), range_bytes=RANGE)
    return assign_txn(flag_captured(events, rules(spark))).select("log_file", "position", "kind", "in_txn", "txn")


@query("positioned_trail", f"""WITH {P}, N AS (SELECT log_file, position, row_number() OVER (PARTITION BY log_file ORDER BY position) AS n FROM P)
SELECT DISTINCT log_file, CAST(4 AS BIGINT) AS position, 'rotate' AS reason FROM P
UNION ALL SELECT log_file, position, 'interval' FROM N WHERE (n + 1) % 50 = 0
UNION ALL SELECT * FROM (SELECT log_file, position, 'end' FROM P ORDER BY file_no DESC, position DESC LIMIT 1)""")
def positioned_trail(spark, sf):
    """Checkpoints along a text log."""
    events = read_positioned_log(spark, text_log(spark, sf), range_bytes=RANGE).select("log_file", "position")
    return checkpoint_trail(events, every_n=50)


@query("positioned_stream", f"""WITH {P}, M AS (SELECT file_no, position FROM P ORDER BY seq LIMIT 1 OFFSET 100)
SELECT log_file, position, kind, db FROM P WHERE file_no > (SELECT file_no FROM M) OR (file_no = (SELECT file_no FROM M) AND position > (SELECT position FROM M))""")
def positioned_stream(spark, sf):
    """A tail of the text log that starts at a place, the end of event 101."""
    folder, work = text_log(spark, sf), work_folder(spark)
    places = event_sequence(read_positioned_log(spark, folder).select("log_file", "position"))
    mark = places.where("seq_no = 101").first()
    stream = read_positioned_stream(spark, folder, start=(mark.log_file, mark.position), range_bytes=RANGE)
    writer = stream.select("log_file", "position", "kind", "db").writeStream.format("parquet").option("path", f"{work}/out")
    writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{work}/out")

"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.  Each query runs once to
warm up and twice for the clock; every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.plans import catalog  # noqa: E402
from tidelog.session import local_session  # noqa: E402

HEADLINE = [
    "table_activity", "txn_assign", "txn_outcome", "event_sequence", "checkpoint_trail", "position_track",
    "project_columns", "kafka_records", "audit_rows", "event_counters_by_table", "route_fanout", "dispatch_counts",
    "changed_fields", "pack_rows", "partition_lag", "windowed_counters", "decode_columns", "rules_tables",
    "size_guard", "corrupt_split", "blob_preview",
]


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        seconds[name] = round(min(timed(spark, sf_dir, name) for _ in range(2)), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total wall-clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

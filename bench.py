"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to the end (all rows, all columns, no output kept); the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from velotrail.queries import QUERIES
from velotrail.session import local_session

HEADLINE = (
    "parse_strict", "latest_position", "keep_last_n", "trimmed_rows", "rank_range", "track_history",
    "track_history_many", "recent_track_many", "key_range_scan", "scan_pages", "batch_latency", "delay_report",
    "progress_marks", "integrate_track", "cell_get", "cell_versions", "rows_get", "rows_get_ordered", "scan_spec",
    "mutate_rows", "increment_cells", "delete_typed", "check_and_mutate", "sink_history", "sink_recent",
    "st_history", "st_recent",
)
STREAMS = ("st_history", "st_recent")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {name: round(events / seconds[name]) for name in STREAMS},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

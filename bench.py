"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose the data and the cores. Each query runs once to warm up and then twice;
the better time counts. Results go to Spark's no-op sink, so all rows are made.
"""

from __future__ import annotations

import json
import os
import time

from millrace import build_session
from workload import QUERIES

HEADLINE = [
    "json_decode", "filter_chain", "rule_chain", "dedup_anchor", "dedup_annotate",
    "dedup_minute_bucket", "dedup_large_keys", "dedup_stream", "temporal_match",
    "temporal_match_large_keys", "interval_join_all", "joined_projection",
    "transactions_table", "session_table", "match_more", "update_many", "limit_documents",
    "event_route", "flow_topic", "flow_join", "flow_topic_stream", "windowed_analytics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        best = None
        for attempt in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "events": events,
                "events_per_sec": {
                    n: round(events / times[n])
                    for n in ("dedup_anchor", "temporal_match", "interval_join_all", "flow_topic")
                },
            }
        )
    )


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then RUNS times into the ``noop`` sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parley.catalog import QUERIES  # noqa: E402
from parley.session import build_session  # noqa: E402

RUNS = 3
HEADLINE = {
    "clean": "clean_messages",
    "training_table": "training_table",
    "training_table_full": "training_table_full",
    "bursts": "coalesce_bursts_first",
    "sessions_context": "add_context_plain_events",
    "heatmap": "message_heatmap_events",
    "group_chats": "drop_group_chats",
    "augment": "augment_questions",
    "metrics": "evaluate_pairs",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "parley-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in HEADLINE.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[query](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    spark.stop()
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale)}
        )
    )


if __name__ == "__main__":
    main()

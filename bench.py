"""Headline timings: prints one JSON line.

Each query is warmed up once, then run BENCH_RUNS times (default 3) into the
no-op sink; the median is reported, the value is the sum of medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from warcloom.plans import catalogue  # noqa: E402
from warcloom.session import get_spark  # noqa: E402

HEADLINE = [
    "ag_4_count_status_codes",
    "ag_1_summarise_logs",
    "ag_2_host_histograms",
    "jn_1_watched_prefix_join",
    "fn_1_classify_path",
    "ag_6_holdings_by_stream",
    "ag_11_duplicate_files",
    "wn_1_first_n_per_host",
    "ag_5_cdx_file_metrics",
    "jn_24_launch_latency",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = get_spark(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for key in wanted:
        samples = []
        for _ in range(runs + 1):
            start = time.time()
            catalogue.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.time() - start)
        timings[key] = round(statistics.median(samples[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()

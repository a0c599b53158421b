"""Times headline queries: one warm-up, then the median of three runs with the whole result forced.

Prints one JSON line. BENCH_SF_DIR names the tables' folder, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated list ("all" for every registered query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

HEADLINE = [
    "gold_monthly", "top_peaks", "regions_key", "season_correlations", "corr_matrix", "describe", "describe_bounded",
    "box_by_hour", "zscore_outliers", "iqr_outliers", "welch_test", "linear_fit", "hourly_series", "keyed_series",
    "joined_hour", "hourly_base", "dup_rows", "dedupe_first", "upsert_partial", "flatten_blocks", "page_links",
    "page_meta", "frontier", "stream_upsert", "stream_hourly",
]


def main() -> None:
    from gridlake import session
    from gridlake.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

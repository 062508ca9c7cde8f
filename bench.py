"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs fully (written to Spark's no-op sink, nothing collected), once
to warm up and then BENCH_RUNS times; the median wall time is reported.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from homestat.plans.queries import queries  # noqa: E402
from homestat.session import build_session  # noqa: E402

HEADLINE = [
    "clean_listings",
    "eda_by_district",
    "eda_by_type",
    "wh_district_stats",
    "wh_merged_district_stats",
    "merge_by_district",
    "kpi_cards",
    "dash_group_sizes",
    "prof_nulls",
    "prof_topk_categories",
    "prof_duplicates",
    "stream_enrich",
    "stream_agg_complete",
    "topk_districts",
    "ml_string_index",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(f"local[{cpus}]", app="homestat-bench", conf={
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        # the bench tables are single files with one row group each
        "spark.homestat.scanPartitions": cpus,
    })
    qs = queries()
    times: dict[str, float] = {}
    for name in names:
        fn = qs[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

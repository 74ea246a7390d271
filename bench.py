"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads, ``BENCH_RUNS`` the timed
runs per query (the best one counts). Every query is run in full into a sink that
discards its rows. A first small query starts the engine and is not counted.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from trackloom.catalog.queries import QUERIES

HEADLINE = [
    "region_filter", "enrich_routes", "silver_states", "merge_gold", "raw_telemetry",
    "fact_flight_history", "dim_route_analytics", "dim_aircraft_utilization",
    "dim_airspace_heatmap", "merge_unified", "flight_summary", "airline_stats",
    "airport_stats", "hourly_stats", "enrich_range_first", "enrich_hybrid", "nearest_site",
    "two_nearest", "track_endpoints", "infer_routes", "track_distance", "latest_state",
    "dedup_states", "build_mapping", "scan_states_csv", "stream_enrich", "stream_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

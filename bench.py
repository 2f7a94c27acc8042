"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores. Each query runs once to
warm up, then BENCH_RUNS times (3); its time is the median. Writes and loads are part of their queries.
"""

import json
import os
import statistics
import sys
import time

from tablewright.plans.queries import QUERIES
from tablewright.session import build_session

HEADLINE = [
    "status_summary",
    "apply_mapping_orders",
    "latest_order_per_customer",
    "enrich_latest",
    "relationalize_child",
    "choice_make_cols",
    "choice_cast_long",
    "daily_engagement_kpis",
    "parse_log",
    "reject_rows",
    "table_partitioned",
    "incremental_two_loads",
    "keyed_upsert",
    "compacted_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()

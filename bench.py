"""Time the registered queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma-separated) override the
defaults. Every query gets one warm-up and then the median of BENCH_RUNS runs, building
the plan and computing every result row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cityflow import session
from cityflow.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# One untimed pass over a measure before the first query is timed.
WARM_UP = "q_revenue_measures"


def seconds(run, spark) -> float:
    start = time.perf_counter()
    run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session.build(
        "cityflow-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            # Each table is one small file. A low threshold keeps order lines from being
            # taken for a dimension, so joins are planned as they would be on large data.
            "spark.sql.autoBroadcastJoinThreshold": "2m",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    seconds(QUERIES[WARM_UP], spark)
    times = {}
    for name in names:
        seconds(QUERIES[name], spark)
        times[name] = round(
            statistics.median(seconds(QUERIES[name], spark) for _ in range(RUNS)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

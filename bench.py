"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs once to warm
up, then BENCH_RUNS times (3); the median counts. Results go to the noop sink, so
all rows and columns are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rivulet.session import local_session  # noqa: E402
from suite import queries  # noqa: E402

HEADLINE = [
    queries.flagship_fact,
    queries.flatten_readings,
    queries.flatten_stations,
    queries.silver_measure,
    queries.gold_fact_keys,
    queries.latest_n_readings,
    queries.fetch_all_units,
    queries.resolve_measures,
    queries.upsert_last_wins,
    queries.upsert_merge,
    queries.dim_stable_keys,
    queries.insert_if_absent,
    queries.orphan_measures,
    queries.duplicate_groups,
    queries.normalize_ts,
    queries.pipeline_summary,
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for query in HEADLINE:
        run(query, spark, sf_dir)
        times = [run(query, spark, sf_dir) for _ in range(runs)]
        seconds[query.__name__] = round(statistics.median(times), 3)
        print(query.__name__, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

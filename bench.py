"""Time the registered queries; print one JSON line.

Each query's time also goes to the error stream as soon as it ends, so that a
run that is cut short leaves figures. Each query is built and run to the end into Spark's ``noop`` sink, with all
its rows and columns. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and
cores, ``BENCH_QUERIES`` (comma-separated) a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tatemono.queries import QUERIES
from tatemono.session import local_session
from tatemono.sources import scratch


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "q_mart", sf_dir)  # start the JVM's compilers and the page cache
    seconds = {}
    for name in names:
        seconds[name] = run(spark, name, sf_dir)
        print(json.dumps({"query": name, "sec": seconds[name]}), file=sys.stderr, flush=True)
    scratch.remove_tables(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the registered queries. Prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local
cores, BENCH_RUNS how often each query runs (the best run counts). Every query runs
to its end: a plan into the ``noop`` sink, a stream into its table and from there.
"""

from __future__ import annotations

import json
import os
import sys
import time

from voltstream.queries import registered
from voltstream.session import get_spark
from voltstream.streaming.workdir import remove_made


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        spark_driver_memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    timings: dict[str, float] = {}
    only = tuple(sys.argv[1:])
    for name, query in registered().items():
        if only and not name.startswith(only):
            continue
        timings[name] = round(min(_seconds(query, spark, sf_dir) for _ in range(runs)), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total query seconds, best of runs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


def _seconds(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - began
    remove_made(spark)
    return seconds


if __name__ == "__main__":
    main()

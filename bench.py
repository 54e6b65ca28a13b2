"""Time every registered query and print one JSON line.

    BENCH_SF_DIR  folder of the tables     (default /root/testdata/sf0.1)
    BENCH_CPUS    threads of the local run (default 8)

Each query is timed once, from building its frame to having computed all of its
rows and columns. The silver layer that the gold queries read is built, and
timed, on its own beforehand.
"""

from __future__ import annotations

import json
import os
import sys
import time

from shopgrain import scratch
from shopgrain.registry import common, queries
from shopgrain.session import build_session


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the engine and of the file readers is not part of any query.
    run(spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count())

    timings: dict[str, float] = {}
    start = time.perf_counter()
    common.lake(spark, folder)
    timings["silver_layer_build"] = round(time.perf_counter() - start, 3)
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        run(build(spark, folder))
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    scratch.release(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])

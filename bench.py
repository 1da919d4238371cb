"""Time the headline queries, each run to its last row, and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from salescope.plans.registry import QUERIES

def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("salescope-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
    )
    if os.environ.get("BENCH_SCRATCH"):
        builder = builder.config("spark.checkpoint.dir", os.environ["BENCH_SCRATCH"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query: class loading and code generation are no part of any query's time.
    QUERIES["top_spenders"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name, query in QUERIES.items():
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

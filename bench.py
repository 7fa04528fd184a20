"""Time every catalog query at one scale and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from catalog import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("scanweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scanweave-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    wanted = sys.argv[1:] or list(QUERIES)
    spark = session()
    # Start the JVM's compilers and the Python workers before the clock runs.
    for name in ("domain_graph", "cert_table"):
        QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in wanted:
        begin = time.perf_counter()
        try:  # a query that fails takes its own figure only
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        except Exception as error:
            failed[name] = str(error).splitlines()[0][:200]
        else:
            times[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {times.get(name, 'failed')}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "catalog_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                **({"failed": failed} if failed else {}),
                "sf": os.path.basename(FOLDER.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

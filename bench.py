"""Time the named questions; prints one JSON line.

Each query is run once to warm up and then three times; its time is the median. Results are
fully computed and thrown away, so nothing is collected to the driver. With ``--plain`` the nine
questions are also timed as plain Spark SQL (``plain_sql.py``), under "plain_sql" in the line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from boletim.plans.queries import NAMED_QUERIES, media_global
from boletim.operators.quality import check_warehouse
from derived_views import warehouse
from plain_sql import STATEMENTS, plain

RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("boletim-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(question, w) -> float:
    seconds(lambda: question(w))
    return round(statistics.median(seconds(lambda: question(w)) for _ in range(RUNS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    w = warehouse(spark, sf_dir)
    headline = {**NAMED_QUERIES, "media_global": media_global, "dq_warehouse": check_warehouse}
    times = {name: timed(question, w) for name, question in headline.items()}
    line = {
        "metric": "total_median_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if "--plain" in sys.argv[1:]:
        line["plain_sql"] = {name: timed(plain(name), w) for name in STATEMENTS}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from fieldspark.queries import QUERIES

HEADLINE = ["dedup_within_source", "dedup_cross_source", "qc_flags", "policy_baseline", "runlog_filtered", "cell_counts", "point_in_polygon"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", scratch).config("spark.checkpoint.dir", f"file://{scratch}/shared").config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.sql.codegen.cache.maxEntries", "1000").config("spark.sql.codegen.hugeMethodLimit", "8000")  # the JVM compiles no larger method: those of the wide chains would be interpreted
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):  # the first warms up; the median of the others counts
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then twice; its time is the shorter one, from
building the plan to the last row (written to the ``noop`` sink, so that every
column is computed).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from itemflow.catalog import QUERIES

HEADLINE = [
    "flagship_activity_scores",
    "clean_test_map",
    "clean_section_map",
    "clean_qbank",
    "audit_funnel",
    "repeat_omit",
    "repeat_administration",
    "answer_key_inferred",
    "user_info",
    "item_info",
    "matrix_long",
    "matrix_scores",
    "matrix_summary",
    "combine_full",
    "combine_sources",
]


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("itemflow-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = session(cpus)
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

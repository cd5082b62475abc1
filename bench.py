"""Time the registered queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

``python bench.py all`` times every query, ``python bench.py name ...`` only those named.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from inciscope.bindings.catalog import QUERIES
from inciscope.session import configure, scratch

HEADLINE = [
    "district_performance",
    "monthly_trend",
    "yoy_change",
    "shift_analysis",
    "weekday_pattern",
    "community_profile",
    "type_breakdown",
    "type_by_area",
    "rate_vs_overall",
    "domestic_style_rates",
    "kpi_summary",
    "feature_table_entity",
    "feature_table_group_year",
    "fact_build",
    "null_profile",
    "duplicate_summary",
    "duplicate_histogram",
    "type_validity",
    "value_distribution",
    "join_key_validation",
    "typed_records",
    "quality_gates",
    "gate_summary",
    "dedup_latest",
    "conform_dims",
    "top_k_per_group",
    "describe_stats",
    "correlation_pairs",
    "zscore",
    "silhouette_samples",
    "davies_bouldin",
]


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    with scratch(spark):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("inciscope-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    chosen = list(QUERIES) if names == ["all"] else names or HEADLINE
    run(spark, sf_dir, "district_performance")  # start the executors
    seconds = {n: round(statistics.median(run(spark, sf_dir, n) for _ in range(repeats)), 3) for n in chosen}
    total = round(sum(seconds.values()), 3)
    report = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps(report | {"sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

"""Benchmark: seconds per headline query, one warm-up, median of three runs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Results go to the noop sink, so every row is computed and none is stored. Past
BENCH_BUDGET seconds the remaining queries get one measured run instead of three. Loads write
tables on the way and get one run, warm from what ran before.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetquill.catalog import standins, stored  # noqa: E402
from fleetquill.catalog.queries import QUERIES, dimension_sources  # noqa: E402
from fleetquill.operators import dimensions, merge  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BUDGET = float(os.environ.get("BENCH_BUDGET", "420"))

HEADLINE = [
    "dim_main",
    "dim_dfcc",
    "dim_hw_sw_number",
    "dim_dtc",
    "dim_zp8_date",
    "dim_fault_type",
    "dim_mis_label",
    "merge_modprod",
    "merge_baseline_first_seen",
    "baseline_first_seen",
    "flatten_baseline",
    "incremental_core_load",
    "classify_files",
    "normalize_sales_class",
    "duplicate_strategy",
    "response_triage",
    "min_watermark",
]
LOADS = ["core_load_files", "baseline_load_files", "written_dimensions"]


def late_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_fault_type without the distinct before the join, for comparison."""
    dimension = dimensions.BY_NAME["dim_fault_type"]
    sources = dimension_sources(spark, sf_dir, dimension.sources)
    bridge = dimensions.model_bridge(sources[dimensions.ERROR_FACT])
    return (
        sources[dimension.source]
        .join(bridge, dimensions.KEY)
        .select(*dimension.columns)
        .distinct()
    )


def merge_one_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only merge of all order lines, one in a hundred of them new."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    target = standins.table(spark, sf_dir, "lineitem").select(*keys)
    number = F.col("l_linenumber")
    updates = target.withColumn(
        "l_linenumber", F.when(F.col("l_orderkey") % 100 == 0, number + 100).otherwise(number)
    )
    return merge.new_rows(updates, target, keys)


def written_one_by_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """written_dimensions with the source read for each of them, for comparison."""
    return stored.write_and_read(spark, sf_dir, together=False)


def run(make, spark: SparkSession) -> float:
    start = time.perf_counter()
    make(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("fleetquill-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = {name: QUERIES[name] for name in HEADLINE}
    todo["dim_fault_type_late_distinct"] = late_distinct
    todo["merge_one_percent"] = merge_one_percent
    began = time.perf_counter()
    seconds = {}
    for name, make in todo.items():
        run(make, spark)
        runs = 3 if time.perf_counter() - began < BUDGET else 1
        seconds[name] = round(
            statistics.median(run(make, spark) for _ in range(runs)), 3
        )
    loads = {name: QUERIES[name] for name in LOADS}
    loads["written_one_by_one"] = written_one_by_one
    for name, make in loads.items():
        seconds[name] = round(run(make, spark), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

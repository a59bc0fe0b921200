"""What the physical plans of the registered queries must look like."""

import re

import pytest

import __spark_entry__ as entry
from fleetquill.catalog import standins
from fleetquill.catalog.queries import QUERIES
from fleetquill.operators import dimensions
from fleetquill.sources import files

SF_DIR = "/root/testdata/sf0.001"
# Queries whose result is one row, or that read one value as a subquery.
ONE_ROW = {"min_watermark", "move_report", "baseline_first_seen"}


def plan_of(spark, name, broadcast=True):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old if broadcast else "-1")
    try:
        df = entry.queries()[name](spark, SF_DIR)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_no_python_no_single_task(spark, name):
    plan = plan_of(spark, name, broadcast=False)
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan
    if name not in ONE_ROW:
        assert "SinglePartition" not in plan


def read_columns(plan, some_column):
    """Columns of the scan that reads ``some_column``."""
    for found in re.findall(r"FileScan parquet \[([^\]]*)\]", plan):
        names = {c.split("#")[0] for c in found.split(",")}
        if some_column in names:
            return names
    raise AssertionError(f"no scan reads {some_column}")


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(spark, "dim_main")
    assert read_columns(plan, "l_orderkey") == {"l_orderkey", "l_partkey", "l_suppkey"}
    assert read_columns(plan, "o_orderkey") == {"o_orderkey", "o_custkey"}
    assert read_columns(plan, "p_partkey") == {"p_partkey", "p_type"}
    moved = plan_of(spark, "move_report")
    assert read_columns(moved, "page_id") == {"page_id"}


def test_shuffles_of_a_fact_dimension(spark):
    """Two joins of the fact, three below it, one distinct."""
    plan = plan_of(spark, "dim_dfcc", broadcast=False)
    assert len(re.findall(r"Exchange hashpartitioning\(l_\w+", plan)) == 2
    last = plan.split("Exchange")[1]
    assert dimensions.BASE[0] in last.split("\n")[0]


def test_tasks_of_the_fact_grow_with_its_files(spark, monkeypatch):
    """AQE merges no partitions that are dealt by a number."""
    before = QUERIES["dim_dtc"](spark, SF_DIR)
    monkeypatch.setattr(standins, "TASK_BYTES", 4096)
    size = sum(files.size(spark, f"{SF_DIR}/{t}.parquet") for t in ("lineitem", "orders"))
    assert size // 4096 >= standins.LEAST_TASKS
    after = QUERIES["dim_dtc"](spark, SF_DIR)
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    for key in ("o_orderkey", "p_partkey"):
        assert re.search(rf"RepartitionByExpression \[{key}#\d+L?\], {size // 4096}\b", plan)
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect()))


def test_merge_shuffles_each_side_once_for_key_and_join(spark):
    plan = plan_of(spark, "merge_baseline_first_seen", broadcast=False)
    right = plan.split("LeftAnti")[1]
    assert len(re.findall("Exchange hashpartitioning", right)) == 2

"""Counts of dimensions that are worked out slice by slice."""

import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import rows
from fleetquill.catalog import queries, standins
from fleetquill.operators import dimensions
from fleetquill.plans import dimension_counts, staging
from fleetquill.sources import files

SF_DIR = "/root/testdata/sf0.001"


def odd_rows(spark, like, n):
    """Rows of few values and nulls in every column, each of them twice."""
    columns = []
    for i, (name, kind) in enumerate(like.dtypes):
        number = F.col("id") * (2 * i + 3) % (2 + i % 4)
        value = F.date_add(F.lit("2024-01-01").cast("date"), number.cast("int"))
        value = value if kind == "date" else number.cast(kind)
        columns.append(F.when(F.col("id") % (7 + i) != 0, value).alias(name))
    some = spark.range(n).select(*columns)
    return some.unionAll(some)


@pytest.fixture
def odd(spark, folder):
    """Sources of odd rows, stored."""
    like = queries.dimension_sources(spark, SF_DIR)
    return {
        name: staging.stage(odd_rows(spark, source, 400), f"{folder}/{name}")
        for name, source in like.items()
    }


def test_counts_of_slices_add_up(spark, odd, folder):
    want = rows(dimensions.distinct_counts(dimensions.DIMENSIONS, odd))
    got = dimension_counts.count_in_slices(spark, odd, f"{folder}/all", 3)
    assert rows(got) == want and len(want) == len(dimensions.DIMENSIONS)
    few = ("dim_zp8_date", "dim_mis_label")
    joined = [dimensions.BY_NAME[n] for n in few]
    some = dimension_counts.count_in_slices(spark, odd, f"{folder}/joined", 1, joined)
    assert rows(some) == [x for x in want if x[0] in few]
    assert sorted(os.listdir(f"{folder}/joined")) == ["counts"]
    few += ("dim_main", "dim_dtc", "dim_hw_sw_number")
    built = {(n, dimensions.build(dimensions.BY_NAME[n], odd).count()) for n in few}
    assert built <= set(want)


def test_tuples_are_in_one_slice_and_slices_are_whole(odd):
    for name, columns in ((dimensions.ERROR_FACT, dimensions.BASE), (dimensions.COMPLAINTS, dimensions.PLACE)):
        parts = [staging.in_slice(odd[name], columns, k, 4).select(*columns) for k in range(4)]
        whole = odd[name].select(*columns)
        assert sum(p.count() for p in parts) == whole.count()
        assert sum(p.distinct().count() for p in parts) == whole.distinct().count()
        assert sum(p.count() > 0 for p in parts) > 1


def shuffle_files(spark):
    """Shuffle files on this session's disk with their bytes."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [manager.localDirs()[i].getPath() for i in range(len(manager.localDirs()))]
    found = {}
    for folder, _, names in (x for top in tops for x in os.walk(top)):
        for name in names:
            if name.startswith("shuffle_"):
                found[name] = os.path.getsize(f"{folder}/{name}")
    return found


def test_the_count_leaves_neither_shuffles_nor_tables(spark, folder, monkeypatch):
    """The joined rows' shuffles are many times the input, so they may not all lie on disk."""
    monkeypatch.setattr(staging, "staging_folder", lambda spark, fallback: f"{folder}/run")
    size = sum(files.size(spark, f"{SF_DIR}/{t}.parquet") for t in ("lineitem", "orders"))
    monkeypatch.setattr(standins, "SLICE_BYTES", size // 2)
    assert standins.slices(spark, SF_DIR) == 2
    before, setting = shuffle_files(spark), spark.conf.get(staging.FREE_SHUFFLES, None)
    counts = entry.queries()["dim_distinct_counts"](spark, SF_DIR)
    got = {r["dimension"]: r["tuples"] for r in counts.collect()}
    for _ in range(20):  # files go in the background
        left = sum(b for f, b in shuffle_files(spark).items() if f not in before)
        if left < size // 10:
            break
        time.sleep(0.5)
    assert left < size // 10
    assert spark.conf.get(staging.FREE_SHUFFLES, None) == setting
    assert os.listdir(f"{folder}/run") == ["counts"]
    sources = queries.dimension_sources(spark, SF_DIR)
    lazy = dimensions.distinct_counts(dimensions.DIMENSIONS, sources)
    assert got == {r["dimension"]: r["tuples"] for r in lazy.collect()}


def test_staged_lines_are_the_joined_ones(spark, folder, monkeypatch):
    """Slices hold every line of an order that is there once, also of equal lines."""
    data = f"{folder}/data"
    for name, kinds in standins.TABLES.items():
        if name in ("region", "nation", "customer", "part", "orders", "lineitem"):
            table = spark.read.schema(kinds).parquet(f"{SF_DIR}/{name}.parquet")
            if name in ("orders", "lineitem"):
                key = table.columns[0]
                table = table.where(F.col(key) % 5 != 1 if name == "orders" else F.lit(True))
                table = table.withColumn(key, F.when(F.col(key) % 11 != 0, F.col(key)))
                table = table.unionAll(table.limit(50))
            table.write.parquet(f"{data}/{name}.parquet")
    want = standins._items(spark, data).select(*standins.ITEM_COLUMNS)
    monkeypatch.setattr(standins, "SLICE_BYTES", 1)
    assert standins.slices(spark, data) == standins.MOST_SLICES
    placed, got = standins.staged(spark, data, f"{folder}/staged")
    assert rows(got) == rows(want)
    assert rows(placed) == rows(standins._placed_orders(spark, data).select(*standins.ORDER_COLUMNS))

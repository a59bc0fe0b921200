"""Counts of all filter dimensions, with a bounded part of the work on disk at a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.operators import dimensions
from fleetquill.operators.dimensions import Dimension
from fleetquill.plans import staging

SCHEMA = "dimension string, tuples bigint"


def count_in_slices(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    slices: int,
    chosen: Sequence[Dimension] = dimensions.DIMENSIONS,
) -> DataFrame:
    """Row count of every chosen dimension, counted slice by slice below ``root``.

    A slice holds all rows of its places, for the fact of its models and places. Every
    dimension has these columns, so none of its tuples is in two slices and the counts add
    up. The bridge is the whole one for each slice. A slice's shuffles are gone before the
    next one begins. Sources are read for every slice, so they should be stored.
    """
    sources, path = dict(sources), f"{root}/counts"
    fact = [d for d in chosen if d.source == dimensions.ERROR_FACT]
    joined = [d for d in chosen if d.source != dimensions.ERROR_FACT]
    with staging.shuffles_freed(spark):
        if joined and "model_bridge" not in sources:
            sources["model_bridge"] = staging.stage(
                dimensions.model_bridge(sources[dimensions.ERROR_FACT]), f"{root}/bridge"
            )
        for some, columns in ((fact, dimensions.BASE), (joined, dimensions.PLACE)):
            for number in range(slices if some else 0):
                cut = {
                    name: staging.in_slice(sources[name], columns, number, slices)
                    for name in {d.source for d in some}
                }
                if some is joined:
                    cut["model_bridge"] = sources["model_bridge"]
                counted = dimensions.distinct_counts(some, cut)
                counted.write.mode("append").parquet(path)
    staging.drop(spark, f"{root}/bridge")
    counts = spark.read.schema(SCHEMA).parquet(path)
    return counts.groupBy("dimension").agg(F.sum("tuples").alias("tuples"))

"""All filter dimensions in one batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.operators import dimensions
from fleetquill.operators.dimensions import Dimension
from fleetquill.plans import staging
from fleetquill.sinks import writers


def write_dimension(
    rows: DataFrame, dimension: Dimension, root: str, table_format: str = "parquet"
) -> str:
    """Replace one dimension's table, laid out as its definition says."""
    path = f"{root.rstrip('/')}/{dimension.table_name}"
    if dimension.by_brand:
        cluster = [dimension.cluster] if dimension.cluster else []
        writers.overwrite_clustered(rows, path, "brand", cluster, table_format)
    else:
        writers.overwrite_compact(rows, path, table_format)
    return path


def write_dimensions(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    chosen: Sequence[Dimension] = dimensions.DIMENSIONS,
    together: bool = True,
    table_format: str = "parquet",
) -> dict[str, str]:
    """Write the chosen dimensions below ``root``; returns their paths by name.

    A dimension whose columns another chosen one holds is cut from that one's table,
    which is far smaller than the source. The others are built from the source: with
    ``together`` it is read once for all of them, into a staging table partitioned by
    dimension, else once per dimension with that one's columns. The bridge is staged
    once for all joined dimensions, so the join knows its size.
    """
    folder = staging.staging_folder(spark, f"{root.rstrip('/')}/_staging")
    sources = dict(sources)
    if any(d.source != dimensions.ERROR_FACT for d in chosen):
        sources["model_bridge"] = staging.stage(
            dimensions.model_bridge(sources[dimensions.ERROR_FACT]), f"{folder}/bridge"
        )
    written: dict[str, str] = {}

    def write(dimension: Dimension, rows: DataFrame) -> None:
        written[dimension.name] = write_dimension(rows, dimension, root, table_format)

    roots = [d for d in chosen if dimensions.covering(d, chosen) is None]
    for source in dict.fromkeys(d.source for d in roots):
        mine = [d for d in roots if d.source == source]
        if together and len(mine) > 1:
            staged = staging.stage(
                dimensions.build_together(mine, sources),
                f"{folder}/{source}",
                partition="dimension",
            )
            for dimension in mine:
                labelled = staged.where(F.col("dimension") == dimension.name)
                write(dimension, labelled.select(*dimension.columns))
        else:
            for dimension in mine:
                write(dimension, dimensions.build(dimension, sources))
    # widest first, so that the table a dimension is cut from is there already
    covered = [d for d in chosen if d not in roots]
    for dimension in sorted(covered, key=lambda d: -len(d.attributes)):
        wider = dimensions.covering(dimension, chosen)
        table = spark.read.format(table_format).load(written[wider.name])
        write(dimension, table.select(*dimension.columns).distinct())
    staging.drop(spark, folder)
    return written

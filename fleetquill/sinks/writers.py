"""Table and file writers.

``overwriteSchema`` matters to table formats that check the schema on overwrite; a
Parquet folder takes the new schema anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetquill.sources import formats


def append_partitioned(
    df: DataFrame,
    path: str,
    partition: str,
    table_format: str = formats.DEFAULT,
    even: bool = False,
    cluster: Sequence[str] = (),
) -> int:
    """Append below ``partition=value`` folders; returns the rows written.

    Rebalancing evens out the write tasks and splits one that is far larger than the
    rest, which is the usual case: a batch holds a single load date. ``even`` says the
    rows are spread evenly already. With ``cluster`` every file holds a range of these
    columns and is sorted by them, so a reader that looks for a few values of the first
    can leave out files and row groups by their statistics; a value that many rows share
    is split by the columns after it. The rows are counted in the writing stage itself,
    whose tasks count once even when rerun.
    """
    counted = Observation()
    if cluster:
        rows = df.repartitionByRange(*cluster).sortWithinPartitions(partition, *cluster)
    else:
        rows = df if even else df.hint("rebalance")
    observed = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    formats.writer(observed, table_format).mode("append").partitionBy(partition).save(path)
    return counted.get.get("rows", 0)


def overwrite_compact(
    df: DataFrame, path: str, table_format: str = formats.DEFAULT
) -> None:
    """Replace a table, schema included, in as few well-sized files as its size allows.

    A small dimension ends up in one file; a large one is not squeezed into one task.
    """
    formats.writer(df.hint("rebalance"), table_format).mode("overwrite").option(
        "overwriteSchema", True
    ).save(path)


def overwrite_clustered(
    df: DataFrame,
    path: str,
    partition: str,
    cluster: Sequence[str] = (),
    table_format: str = formats.DEFAULT,
) -> None:
    """Replace a table laid out by ``partition``, rows of one cluster value together.

    Rows are hashed by (partition, *cluster); AQE merges small and splits large shares,
    so a partition value holding most rows is still written by many tasks.
    """
    rows = df.hint("rebalance", partition, *cluster)
    formats.writer(rows, table_format).partitionBy(partition).mode("overwrite").option(
        "overwriteSchema", True
    ).save(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_parquet_files(df: DataFrame, path: str, files: int) -> None:
    """Replace with a given number of files of about equal row counts."""
    df.repartition(files).write.mode("overwrite").parquet(path)


def overwrite_parquet_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    df.write.partitionBy(*columns).mode("overwrite").parquet(path)

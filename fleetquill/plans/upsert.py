"""Insert-only merge into a stored table, with its commit row in the load log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquill.operators import merge
from fleetquill.plans import staging
from fleetquill.sinks import writers
from fleetquill.sources import formats, load_log, readers

#: Stretches of values that a target is narrowed to, so many at most.
STRETCHES = 32


@dataclass(frozen=True)
class Table:
    """A stored table: where it is, in what format, what it holds and what identifies a row.

    ``prune_by`` names a key column of which a batch touches few values only; the table's
    files are laid out by it. Its load log has the same format.
    """

    name: str
    path: str
    schema: T.StructType
    keys: Sequence[str]
    partition: str
    load_log: str
    prune_by: str | None = None
    table_format: str = formats.DEFAULT

    def exists(self, spark: SparkSession) -> bool:
        return load_log.table_exists(spark, self.path, self.table_format)

    def read(self, spark: SparkSession) -> DataFrame:
        """What the table holds; a missing one is empty."""
        if self.exists(spark):
            return readers.read_table_path(spark, self.path, self.schema, self.table_format)
        return spark.createDataFrame([], self.schema)

    def log(self, spark: SparkSession) -> DataFrame:
        return load_log.read_load_log(spark, self.load_log, self.table_format)

    def append(self, rows: DataFrame, even: bool = False) -> int:
        """Add rows, each file a range of ``prune_by``, or evenly; returns the rows written."""
        cluster: list[str] = []
        if self.prune_by is not None:
            cluster = [self.prune_by, *[k for k in self.keys if k != self.prune_by]]
        return writers.append_partitioned(
            rows.select(*self.schema.fieldNames()),
            self.path,
            self.partition,
            self.table_format,
            even=even,
            cluster=cluster,
        )


def read_or_empty(spark: SparkSession, table: Table) -> DataFrame:
    return table.read(spark)


def stretches(values: DataFrame, column: str) -> list[tuple]:
    """Smallest and largest value of at most ``STRETCHES`` ranges that hold all the values;
    so few rows come to the driver, however many values there are."""
    ranges = values.repartitionByRange(STRETCHES, column).groupBy(F.spark_partition_id().alias("part"))
    found = ranges.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return [(r["low"], r["high"]) for r in found.collect()]


def matching_part(target: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The target rows whose ``column`` value is among the given distinct values.

    The values are a staged table, so Spark knows their size and chooses the join. Their
    ranges are a filter that reaches the scan, where the statistics of files and row
    groups that are laid out by the column leave out what lies in none.
    """
    near: list[Column] = [F.col(column).between(low, high) for low, high in stretches(values, column)]
    if not near:
        return target.where(F.lit(False))
    return target.where(reduce(lambda a, b: a | b, near)).join(values, column, "left_semi")


def upsert_insert_only(
    spark: SparkSession,
    updates: DataFrame,
    table: Table,
    *,
    load_id: str,
    once: bool = False,
    committed_at: dt.datetime | None = None,
    **how,
) -> int:
    """Append the rows the table lacks and log the load; returns the rows written.

    A missing table counts as empty, which makes the first load a plain append. The
    log row follows the data, so a load without one did not finish and can be run
    again: only rows with a null key would be inserted twice. With ``once``, a load id
    that is already logged writes nothing at all.

    A table with ``prune_by`` has its batch staged first, so that it is computed once
    for looking at its values and for the merge; what was staged goes after the log row.
    """
    if once and load_log.is_committed(table.log(spark), table.name, load_id):
        return 0
    target = table.read(spark)
    staged: list[str] = []
    if table.prune_by is not None:
        fallback = f"{table.load_log.rstrip('/')}_staging"
        staged += [staging.staging_folder(spark, fallback) for _ in range(2)]
        updates = staging.stage(updates, staged[0])
        values = updates.select(table.prune_by).where(F.col(table.prune_by).isNotNull())
        values = staging.stage(values.distinct(), staged[1])
        target = matching_part(target, values, table.prune_by)
    new = merge.new_rows(updates, target, table.keys, **how)
    written = table.append(new, even=not how.get("unique", False))
    load_log.append_load(
        spark,
        table.load_log,
        table.name,
        load_id,
        "merge",
        written,
        committed_at or dt.datetime.now(dt.timezone.utc),
        table.table_format,
    )
    for folder in staged:
        staging.drop(spark, folder)
    return written

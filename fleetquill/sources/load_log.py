"""The load log: one row per committed load. It takes the place of a table history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates
from fleetquill.sources import files, formats, readers


def table_exists(
    spark: SparkSession, path: str, table_format: str = formats.DEFAULT
) -> bool:
    """Whether a path is a table of the format: it has a data file of it. File names are
    asked for one by one up to the first; a folder of other files is no table."""
    found = files.files_below(spark, path)
    return any(formats.is_data_file(file, table_format) for file in found)


def read_load_log(
    spark: SparkSession, path: str, table_format: str = formats.DEFAULT
) -> DataFrame:
    if table_exists(spark, path, table_format):
        return readers.read_table_path(spark, path, schemas.LOAD_LOG, table_format)
    return spark.createDataFrame([], schemas.LOAD_LOG)


def is_initial_load(
    spark: SparkSession,
    log_path: str,
    tables: Mapping[str, str],
    table_format: str = formats.DEFAULT,
) -> bool:
    """True until every table (name -> path) exists and has a logged load.

    Data without a log row comes from a first load that did not finish.
    """
    if not all(table_exists(spark, path, table_format) for path in tables.values()):
        return True
    logged = read_load_log(spark, log_path, table_format).where(
        F.col("table_name").isin(list(tables))
    )
    return logged.agg(F.count_distinct("table_name")).first()[0] < len(tables)


def append_load(
    spark: SparkSession,
    path: str,
    table_name: str,
    load_id: str,
    operation: str,
    rows_written: int,
    committed_at: dt.datetime,
    table_format: str = formats.DEFAULT,
) -> None:
    """Commit marker of a load, written after its data."""
    row = (table_name, load_id, operation, rows_written, committed_at)
    rows = spark.createDataFrame([row], schemas.LOAD_LOG).coalesce(1)
    formats.writer(rows, table_format).mode("append").save(path)


def is_committed(log: DataFrame, table_name: str, load_id: str) -> bool:
    hit = (F.col("table_name") == table_name) & (F.col("load_id") == load_id)
    return not log.where(hit).isEmpty()


def last_number(log: DataFrame, table_name: str, stream: str) -> int:
    """The last batch of a stream that a table's log has, -1 without one. Its loads are
    logged as ``<stream>#<number of their last batch>``."""
    mine = (F.col("table_name") == table_name) & F.col("load_id").startswith(f"{stream}#")
    number = F.substring_index("load_id", "#", -1).try_cast("bigint")
    found = log.where(mine).agg(F.max(number)).first()[0]
    return -1 if found is None else found


def latest_load(log: DataFrame) -> DataFrame:
    """Latest commit date per table."""
    return log.groupBy("table_name").agg(
        F.to_date(F.max("committed_at")).alias("latest_load")
    )


def shared_watermark(log: DataFrame) -> DataFrame:
    """The oldest of the tables' latest commit dates, as one row."""
    return latest_load(log).agg(F.min("latest_load").alias("watermark"))


def effective_watermark(
    history: Column, explicit: str | dt.date | None = None, initial: Column | None = None
) -> Column:
    """Initial load, then a date given by the caller, then the history."""
    start = dates.as_date(dates.BEGINNING_OF_TIME)
    chosen = history if explicit is None else dates.as_date(explicit)
    return F.when(history.isNull() if initial is None else initial, start).otherwise(
        chosen
    )

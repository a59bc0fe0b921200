"""Landing to storage for vehicle baselines."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates
from fleetquill.operators import baseline, merge
from fleetquill.plans import core_load, upsert
from fleetquill.sources import formats, load_log, readers

NAME = "baseline"


@dataclass(frozen=True)
class BaselinePaths:
    landing: str
    table: str
    load_log: str
    table_format: str = formats.DEFAULT


def stored_table(paths: BaselinePaths) -> upsert.Table:
    return upsert.Table(
        NAME,
        paths.table,
        schemas.BASELINE_STORED,
        schemas.BASELINE_KEYS,
        "validfrom",
        paths.load_log,
        prune_by="productId",
        table_format=paths.table_format,
    )


def snapshot_of_file() -> Column:
    """Date of the folder a scanned file lies in."""
    return dates.try_iso_date(F.element_at(F.split("_metadata.file_path", "/"), -2))


def merge_documents(
    documents: DataFrame,
    stored: DataFrame,
    load_date: str | dt.date,
    retention: dates.Retention,
) -> DataFrame:
    """The table after later snapshots: known combinations keep their validity."""
    updates = baseline.first_seen(documents, load_date, retention)
    return merge.merged(updates, stored, schemas.BASELINE_KEYS, unique=True)


def is_initial_load(spark: SparkSession, paths: BaselinePaths) -> bool:
    return load_log.is_initial_load(
        spark, paths.load_log, {NAME: paths.table}, paths.table_format
    )


def find_watermark(
    spark: SparkSession, paths: BaselinePaths, explicit: str | dt.date | None = None
) -> dt.date:
    """Initial load first, then the given date, then the latest logged load."""
    start = dt.date.fromisoformat(dates.BEGINNING_OF_TIME)
    if is_initial_load(spark, paths):
        return start
    if explicit is not None:
        return dt.date.fromisoformat(str(explicit))
    log = load_log.read_load_log(spark, paths.load_log, paths.table_format)
    mine = load_log.latest_load(log.where(F.col("table_name") == NAME)).first()
    return mine["latest_load"] if mine else start


def load_baselines(
    spark: SparkSession,
    paths: BaselinePaths,
    load_date: str | dt.date,
    retention: dates.Retention = dates.Retention(),
    watermark: str | dt.date | None = None,
    multi_line: bool = False,
) -> int:
    """Load the snapshots after the watermark; returns the rows written.

    All snapshots are read in one scan. On the first load the oldest of them is valid
    from the beginning of time, every other from its own date.
    """
    initial = is_initial_load(spark, paths)
    since = find_watermark(spark, paths, watermark)
    folders = core_load.new_folders(spark, paths.landing, since)
    if not folders:
        return 0
    root = paths.landing.rstrip("/")
    documents = readers.read_baselines(
        spark, [f"{root}/{folder}" for folder in folders], multi_line
    ).withColumn("snapshot_date", snapshot_of_file())
    rows = baseline.first_seen(
        documents,
        load_date,
        retention,
        opening=dates.try_iso_date(F.lit(folders[0])) if initial else None,
    )
    return upsert.upsert_insert_only(
        spark,
        rows,
        stored_table(paths),
        load_id=f"baseline-{folders[0]}-{folders[-1]}",
        unique=True,
    )

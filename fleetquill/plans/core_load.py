"""Landing to storage for core master data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates
from fleetquill.operators import classify, core, merge
from fleetquill.plans import staging, upsert
from fleetquill.sources import files, formats, listing, load_log, readers

# Files are merged in the order of their paths, date folders first.
FILE_ORDER = "path"


@dataclass(frozen=True)
class CorePaths:
    """Where core files land and where the tables and their load log live."""

    landing: str
    modprod: str
    modkpb: str
    load_log: str
    table_format: str = formats.DEFAULT

    def table(self, table_class: str) -> str:
        return {"modprod": self.modprod, "modkpb": self.modkpb}[table_class]


def stored_table(paths: CorePaths, table_class: str) -> upsert.Table:
    return upsert.Table(
        table_class,
        paths.table(table_class),
        schemas.STORED_SCHEMAS[table_class],
        core.merge_keys(table_class),
        core.LOAD_DATE,
        paths.load_log,
        table_format=paths.table_format,
    )


def rows_from_lines(lines: DataFrame) -> DataFrame:
    """Fields of all known files, with class and path, from their lines.

    Input: path, position, line of every file, headers included.
    """
    data = classify.data_lines(lines, classify.classify_files(lines))
    return readers.parse_csv_column(
        data, "line", core.POSITIONS, ("table_class", FILE_ORDER)
    )


def coded_fields(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every line taken apart, with the code of the header it may be."""
    coded = lines.select(
        FILE_ORDER, "position", "line", classify.header_code(F.col("line")).alias("code"), *keep
    )
    return readers.parse_csv_column(
        coded, "line", core.POSITIONS, (FILE_ORDER, "position", "code", *keep)
    )


def rows_of_class(fields: DataFrame, table_class: str) -> DataFrame:
    """Rows of one class, named as they are stored, with their file's path."""
    _, names = schemas.CORE_CLASSES[table_class]
    return fields.where(F.col("table_class") == table_class).select(
        *[F.col(c).alias(n) for c, n in zip(core.POSITIONS, names)], FILE_ORDER
    )


def find_watermark(
    spark: SparkSession, paths: CorePaths, explicit: str | dt.date | None = None
) -> dt.date:
    """Initial load first, then the given date, then the older of the two tables."""
    tables = {name: paths.table(name) for name in schemas.CORE_CLASSES}
    if load_log.is_initial_load(spark, paths.load_log, tables, paths.table_format):
        return dt.date.fromisoformat(dates.BEGINNING_OF_TIME)
    if explicit is not None:
        return dt.date.fromisoformat(str(explicit))
    log = load_log.read_load_log(spark, paths.load_log, paths.table_format)
    mine = log.where(F.col("table_name").isin(*schemas.CORE_CLASSES))
    found = load_log.shared_watermark(mine).first()["watermark"]
    return found or dt.date.fromisoformat(dates.BEGINNING_OF_TIME)


def new_folders(spark: SparkSession, landing: str, watermark: dt.date) -> list[str]:
    """Date folders after the watermark that hold files, oldest first.

    The landing's history is not listed: one level of folder names comes from the file
    system, a name a day, and only the new ones are looked into, up to their first file.
    """
    if listing.is_pattern(landing):
        raise ValueError(f"a landing is one folder, and {landing} is a pattern")
    if not files.holds_files(spark, landing):
        raise FileNotFoundError(f"no core files found below {landing}")
    dated = [(dates.parse_folder(name), name) for name in files.folders(spark, landing)]
    newer = sorted((day, name) for day, name in dated if day is not None and day > watermark)
    root = landing.rstrip("/")
    return [name for _, name in newer if files.holds_files(spark, f"{root}/{name}")]


def merge_lines(
    spark: SparkSession,
    lines: DataFrame,
    paths: CorePaths,
    load_date: str | dt.date,
    retention: dates.Retention,
    load_id: str,
    once: bool = False,
    only: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Merge the lines of any mix of files into both tables; rows written per table.

    The files are read once: every line is taken apart and staged with a code that says
    whose header it could be. The classes come from two columns of that, a number per
    line that hardly ever changes, and never from the files again. ``only`` leaves a
    table the lines its condition holds for. What was staged goes after the last log row.
    """
    fallback = f"{paths.load_log.rstrip('/')}_staging"
    folders = [staging.staging_folder(spark, fallback) for _ in range(2)]
    keep = [c for c in lines.columns if c not in (FILE_ORDER, "position", "line")]
    fields = staging.stage(coded_fields(lines, keep), folders[0])
    classes = staging.stage(classify.classes_of(fields), folders[1])
    written = {}
    for name in schemas.CORE_CLASSES:
        mine = fields if only is None else fields.where(only[name])
        known = classes.where(F.col("table_class") == name)
        written[name] = upsert.upsert_insert_only(
            spark,
            rows_of_class(classify.data_lines(mine.drop("code"), known), name),
            stored_table(paths, name),
            load_id=load_id,
            once=once,
            file_order=FILE_ORDER,
            constants=core.load_dates(load_date, retention),
        )
    for folder in folders:
        staging.drop(spark, folder)
    return written


def load_core(
    spark: SparkSession,
    paths: CorePaths,
    load_date: str | dt.date,
    retention: dates.Retention = dates.Retention(),
    watermark: str | dt.date | None = None,
) -> dict[str, int]:
    """Load every file of the folders after the watermark; rows written per table.

    The files of all folders are classified in one job and merged with one job per
    table, whatever their number.
    """
    since = find_watermark(spark, paths, watermark)
    folders = new_folders(spark, paths.landing, since)
    if not folders:
        return dict.fromkeys(schemas.CORE_CLASSES, 0)
    root = paths.landing.rstrip("/")
    lines = readers.read_core_lines(spark, [f"{root}/{folder}" for folder in folders])
    load_id = f"core-{load_date}-{folders[0]}-{folders[-1]}"
    return merge_lines(spark, lines, paths, load_date, retention, load_id)

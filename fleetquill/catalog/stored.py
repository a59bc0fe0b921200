"""Queries that go through files: stand-ins are delivered as files, loaded or written with
the library's own loads, streams and writers, and read back with its readers.

Everything is written below a new folder of the one the cluster names for checkpoints. The
result reads what was written last, so that stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.catalog import standins
from fleetquill.functions import dates
from fleetquill.operators import dimensions
from fleetquill.plans import (
    baseline_load,
    core_load,
    dimension_batch,
    response_landing,
    staging,
)
from fleetquill.sinks import writers
from fleetquill.sources import readers
from fleetquill.streaming import landing_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RETENTION = dates.Retention(years=15)
#: Used where no folder for checkpoints is named, as in tests; refused on a cluster.
LOCAL_FALLBACK = "/tmp/checkpoints"
#: Days of the delivered folders: two before the first load, one after it.
EARLY_DAYS = ("2024-01-02", "2024-01-04")
LATE_DAY = "2024-01-06"
FORMATS = ("parquet", "csv", "json")
#: One dimension of every kind: whole, covered by it, clustered, joined, from vehicles.
WRITTEN_DIMENSIONS = ("dim_dfcc", "dim_ecu_name", "dim_dtc", "dim_fault_type", "dim_zp8_date")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _folder(spark: SparkSession) -> str:
    return staging.staging_folder(spark, LOCAL_FALLBACK)


def _union(parts: Iterator[DataFrame] | list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


# --- loads ------------------------------------------------------------------------------


def _deliver(parts: DataFrame, header: list[str], path: str) -> None:
    """Rows as `;` files with a header, beside what the folder holds already."""
    named = parts.toDF(*header)
    named.write.mode("append").option("header", True).option("delimiter", ";").csv(path)


def deliver_core(spark: SparkSession, sf_dir: str, landing: str, day: str) -> None:
    """Files of one day. First day: two thirds of the parts, every thirteenth twice, and odd
    ones as project codes; second: even parts; last: all, and files with a strange header."""
    key = F.col("p_partkey")
    all_parts = standins.table(spark, sf_dir, "part").withColumn(
        "model", F.concat_ws(" ", "p_name", key.cast("string"))
    )
    path = f"{landing}/{day}"

    def fields(parts: DataFrame, table_class: str) -> DataFrame:
        year = F.when(key % 11 != 0, (1990 + F.col("p_size")).cast("string"))
        code = F.when(key % 11 != 0, F.concat(F.lit("K"), F.col("p_size").cast("string")))
        if table_class == "modprod":
            return parts.select("model", year, "p_brand", "p_type")
        return parts.select("model", "p_brand", "p_type", code)

    if day == EARLY_DAYS[0]:
        twice = F.when(key % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        some = all_parts.where(key % 3 != 0).withColumn("copy", F.explode(twice))
        _deliver(fields(some, "modprod"), schemas.MODPROD_HEADER, path)
        _deliver(fields(all_parts.where(key % 2 == 1), "modkpb"), schemas.MODKPB_HEADER, path)
    elif day == EARLY_DAYS[1]:
        _deliver(fields(all_parts.where(key % 2 == 0), "modprod"), schemas.MODPROD_HEADER, path)
    else:
        _deliver(fields(all_parts, "modprod"), schemas.MODPROD_HEADER, path)
        _deliver(fields(all_parts, "modkpb"), schemas.MODKPB_HEADER, path)
        _deliver(fields(all_parts, "modprod"), schemas.MODPROD_HEADER[::-1], path)


def _core_paths(root: str, table_format: str) -> core_load.CorePaths:
    return core_load.CorePaths(
        f"{root}/landing", f"{root}/modprod", f"{root}/modkpb", f"{root}/log", table_format
    )


def _core_tables(spark: SparkSession, paths: core_load.CorePaths) -> DataFrame:
    return _union(
        [
            core_load.stored_table(paths, name).read(spark).withColumn("table_class", F.lit(name))
            for name in schemas.CORE_CLASSES
        ]
    )


@query
def core_load_files(spark, sf_dir):
    """Two loads under one date into Parquet tables: the first takes every folder, whatever
    the watermark, the second the one after it, and writes what the tables lack."""
    paths = _core_paths(_folder(spark), "parquet")
    for days, watermark in ((EARLY_DAYS, "2024-01-03"), ((LATE_DAY,), "2024-01-05")):
        for day in days:
            deliver_core(spark, sf_dir, paths.landing, day)
        core_load.load_core(spark, paths, standins.LOAD_DATE, RETENTION, watermark)
    return _core_tables(spark, paths)


@query
def core_stream_files(spark, sf_dir):
    """The same deliveries taken by a stream that is run twice, into csv tables."""
    root = _folder(spark)
    paths = _core_paths(root, "csv")
    for days in (EARLY_DAYS, (LATE_DAY,)):
        for day in days:
            deliver_core(spark, sf_dir, paths.landing, day)
        landing_stream.stream_core(
            spark, f"{paths.landing}/*", paths, f"{root}/stream", standins.LOAD_DATE, RETENTION
        )
    return _core_tables(spark, paths)


def _deliver_baselines(spark: SparkSession, sf_dir: str, landing: str, days: list[str]) -> None:
    documents = standins.baseline_texts(spark, sf_dir)
    for day in days:
        of_day = documents.where(F.col("snapshot_date") == F.lit(day).cast("date"))
        of_day.select("document").write.text(f"{landing}/{day}")


@query
def baseline_load_files(spark, sf_dir):
    """JSON snapshots loaded twice: two of them, then the later ones."""
    root = _folder(spark)
    paths = baseline_load.BaselinePaths(f"{root}/landing", f"{root}/table", f"{root}/log")
    first = ["2024-01-01", "2024-01-02"], standins.EARLIER_LOAD_DATE, None
    later = ["2024-01-03", "2024-01-04"], standins.LOAD_DATE, "2024-01-02"
    for days, load_date, watermark in (first, later):
        _deliver_baselines(spark, sf_dir, paths.landing, days)
        baseline_load.load_baselines(spark, paths, load_date, RETENTION, watermark)
    return baseline_load.stored_table(paths).read(spark)


@query
def landed_responses(spark, sf_dir):
    """Good responses landed under their keys, read back from the day's folder."""
    landing = f"{_folder(spark)}/baselines"
    raw = standins.responses(spark, sf_dir)
    response_landing.land_responses(raw, landing, standins.LOAD_DATE, strict=False)
    landed = readers.read_landed_responses(spark, f"{landing}/{standins.LOAD_DATE}")
    return landed.select(
        "object_key", "product_id", "uuid", F.get_json_object("body", "$.url").alias("url")
    )


# --- files --------------------------------------------------------------------------------


@query
def core_csv_files(spark, sf_dir):
    """Delivered `;` files with a header, read as they are."""
    path = f"{_folder(spark)}/modprod"
    rows = standins.modprod_lines(spark, sf_dir).select(
        *[F.nullif(F.split("line", ";")[i], F.lit("")) for i in range(4)]
    )
    _deliver(rows, schemas.MODPROD_HEADER, path)
    return readers.read_core_csv(spark, path)


@query
def positional_csv_files(spark, sf_dir):
    """Headerless `;` files, their columns named by place."""
    path = f"{_folder(spark)}/interface"
    standins.interface_lines(spark, sf_dir).write.text(path)
    return readers.read_csv_positional(spark, path, schemas.INTERFACE_COLUMNS)


@query
def files_by_format(spark, sf_dir):
    """Order lines as comma files, their types inferred, and as Parquet, read by format name."""
    folder = _folder(spark)
    rows = standins.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.to_date("l_shipdate").alias("l_shipdate"),
    )
    rows.write.option("header", True).csv(f"{folder}/csv")
    writers.overwrite_parquet(rows, f"{folder}/parquet")
    return _union(
        [
            readers.read_files(spark, f"{folder}/{name}", name).withColumn("file_format", F.lit(name))
            for name in ("csv", "parquet")
        ]
    ).withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


@query
def catalog_table(spark, sf_dir):
    """Orders as an external table, read by its name."""
    path, name = f"{_folder(spark)}/orders", f"orders_{uuid.uuid4().hex}"
    rows = standins.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    writers.overwrite_parquet(rows, path)
    spark.catalog.createTable(name, path=path, source="parquet", schema=rows.schema)
    return readers.read_catalog_table(spark, name)


# --- writers ------------------------------------------------------------------------------


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a date a year, some nulls and some empty texts."""
    status: Column = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return standins.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).otherwise(status).alias("note"),
        F.concat(F.lit(' a;"b",\n '), "o_orderpriority").alias("words"),
        F.trunc(F.to_date("o_orderdate"), "year").alias("Load_Date"),
    )


@query
def appended_tables(spark, sf_dir):
    """Two batches appended by load date in every format, read with their declared schema."""
    folder, rows = _folder(spark), _dated_orders(spark, sf_dir)
    for name in FORMATS:
        for rest in (0, 1):
            batch = rows.where(F.col("o_orderkey") % 2 == rest)
            writers.append_partitioned(
                batch, f"{folder}/{name}", "Load_Date", name, cluster=["o_orderkey"] if rest else []
            )
    return _union(
        [
            readers.read_table_path(spark, f"{folder}/{name}", rows.schema, name).withColumn(
                "table_format", F.lit(name)
            )
            for name in FORMATS
        ]
    )


@query
def overwritten_tables(spark, sf_dir):
    """Customers over tables of another schema, by each writer that replaces a table; the
    number of files is told where it is given."""
    folder = _folder(spark)
    rows = standins.table(spark, sf_dir, "customer")
    before = standins.table(spark, sf_dir, "supplier").withColumn("c_mktsegment", F.lit("none"))

    def clustered(df: DataFrame, path: str) -> None:
        writers.overwrite_clustered(df, path, "c_mktsegment", df.columns[:1])

    how: dict[str, Callable[[DataFrame, str], None]] = {
        "compact": writers.overwrite_compact,
        "clustered": clustered,
        "parquet": writers.overwrite_parquet,
        "files": lambda df, path: writers.overwrite_parquet_files(df, path, 3),
        "partitioned": lambda df, path: writers.overwrite_parquet_partitioned(df, path, "c_mktsegment"),
    }
    parts = []
    for name, write in how.items():
        path = f"{folder}/{name}"
        write(before, path)
        write(rows, path)
        found = readers.read_table_path(spark, path).withColumn("writer", F.lit(name))
        file = F.col("_metadata.file_path") if name == "files" else F.lit(None).cast("string")
        parts.append(found.withColumn("file", file).select("writer", *rows.columns, "file"))
    written = _union(parts)
    files = written.groupBy("writer").agg(F.count_distinct("file").alias("files"))
    return written.drop("file").join(files, "writer")


def write_and_read(spark: SparkSession, sf_dir: str, together: bool = True) -> DataFrame:
    """The chosen dimensions written and read from their tables."""
    chosen = [dimensions.BY_NAME[name] for name in WRITTEN_DIMENSIONS]
    sources = {
        dimensions.ERROR_FACT: standins.error_fact(spark, sf_dir),
        dimensions.COMPLAINTS: standins.complaint_daily(spark, sf_dir),
        dimensions.VEHICLES: standins.vehicle_extended(spark, sf_dir),
    }
    paths = dimension_batch.write_dimensions(spark, sources, _folder(spark), chosen, together)
    return _union(
        [
            readers.read_table_path(spark, path).withColumn("dimension", F.lit(name))
            for name, path in paths.items()
        ]
    )


@query
def written_dimensions(spark, sf_dir):
    """Dimensions of every kind written together."""
    return write_and_read(spark, sf_dir)

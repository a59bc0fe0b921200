"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.catalog import standins, stored
from fleetquill.functions import dates, nested, text
from fleetquill.operators import (
    baseline,
    classify,
    core,
    dimensions,
    maintenance,
    merge,
    moves,
    responses,
)
from fleetquill.plans import baseline_load, core_load, dimension_counts, staging
from fleetquill.sources import listing, load_log, readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RETENTION = dates.Retention(years=15)
MOVES = moves.MoveSettings()
OVERVIEW_TEMPLATE = "https://example.invalid/products/{vpId}/baselines/{api_version}"
BASELINE_TEMPLATE = "https://example.invalid/baselines/{baseline_uuid}/{api_version}"
API_VERSION = "v13"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- core master data ------------------------------------------------------------------


def _core_rows(spark, sf_dir, table_class: str, keep=()) -> DataFrame:
    lines = {"modprod": standins.modprod_lines, "modkpb": standins.modkpb_lines}
    header, _ = schemas.CORE_CLASSES[table_class]
    return readers.parse_csv_column(
        lines[table_class](spark, sf_dir), "line", header, keep
    )


def _batch_rows(spark, sf_dir, table_class: str) -> DataFrame:
    """Batch rows under stored names, with the file they come from."""
    rows = _core_rows(spark, sf_dir, table_class, ("file_no",))
    return core.stored_names(rows, table_class, "file_no")


@query
def scan_core_csv(spark, sf_dir):
    return _core_rows(spark, sf_dir, "modprod")


@query
def positional_csv(spark, sf_dir):
    return readers.parse_csv_column(
        standins.interface_lines(spark, sf_dir), "line", schemas.INTERFACE_COLUMNS
    )


@query
def distinct_product_ids(spark, sf_dir):
    return core.product_ids(positional_csv(spark, sf_dir))


@query
def classify_files(spark, sf_dir):
    found = classify.classify_files(standins.core_files(spark, sf_dir))
    return found.select("path", "table_class")


@query
def with_retention(spark, sf_dir):
    """Load date taken from the data here, so that every calendar case occurs."""
    period = dates.Retention(years=15, months=1, days=3)
    day = F.to_date("o_orderdate")
    return standins.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("Load_Date"),
        period.deletion_date(day).alias("KSU_LOESCH_DATUM"),
    )


@query
def project_modprod(spark, sf_dir):
    rows = core.with_load_dates(
        _core_rows(spark, sf_dir, "modprod"), standins.LOAD_DATE, RETENTION
    )
    return core.to_stored(rows, "modprod")


@query
def project_modkpb(spark, sf_dir):
    rows = core.with_load_dates(
        _core_rows(spark, sf_dir, "modkpb"), standins.LOAD_DATE, RETENTION
    )
    return core.to_stored(rows, "modkpb")


def _merge_core(spark, sf_dir, table_class: str) -> DataFrame:
    return merge.merged(
        _batch_rows(spark, sf_dir, table_class),
        standins.stored_core(spark, sf_dir, table_class),
        core.merge_keys(table_class),
        constants=core.load_dates(standins.LOAD_DATE, RETENTION),
        file_order="file_no",
    )


@query
def merge_modprod(spark, sf_dir):
    return _merge_core(spark, sf_dir, "modprod")


@query
def merge_modkpb(spark, sf_dir):
    return _merge_core(spark, sf_dir, "modkpb")


@query
def incremental_core_load(spark, sf_dir):
    """Files in folders after the watermark, classified, merged in file order and dated."""
    lines = listing.newer_than(
        standins.core_files(spark, sf_dir), dates.as_date("2024-01-05")
    )
    counted = merge.count_copies(
        core_load.rows_from_lines(lines), core.POSITIONS, core_load.FILE_ORDER
    )
    rows = core.name_by_class(merge.repeat_copies(counted))
    return core.with_load_dates(rows, standins.LOAD_DATE, RETENTION)


@query
def sales_class_entries(spark, sf_dir):
    return core.sales_class_rows(standins.sales_classes(spark, sf_dir)).select(
        "Produkt", "entry", "series", "start_year", "end_year"
    )


@query
def model_year_expansion(spark, sf_dir):
    rows = core.sales_class_rows(standins.sales_classes(spark, sf_dir))
    return core.expand_model_years(rows).select(
        "Produkt", "series", "start_year", "end_year", "modelljahr"
    )


@query
def normalize_sales_class(spark, sf_dir):
    return core.normalize_sales_classes(standins.sales_classes(spark, sf_dir))


# --- baselines ------------------------------------------------------------------------


def _documents(spark, sf_dir) -> DataFrame:
    return readers.parse_json_column(
        standins.baseline_texts(spark, sf_dir),
        "document",
        schemas.BASELINE_DOCUMENT,
        ("snapshot_date",),
    )


@query
def baseline_json_scan(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        F.col("content.productId").alias("productId"),
        F.col("content.status").alias("status"),
        F.size("content.materials").alias("materials"),
        "snapshot_date",
    )


@query
def published_baselines(spark, sf_dir):
    return baseline.published(_documents(spark, sf_dir), ["snapshot_date"]).select(
        "snapshot_date", "productId", F.size("materials").alias("materials")
    )


@query
def explode_materials(spark, sf_dir):
    items = baseline.explode_materials(
        baseline.published(_documents(spark, sf_dir), ["snapshot_date"])
    )
    return items.select(
        "snapshot_date",
        "productId",
        F.col("materials_items.partNumber").alias("partNumber"),
        F.col("materials_items.naming").alias("naming"),
        F.col("materials_items.materialType").alias("materialType"),
        F.size("materials_items.diagnosisAddresses").alias("addresses"),
    )


def _flat(spark, sf_dir) -> DataFrame:
    flat = baseline.flatten(_documents(spark, sf_dir), ["snapshot_date"])
    return baseline.with_validity(
        flat,
        F.date_format("snapshot_date", "yyyy-MM-dd"),
        standins.LOAD_DATE,
        RETENTION,
    )


@query
def flatten_baseline(spark, sf_dir):
    return _flat(spark, sf_dir)


@query
def baseline_complete_rows(spark, sf_dir):
    return baseline.complete_rows(_flat(spark, sf_dir)).distinct()


@query
def baseline_rejected_rows(spark, sf_dir):
    return baseline.rejected_rows(_flat(spark, sf_dir)).distinct()


@query
def optional_path(spark, sf_dir):
    items = baseline.explode_materials(
        baseline.published(_documents(spark, sf_dir), ["snapshot_date"])
    )
    found = nested.optional_path(items, "naming", "materials_items.naming")
    absent = nested.optional_path(found, "colour", "materials_items.paint.colour")
    return absent.select("snapshot_date", "productId", "naming", "colour")


@query
def baseline_first_seen(spark, sf_dir):
    """First load: the oldest snapshot is valid from the beginning of time."""
    return baseline.first_seen(
        _documents(spark, sf_dir),
        standins.LOAD_DATE,
        RETENTION,
        opening=baseline.first_snapshot(standins.baseline_texts(spark, sf_dir)),
    )


@query
def merge_baseline_first_seen(spark, sf_dir):
    """Two loads: the first two snapshots, then the later ones merged into them."""
    documents = _documents(spark, sf_dir)
    watermark = dates.as_date("2024-01-02")
    is_later = dates.is_newer(F.col("snapshot_date"), watermark)
    stored = baseline.first_seen(
        documents.where(~is_later), standins.EARLIER_LOAD_DATE, RETENTION
    )
    return baseline_load.merge_documents(
        documents.where(is_later), stored, standins.LOAD_DATE, RETENTION
    )


@query
def baseline_validity(spark, sf_dir):
    newer = F.when(F.col("turn") != 7, F.col("turn") - 1)
    return standins.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        baseline.validity(newer).alias("valid"),
    )


# --- filter dimensions ------------------------------------------------------------------

_SOURCES = {
    dimensions.ERROR_FACT: standins.error_fact,
    dimensions.COMPLAINTS: standins.complaint_daily,
    dimensions.VEHICLES: standins.vehicle_extended,
}


def dimension_sources(spark, sf_dir, names=tuple(_SOURCES)) -> dict[str, DataFrame]:
    return {name: _SOURCES[name](spark, sf_dir) for name in names}


def _dimension_query(dimension: dimensions.Dimension) -> Query:
    return lambda spark, sf_dir: dimensions.build(
        dimension, dimension_sources(spark, sf_dir, dimension.sources)
    )


for _dimension in dimensions.DIMENSIONS:
    QUERIES[_dimension.name] = _dimension_query(_dimension)


@query
def ecu_name(spark, sf_dir):
    fact = standins.error_fact(spark, sf_dir)
    return fact.select(
        "diagnosis_address",
        "diagnosis_address_text",
        text.ecu_name(
            F.col("diagnosis_address"), F.col("diagnosis_address_text")
        ).alias("ecu_name"),
        "dtc",
    )


@query
def join_model_bridge(spark, sf_dir):
    bridge = dimensions.model_bridge(standins.error_fact(spark, sf_dir))
    return standins.vehicle_extended(spark, sf_dir).join(bridge, dimensions.KEY)


@query
def dim_distinct_counts(spark, sf_dir):
    """Orders meet their lines once, in tables that all sources read; these go at the end."""
    root = staging.staging_folder(spark, stored.LOCAL_FALLBACK)
    placed, items = standins.staged(spark, sf_dir, f"{root}/tables")
    sources = {
        dimensions.ERROR_FACT: standins.error_fact(spark, sf_dir, items),
        dimensions.COMPLAINTS: standins.complaint_daily(spark, sf_dir, items),
        dimensions.VEHICLES: standins.vehicle_extended(spark, sf_dir, placed),
    }
    slices = standins.slices(spark, sf_dir)
    counts = dimension_counts.count_in_slices(spark, sources, root, slices)
    staging.drop(spark, f"{root}/tables")
    return counts


# --- listings and moves ------------------------------------------------------------------


@query
def file_listing(spark, sf_dir):
    found = listing.select_objects(
        standins.inbox_listing(spark, sf_dir), ["core/2024-01-0", "core/not"], ".csv"
    )
    return found.select("path", "size")


@query
def file_pattern_filter(spark, sf_dir):
    names = listing.without_dummies(standins.inbox_listing(spark, sf_dir)).withColumn(
        "target_file", F.substring_index("path", "/", -1)
    )
    return listing.matching_names(names, r"\.csv").select("path", "target_file")


@query
def snapshot_folders(spark, sf_dir):
    return listing.snapshot_folders(standins.inbox_listing(spark, sf_dir))


@query
def newer_than_watermark(spark, sf_dir):
    newer = listing.newer_than(
        standins.inbox_listing(spark, sf_dir), dates.as_date("2024-01-05")
    )
    return newer.select("path", "folder_date")


@query
def files_new_first(spark, sf_dir):
    ordered = listing.new_files_last(
        standins.inbox_listing(spark, sf_dir), dates.as_date("2024-01-20")
    )
    return ordered.select("path", "is_new")


@query
def move_plan(spark, sf_dir):
    plan = moves.move_plan(
        standins.inbox_listing(spark, sf_dir), MOVES, standins.LOAD_DATE
    )
    return plan.drop("path", "modified_at")


def _marked(spark, sf_dir) -> DataFrame:
    plan = moves.move_plan(
        standins.inbox_listing(spark, sf_dir), MOVES, standins.LOAD_DATE
    )
    return moves.mark_duplicates(plan, standins.landing_listing(spark, sf_dir))


@query
def duplicate_targets(spark, sf_dir):
    return _marked(spark, sf_dir).select("path", "final_key", "is_duplicate")


@query
def duplicate_versions(spark, sf_dir):
    plan = moves.move_plan(
        standins.inbox_listing(spark, sf_dir), MOVES, standins.LOAD_DATE
    )
    numbered = moves.duplicate_versions(
        plan, standins.duplicates_listing(spark, sf_dir)
    )
    return numbered.select("path", "duplicate_key", "version")


def _strategy(spark, sf_dir, name: str) -> DataFrame:
    plan = moves.move_plan(
        standins.inbox_listing(spark, sf_dir), MOVES, standins.LOAD_DATE
    )
    decided = moves.apply_strategy(
        plan,
        standins.landing_listing(spark, sf_dir),
        standins.duplicates_listing(spark, sf_dir),
        name,
    )
    return decided.select(
        F.lit(name).alias("strategy"), "path", "action", "write_key"
    )


@query
def duplicate_strategy(spark, sf_dir):
    return (
        _strategy(spark, sf_dir, "skip")
        .unionByName(_strategy(spark, sf_dir, "overwrite"))
        .unionByName(_strategy(spark, sf_dir, "version"))
    )


@query
def move_report(spark, sf_dir):
    return moves.move_report(_marked(spark, sf_dir))


# --- responses ---------------------------------------------------------------------------


@query
def overview_uuids(spark, sf_dir):
    return responses.overview_uuids(
        standins.overviews(spark, sf_dir), "body", ("product_id",)
    )


@query
def raw_object_key(spark, sf_dir):
    return standins.responses(spark, sf_dir).select(
        "uuid",
        text.raw_object_key(
            "baselines/", F.lit(standins.LOAD_DATE), F.col("product_id"), F.col("uuid")
        ).alias("object_key"),
    )


@query
def request_urls(spark, sf_dir):
    return standins.responses(spark, sf_dir).select(
        "uuid",
        responses.overview_url(
            OVERVIEW_TEMPLATE, F.col("product_id"), API_VERSION
        ).alias("overview_url"),
        responses.baseline_url(BASELINE_TEMPLATE, F.col("uuid"), API_VERSION).alias(
            "baseline_url"
        ),
    )


@query
def json_validity(spark, sf_dir):
    return standins.responses(spark, sf_dir).select(
        "uuid", nested.is_json(F.col("body")).alias("is_json")
    )


@query
def response_triage(spark, sf_dir):
    return responses.triage(standins.responses(spark, sf_dir)).select(
        "uuid", "status", "outcome"
    )


@query
def response_report(spark, sf_dir):
    return responses.response_report(
        standins.responses(spark, sf_dir), "product_id"
    )


# --- load log and maintenance ----------------------------------------------------------------


@query
def latest_load_per_table(spark, sf_dir):
    return load_log.latest_load(standins.load_log(spark, sf_dir))


@query
def min_watermark(spark, sf_dir):
    return load_log.shared_watermark(standins.load_log(spark, sf_dir))


@query
def effective_watermark(spark, sf_dir):
    """Logged tables and tables never loaded (the nations), without and with a given date."""
    log = standins.load_log(spark, sf_dir)
    names = (
        log.select("table_name")
        .distinct()
        .unionByName(
            standins.table(spark, sf_dir, "nation").select(
                F.col("n_name").alias("table_name")
            )
        )
    )
    history = F.col("latest_load")
    return names.join(load_log.latest_load(log), "table_name", "left").select(
        "table_name",
        load_log.effective_watermark(history).alias("from_history"),
        load_log.effective_watermark(history, explicit="2024-02-02").alias("from_date"),
    )


@query
def maintenance_due(spark, sf_dir):
    control = standins.maintenance_control(spark, sf_dir)
    return maintenance.due(control, "vacuum", "2024-02-01").select(
        "table_name", "days", "vacuum_last_run", "vacuum_next_run"
    )


@query
def optimize_due(spark, sf_dir):
    control = standins.maintenance_control(spark, sf_dir, "optimize")
    return maintenance.due(control, "optimize", "2024-02-01").select(
        "table_name", "days", "optimize_last_run", "optimize_next_run"
    )


QUERIES.update(stored.QUERIES)

"""Command line for spark-submit: ``jobs.py core-load --landing ... --storage ...``.

Dates are arguments of every job, so a run can be repeated with the same result.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates
from fleetquill.operators import core, dimensions, maintenance, moves, responses
from fleetquill.plans import baseline_load, core_load, dimension_batch, response_landing
from fleetquill.sources import listing, readers
from fleetquill.streaming import landing_stream


def _retention(args) -> dates.Retention:
    return dates.Retention(args.years, args.months, args.days)


def run_core_load(spark: SparkSession, args) -> object:
    root = args.storage.rstrip("/")
    paths = core_load.CorePaths(
        args.landing, f"{root}/modprod", f"{root}/modkpb", f"{root}/load_log"
    )
    return core_load.load_core(
        spark, paths, args.load_date, _retention(args), args.watermark
    )


def run_baseline_load(spark: SparkSession, args) -> object:
    root = args.storage.rstrip("/")
    paths = baseline_load.BaselinePaths(
        args.landing, f"{root}/baseline", f"{root}/load_log"
    )
    return baseline_load.load_baselines(
        spark, paths, args.load_date, _retention(args), args.watermark, args.multi_line
    )


def run_core_stream(spark: SparkSession, args) -> object:
    root = args.storage.rstrip("/")
    paths = core_load.CorePaths(
        args.landing, f"{root}/modprod", f"{root}/modkpb", f"{root}/load_log"
    )
    return landing_stream.stream_core(
        spark, args.landing, paths, args.checkpoint, args.load_date, _retention(args)
    )


def run_baseline_stream(spark: SparkSession, args) -> object:
    root = args.storage.rstrip("/")
    paths = baseline_load.BaselinePaths(
        args.landing, f"{root}/baseline", f"{root}/load_log"
    )
    return landing_stream.stream_baselines(
        spark, args.landing, paths, args.checkpoint, args.load_date, _retention(args)
    )


def run_requests(spark: SparkSession, args) -> object:
    """Overview URLs of the interface file's products, one per row."""
    interface = readers.read_csv_positional(spark, args.interface, schemas.INTERFACE_COLUMNS)
    product = F.col("product_id")
    urls = core.product_ids(interface).select(
        product, responses.overview_url(args.template, product, args.api_version).alias("url")
    )
    urls.write.mode("overwrite").parquet(args.output)
    return args.output


def run_land_responses(spark: SparkSession, args) -> object:
    raw = readers.read_table_path(spark, args.responses, schemas.RAW_RESPONSE)
    return response_landing.land_responses(raw, args.landing, args.day, not args.lenient)


def run_dimensions(spark: SparkSession, args) -> object:
    sources = {
        dimensions.ERROR_FACT: args.error_fact,
        dimensions.COMPLAINTS: args.complaints,
        dimensions.VEHICLES: args.vehicles,
    }
    chosen = [dimensions.BY_NAME[n] for n in args.only or dimensions.BY_NAME]
    absent = {s for d in chosen for s in d.sources if not sources[s]}
    if absent:
        raise ValueError(f"no path given for {', '.join(sorted(absent))}")
    known = {
        name: readers.read_table_path(spark, path, table_format=args.format)
        for name, path in sources.items()
        if path
    }
    return dimension_batch.write_dimensions(
        spark,
        known,
        args.output,
        chosen,
        together=not args.separately,
        table_format=args.format,
    )


def run_move_plan(spark: SparkSession, args) -> object:
    settings = moves.MoveSettings(file_pattern=args.pattern)

    def keys(root: str, prefix: str):
        found = listing.relative_to(listing.list_files(spark, root), root)
        return listing.select_objects(found, prefix)

    decided = moves.apply_strategy(
        moves.move_plan(keys(args.inbox, settings.source_path), settings, args.load_date),
        keys(args.landing, settings.target_path),
        keys(args.landing, settings.duplicates_path),
        args.strategy,
    )
    decided.write.mode("overwrite").parquet(args.output)
    report = moves.move_report(spark.read.parquet(args.output)).first()
    if report["total"] == 0:
        raise FileNotFoundError(f"no files to move below {args.inbox}")
    return report.asDict()


def run_due(spark: SparkSession, args) -> object:
    control = readers.read_maintenance_control(spark, args.control, args.task)
    due = maintenance.due(control, args.task, args.today)
    due.write.mode("overwrite").parquet(args.output)
    return args.output


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    loads = {
        "core-load": run_core_load,
        "baseline-load": run_baseline_load,
        "core-stream": run_core_stream,
        "baseline-stream": run_baseline_stream,
    }
    for name, run in loads.items():
        load = jobs.add_parser(name)
        load.set_defaults(run=run)
        if name.endswith("stream"):
            load.add_argument("--checkpoint", required=True)
        load.add_argument("--landing", required=True)
        load.add_argument("--storage", required=True)
        load.add_argument("--load-date", required=True, type=dt.date.fromisoformat)
        load.add_argument("--watermark", type=dt.date.fromisoformat)
        load.add_argument("--years", type=int, default=15)
        load.add_argument("--months", type=int, default=0)
        load.add_argument("--days", type=int, default=0)
        load.add_argument("--multi-line", action="store_true")

    dims = jobs.add_parser("dimensions")
    dims.set_defaults(run=run_dimensions)
    dims.add_argument("--error-fact", required=True)
    dims.add_argument("--complaints")
    dims.add_argument("--vehicles")
    dims.add_argument("--output", required=True)
    dims.add_argument("--only", nargs="*", choices=list(dimensions.BY_NAME))
    dims.add_argument("--separately", action="store_true")
    dims.add_argument("--format", default="parquet")

    plan = jobs.add_parser("move-plan")
    plan.set_defaults(run=run_move_plan)
    plan.add_argument("--inbox", required=True)
    plan.add_argument("--landing", required=True)
    plan.add_argument("--output", required=True)
    plan.add_argument("--load-date", required=True, type=dt.date.fromisoformat)
    plan.add_argument("--pattern", default=r"\.csv")
    plan.add_argument(
        "--strategy", default="overwrite", choices=["skip", "overwrite", "version"]
    )

    urls = jobs.add_parser("requests")
    urls.set_defaults(run=run_requests)
    urls.add_argument("--interface", required=True)
    urls.add_argument("--template", required=True)
    urls.add_argument("--api-version", required=True)
    urls.add_argument("--output", required=True)

    land = jobs.add_parser("land-responses")
    land.set_defaults(run=run_land_responses)
    land.add_argument("--responses", required=True)
    land.add_argument("--landing", required=True)
    land.add_argument("--day", required=True, type=dt.date.fromisoformat)
    land.add_argument("--lenient", action="store_true")

    due = jobs.add_parser("due")
    due.set_defaults(run=run_due)
    due.add_argument("--control", required=True)
    due.add_argument("--task", required=True, choices=["vacuum", "optimize"])
    due.add_argument("--today", required=True, type=dt.date.fromisoformat)
    due.add_argument("--output", required=True)
    return top


def main(argv: list[str] | None = None) -> object:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"fleetquill-{args.job}").getOrCreate()
    result = args.run(spark, args)
    print(result)
    return result


if __name__ == "__main__":
    main()

"""Readers, writers and whole loads on files in scratch folders."""

import dataclasses
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conftest import rows
from fleetquill import jobs, schemas
from fleetquill.catalog import queries
from fleetquill.functions import dates, text
from fleetquill.operators import core, dimensions, merge
from fleetquill.plans import (
    baseline_load,
    core_load,
    dimension_batch,
    response_landing,
    staging,
    upsert,
)
from fleetquill.sinks import writers
from fleetquill.sources import files, listing, load_log, readers
from fleetquill.streaming import landing_stream

D = dt.date
KEEP = dates.Retention(years=15)
PROD = "MODEL;MODEL_YEAR;SALES_CLASS;PRODUCT"
KPB = "MODEL;SALES_CLASS;PRODUCT;KPB"


def write(folder, name, *lines, end="\r\n"):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(end.join(lines))
    return path


# --- readers ------------------------------------------------------------------------------


def test_core_csv(spark, folder):
    path = write(folder, "a.csv", PROD, "m;2022;s;p", "m;;s;p", "")
    df = readers.read_core_csv(spark, path)
    assert df.columns == schemas.MODPROD_HEADER
    assert rows(df) == [("m", None, "s", "p"), ("m", "2022", "s", "p")]


def test_positional_csv(spark, folder):
    path = write(folder, "a.csv", "a;b;c", "d;;f")
    assert rows(readers.read_csv_positional(spark, path, ["x", "y"])) == [
        ("a", "b"),
        ("d", None),
    ]
    with pytest.raises(AnalysisException):
        readers.read_csv_positional(spark, path, ["x", "y", "z", "w"])


def test_read_files_by_format(spark, folder):
    path = write(folder, "a.csv", "n,day", "1,2024-01-05")
    typed = dict(readers.read_files(spark, path, "csv").dtypes)
    assert typed["n"] == "int"
    writers.overwrite_parquet(spark.range(3), f"{folder}/p")
    assert readers.read_files(spark, f"{folder}/p", "parquet").count() == 3
    with pytest.raises(ValueError):
        readers.read_files(spark, path, "avrox")


def test_baseline_json(spark, folder):
    write(folder, "one/a", '{"content":{"productId":"V1","status":"x"}}')
    write(folder, "two/a", "{", '"content":{"productId":"V2"}', "}", end="\n")
    df = readers.read_baselines(spark, f"{folder}/one")
    assert rows(df.select("content.productId", "content.materials")) == [("V1", None)]
    pretty = readers.read_baselines(spark, f"{folder}/two", multi_line=True)
    assert rows(pretty.select("content.productId")) == [("V2",)]


def test_listing_reads_no_content(spark, folder):
    write(folder, "core/2024-01-05/a.csv", "12345")
    files = listing.list_files(spark, f"{folder}/core")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    got = listing.relative_to(files, f"{folder}/core")
    assert rows(got.select("path", "size")) == [("2024-01-05/a.csv", 5)]


def test_catalog_table(spark):
    spark.range(2).createOrReplaceTempView("two_rows")
    assert readers.read_catalog_table(spark, "two_rows").count() == 2


# --- writers -------------------------------------------------------------------------------


def test_writers(spark, folder):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("brand"))
    writers.overwrite_parquet_files(df, f"{folder}/n", 3)
    assert len([f for f in os.listdir(f"{folder}/n") if f.endswith(".parquet")]) == 3
    writers.overwrite_parquet_partitioned(df, f"{folder}/by", "brand")
    assert {"brand=0", "brand=1"} <= set(os.listdir(f"{folder}/by"))
    writers.overwrite_clustered(df, f"{folder}/cl", "brand", ["id"])
    assert spark.read.parquet(f"{folder}/cl").count() == 100
    writers.overwrite_compact(df, f"{folder}/one")
    assert len([f for f in os.listdir(f"{folder}/one") if f.endswith(".parquet")]) == 1
    writers.overwrite_compact(df.select(F.lit("x").alias("other")), f"{folder}/one")
    assert spark.read.parquet(f"{folder}/one").columns == ["other"]
    assert writers.append_partitioned(df, f"{folder}/ap", "brand") == 100
    assert writers.append_partitioned(df.limit(0), f"{folder}/ap", "brand") == 0
    assert spark.read.parquet(f"{folder}/ap").count() == 100


def test_text_partition_stays_text(spark, folder):
    df = spark.createDataFrame([("1600-01-01", 1)], "validfrom string, n int")
    writers.append_partitioned(df, f"{folder}/t", "validfrom")
    back = readers.read_table_path(spark, f"{folder}/t", df.schema)
    assert rows(back) == [("1600-01-01", 1)]


# --- core load ------------------------------------------------------------------------------


@pytest.fixture
def core_paths(folder):
    land = f"{folder}/core"
    write(land, "2024-01-05/a.csv", PROD, "m1;2022;s;p", "m1;2022;s;p", "m2;;s;p")
    write(land, "2024-01-06/b.csv", PROD, "m1;2022;s;p", "m3;2023;s;p", "m2;;s;p")
    write(land, "2024-01-06/k.csv", KPB, "m1;s;p;k")
    write(land, "2024-01-06/wrong.csv", "version;timestamp;x,", "6;t;null")
    write(land, "2024-01-06/empty.csv", PROD)
    write(land, "core_duplicates/a.csv", PROD, "no;2000;n;o")
    return core_load.CorePaths(land, f"{folder}/prod", f"{folder}/kpb", f"{folder}/log")


def _prod(spark, paths):
    df = spark.read.schema(schemas.MODPROD_STORED).parquet(paths.modprod)
    return df.select("Model", "Model_Year", "Load_Date", "KSU_LOESCH_DATUM")


def test_core_load_and_rerun(spark, core_paths):
    first = core_load.load_core(spark, core_paths, "2024-02-29", KEEP)
    assert first == {"modprod": 5, "modkpb": 1}
    day, end = D(2024, 2, 29), D(2039, 2, 28)
    assert rows(_prod(spark, core_paths)) == [
        ("m1", "2022", day, end),
        ("m1", "2022", day, end),
        ("m2", None, day, end),
        ("m2", None, day, end),
        ("m3", "2023", day, end),
    ]
    # the same folders once more: only the rows with a null key come again
    again = core_load.load_core(
        spark, core_paths, "2024-02-29", KEEP, watermark="2024-01-01"
    )
    assert again == {"modprod": 2, "modkpb": 0}
    # another day is another key
    later = core_load.load_core(
        spark, core_paths, "2024-03-01", KEEP, watermark="2024-01-05"
    )
    assert later == {"modprod": 3, "modkpb": 1}
    log = load_log.read_load_log(spark, core_paths.load_log)
    assert log.count() == 6
    # without a date the log decides, and nothing is newer than today
    assert core_load.load_core(spark, core_paths, "2024-03-02", KEEP) == {
        "modprod": 0,
        "modkpb": 0,
    }


def test_core_load_needs_files(spark, folder):
    os.makedirs(f"{folder}/core")
    paths = core_load.CorePaths(f"{folder}/core", f"{folder}/p", f"{folder}/k", f"{folder}/l")
    with pytest.raises(FileNotFoundError):
        core_load.load_core(spark, paths, "2024-02-29", KEEP)


def test_merge_prunes_the_target_to_the_load_date(spark, core_paths):
    core_load.load_core(spark, core_paths, "2024-02-29", KEEP)
    table = core_load.stored_table(core_paths, "modprod")
    columns = ", ".join(f"{c} string" for c in schemas.MODPROD_COLUMNS)
    new = merge.new_rows(
        spark.createDataFrame([("m1", "2022", "s", "p")], columns),
        upsert.read_or_empty(spark, table),
        table.keys,
        constants=core.load_dates("2024-02-29", KEEP),
    )
    plan = new._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Load_Date" in filters and "= 2024-02-29" in filters
    assert new.count() == 0


def test_only_new_folders_are_listed(spark, core_paths, monkeypatch):
    """Of the history only folder names are asked for, and no scan covers it."""
    core_load.load_core(spark, core_paths, "2024-01-07", KEEP)
    write(core_paths.landing, "2024-01-08/c.csv", PROD, "m4;2022;s;p")
    write(core_paths.landing, "2024-1-9/d.csv", PROD, "m5;2022;s;p")
    os.makedirs(f"{core_paths.landing}/2024-01-10")
    looked, scanned = [], []
    below, lines = files.files_below, readers.read_core_lines
    monkeypatch.setattr(files, "files_below", lambda s, path: looked.append(path) or below(s, path))
    monkeypatch.setattr(readers, "read_core_lines", lambda s, paths: scanned.extend(paths) or lines(s, paths))
    loaded = core_load.load_core(spark, core_paths, "2024-01-11", KEEP, watermark="2024-01-07")
    assert loaded == {"modprod": 2, "modkpb": 0}
    root = core_paths.landing
    assert scanned == [f"{root}/2024-01-08", f"{root}/2024-1-9"]
    assert [p for p in looked if p.startswith(f"{root}/")] == [*scanned, f"{root}/2024-01-10"]


@pytest.mark.parametrize("table_format", ["csv", "json", "parquet"])
def test_loads_in_any_table_format(spark, folder, core_paths, table_format):
    """Appends, existence, load log, watermark and pruned merge on tables of each format."""
    paths = dataclasses.replace(core_paths, table_format=table_format)
    table = core_load.stored_table(paths, "modprod")
    assert not table.exists(spark)
    assert core_load.load_core(spark, paths, "2024-02-29", KEEP) == {"modprod": 5, "modkpb": 1}
    assert core_load.load_core(spark, paths, "2024-02-29", KEEP, watermark="2024-01-01") == {"modprod": 2, "modkpb": 0}
    assert core_load.find_watermark(spark, paths) >= D(2024, 2, 29)
    stored = table.read(spark)
    assert stored.schema == schemas.MODPROD_STORED or [f.dataType for f in stored.schema] == [f.dataType for f in schemas.MODPROD_STORED]
    assert rows(stored.select("Model", "Model_Year", "Load_Date").distinct()) == [
        ("m1", "2022", D(2024, 2, 29)),
        ("m2", None, D(2024, 2, 29)),
        ("m3", "2023", D(2024, 2, 29)),
    ]
    land = f"{folder}/base"
    base = baseline_load.BaselinePaths(land, f"{folder}/baselines", f"{folder}/base_log", table_format)
    write(land, "2024-01-01/a", _baseline("V1", "p", "h1"))
    assert baseline_load.load_baselines(spark, base, "2024-02-01", KEEP) == 1
    write(land, "2024-01-02/b", _baseline("V1", "p", "h1"), _baseline("V2", "p", "h1"), end="\n")
    assert baseline_load.load_baselines(spark, base, "2024-02-02", KEEP, watermark="2024-01-01") == 1
    kept = baseline_load.stored_table(base).read(spark)
    assert rows(kept.select("productId", "validfrom")) == [("V1", "1600-01-01"), ("V2", "2024-01-02")]


@pytest.mark.parametrize("table_format", ["csv", "json", "parquet"])
def test_appended_tables_read_back_equal(spark, folder, table_format):
    schema = "a string, n int, at timestamp, validfrom string"
    at = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    data = [(" x ", 1, at, "1600-01-01"), ('q"u;o,te\\', None, None, "2024-01-02"), ("", 2, at, "2024-01-02"), (None, 3, at, "2024-01-02"), ("a\\b", 5, at, "2024-01-02"), ("two\nlines", 4, at, "2024-01-03")]
    df = spark.createDataFrame(data, schema)
    assert writers.append_partitioned(df, f"{folder}/t", "validfrom", table_format) == len(data)
    assert writers.append_partitioned(df, f"{folder}/t", "validfrom", table_format, cluster=["a", "n"]) == len(data)
    back = readers.read_table_path(spark, f"{folder}/t", df.schema, table_format)
    assert rows(back) == rows(df.union(df))


def test_a_folder_of_other_files_is_no_table(spark, folder):
    write(folder, "t/part-0.csv", "a;b")
    write(folder, "u/_SUCCESS", "")
    assert not load_log.table_exists(spark, f"{folder}/t")
    assert load_log.table_exists(spark, f"{folder}/t", "csv")
    assert not load_log.table_exists(spark, f"{folder}/u", "csv")
    assert not load_log.table_exists(spark, f"{folder}/nowhere")


def test_pruned_merge_reads_few_row_groups(spark, folder):
    """A batch of one product leaves out the files whose statistics exclude it."""
    table = baseline_load.stored_table(baseline_load.BaselinePaths("", f"{folder}/t", f"{folder}/l"))
    keys = [F.lit("x").alias(k) for k in table.keys if k != "productId"]
    stored = spark.range(4000).select(
        F.format_string("V%03d", F.col("id") % 400).alias("productId"),
        F.col("id").cast("string").alias("partNumber"),
        *[k for k, name in zip(keys, [k for k in table.keys if k != "productId"]) if name != "partNumber"],
        F.lit("2024-01-01").alias("validfrom"),
        F.lit(D(2039, 1, 1)).alias("KSU_LOESCH_DATUM"),
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        assert table.append(stored) == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    for products, most in (([7], 2000), ([7, 390], 2400), (range(400), 4000)):
        values = spark.createDataFrame([(f"V{k:03d}",) for k in products], "productId string")
        part = upsert.matching_part(table.read(spark), values, "productId")
        assert part.count() == 10 * len(products)
        assert scanned_rows(part) <= most, products


def scanned_rows(df):
    """Rows that the scan of the largest table gave, row groups left out not counted."""
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan()
    plan.execute().count()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    counts, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            counts.append(node.metrics().apply("numOutputRows").value())
        if "QueryStage" in name:
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return max(counts)


# --- baseline load ----------------------------------------------------------------------------


def _baseline(product, part, version):
    return (
        '{"content":{"productId":"%s","status":"Published","materials":[{"partNumber":"%s",'
        '"naming":"n","materialType":"t","diagnosisAddresses":["1"],"ecuVersions":[{'
        '"hardwareVersion":"%s","softwareVersion":"s","hardwarePartNumber":"h",'
        '"frozenStatus":{"abbreviation":"f"}}]}]}}' % (product, part, version)
    )


def _validity(spark, path):
    df = readers.read_table_path(spark, path, schemas.BASELINE_STORED)
    return rows(df.select("productId", "hardwareVersion", "validfrom"))


def test_baseline_load_over_snapshots(spark, folder):
    land = f"{folder}/base"
    paths = baseline_load.BaselinePaths(land, f"{folder}/table", f"{folder}/log")
    write(land, "2024-1-1/V1_a", _baseline("V1", "p", "h1"))
    write(land, "2024-01-02/V1_b", _baseline("V1", "p", "h1"))
    write(land, "2024-01-02/V1_c", _baseline("V1", "p", "h2"))
    assert baseline_load.load_baselines(spark, paths, "2024-02-01", KEEP) == 2
    assert _validity(spark, paths.table) == [
        ("V1", "h1", "1600-01-01"),
        ("V1", "h2", "2024-01-02"),
    ]
    write(land, "2024-01-03/V1_d", _baseline("V1", "p", "h2"))
    write(land, "2024-01-03/V2_a", _baseline("V2", "p", "h1"))
    again = baseline_load.load_baselines(
        spark, paths, "2024-02-02", KEEP, watermark="2024-01-02"
    )
    assert again == 1
    assert _validity(spark, paths.table)[-1] == ("V2", "h1", "2024-01-03")


def test_matching_part(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    values = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(upsert.matching_part(target, values, "k")) == [("a", 1)]
    assert upsert.matching_part(target, values.limit(0), "k").count() == 0


# --- streams ------------------------------------------------------------------------------------


def test_core_stream_loads_a_mixed_landing_as_the_batch_load_does(spark, folder):
    land = f"{folder}/core"
    write(land, "2024-01-03/b.csv", PROD, "m1;2022;s;p", "m1;2022;s;p", "m3;2022;s;p")
    write(land, "2024-01-02/a.csv", PROD, "m1;2022;s;p", "m2;;s;p")
    write(land, "2024-01-02/k.csv", KPB, "m1;s;p;k")
    write(land, "2024-01-02/x.csv", "OTHER;COLUMNS;OF;A_FILE", "m9;s;p;k")
    tables = {}
    for limit in (1, 1000, None):
        root = f"{folder}/{limit}"
        paths = core_load.CorePaths(land, f"{root}/prod", f"{root}/kpb", f"{root}/log")
        if limit is None:
            written = core_load.load_core(spark, paths, "2024-02-29", KEEP)
        else:
            written = landing_stream.stream_core(
                spark, f"{land}/*", paths, f"{root}/cp", "2024-02-29", KEEP, limit
            )
        assert written == {"modprod": 3, "modkpb": 1}
        tables[limit] = [rows(spark.read.parquet(p)) for p in (paths.modprod, paths.modkpb)]
    assert tables[1] == tables[1000] == tables[None]


def test_core_stream_takes_new_files_only(spark, folder):
    land = f"{folder}/core"
    paths = core_load.CorePaths(land, f"{folder}/prod", f"{folder}/kpb", f"{folder}/log")

    def run():
        landing_stream.stream_core(spark, land, paths, f"{folder}/cp", "2024-02-29", KEEP)
        return spark.read.parquet(paths.modprod).count()

    write(land, "a.csv", PROD, "m1;2022;s;p", "m2;;s;p")
    assert run() == 2
    assert run() == 2
    write(land, "b.csv", PROD, "m1;2022;s;p", "m3;2022;s;p")
    assert run() == 3
    assert os.listdir(landing_stream.pending_folder(f"{folder}/cp")) == []
    assert load_log.read_load_log(spark, paths.load_log).count() == 4


def test_baseline_stream(spark, folder):
    land = f"{folder}/base"
    paths = baseline_load.BaselinePaths(land, f"{folder}/table", f"{folder}/log")

    def run():
        landing_stream.stream_baselines(
            spark, f"{land}/*", paths, f"{folder}/cp", "2024-02-29", KEEP
        )

    write(land, "2024-01-01/a", _baseline("V1", "p", "h1"))
    run()
    write(land, "2024-01-02/b", _baseline("V1", "p", "h1"))
    write(land, "2024-01-02/c", _baseline("V2", "p", "h1"))
    run()
    assert _validity(spark, paths.table) == [
        ("V1", "h1", "1600-01-01"),
        ("V2", "h1", "2024-01-02"),
    ]


class Died(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["drop", "second table", "before log"])
def test_core_stream_merges_every_batch_once_after_a_crash(spark, folder, monkeypatch, where):
    """A run dies after or between its log rows, or with rows written and none logged; new
    files come; the next run is on another day. Each file is loaded under its own day."""
    land = f"{folder}/core"
    paths = core_load.CorePaths(land, f"{folder}/prod", f"{folder}/kpb", f"{folder}/log")

    def run(day):
        return landing_stream.stream_core(spark, land, paths, f"{folder}/cp", day, KEEP)

    def die(*_, **__):
        raise Died

    write(land, "a.csv", PROD, "m0;2022;s;p")
    run("2024-02-28")
    write(land, "b.csv", PROD, "m1;2022;s;p")
    write(land, "k.csv", KPB, "m1;s;p;k")
    with monkeypatch.context() as patch:
        if where == "drop":
            real = staging.drop
            patch.setattr(staging, "drop", lambda s, path: die() if "pending" in path else real(s, path))
        elif where == "before log":
            patch.setattr(load_log, "append_load", die)
        else:
            real_upsert = upsert.upsert_insert_only
            patch.setattr(
                upsert,
                "upsert_insert_only",
                lambda s, rows_, table, **how: die() if table.name == "modkpb" else real_upsert(s, rows_, table, **how),
            )
        with pytest.raises(Died):
            run("2024-03-01")
    write(land, "c.csv", PROD, "m2;2022;s;p", "m2;2022;s;p")
    run("2024-03-02")
    assert run("2024-03-03") == {"modprod": 0, "modkpb": 0}
    days = {"m0": D(2024, 2, 28), "m1": D(2024, 3, 1), "m2": D(2024, 3, 2)}
    got = spark.read.parquet(paths.modprod).select("Model", "Load_Date")
    assert rows(got) == [(m, days[m]) for m in ("m0", "m1", "m2", "m2")]
    assert rows(spark.read.parquet(paths.modkpb).select("Model", "Load_Date")) == [("m1", days["m1"])]


def test_baseline_stream_after_a_crash(spark, folder, monkeypatch):
    land = f"{folder}/base"
    paths = baseline_load.BaselinePaths(land, f"{folder}/table", f"{folder}/log")

    def run(day):
        return landing_stream.stream_baselines(spark, f"{land}/*", paths, f"{folder}/cp", day, KEEP)

    write(land, "2024-01-01/a", _baseline("V1", "p", "h1"))
    with monkeypatch.context() as patch:
        patch.setattr(staging, "drop", lambda s, path: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            run("2024-02-28")
    write(land, "2024-01-02/b", _baseline("V2", "p", "h1"))
    assert run("2024-02-29") == 1
    assert _validity(spark, paths.table) == [("V1", "h1", "1600-01-01"), ("V2", "h1", "2024-01-02")]


def test_a_new_checkpoint_starts_a_new_ledger(spark, folder):
    land = f"{folder}/core"
    paths = core_load.CorePaths(land, f"{folder}/prod", f"{folder}/kpb", f"{folder}/log")
    for k in range(3):
        write(land, f"{k}.csv", PROD, f"m{k};2022;s;p")
        landing_stream.stream_core(spark, land, paths, f"{folder}/cp", "2024-02-28", KEEP)
    again = landing_stream.stream_core(spark, land, paths, f"{folder}/cp2", "2024-02-29", KEEP)
    assert again["modprod"] == 3


@pytest.mark.parametrize("limit", [1, 1000])
def test_baseline_stream_does_not_depend_on_batches_or_arrival(spark, folder, limit):
    """The older snapshot arrives last; the table is the one the batch load gives."""
    land = f"{folder}/base"
    write(land, "2024-01-02/a", _baseline("V1", "p", "h1"))
    write(land, "2024-01-02/b", _baseline("V3", "p", "h1"))
    for name in ("V0", "V1", "V2"):
        write(land, f"2024-01-01/{name}", _baseline(name, "p", "h1"))
    tables = []
    for kind in ("stream", "batch"):
        root = f"{folder}/{kind}"
        paths = baseline_load.BaselinePaths(land, f"{root}/table", f"{root}/log")
        if kind == "stream":
            landing_stream.stream_baselines(
                spark, f"{land}/*", paths, f"{root}/cp", "2024-02-29", KEEP, limit
            )
        else:
            baseline_load.load_baselines(spark, paths, "2024-02-29", KEEP)
        tables.append(_validity(spark, paths.table))
    assert tables[0] == tables[1]
    assert dict((v, d) for v, _, d in tables[0]) == {
        "V0": "1600-01-01",
        "V1": "1600-01-01",
        "V2": "1600-01-01",
        "V3": "2024-01-02",
    }


def test_roots_are_normalized_and_foreign_paths_refused(spark, folder):
    write(f"{folder}/land/core", "2024-01-05/a.csv", PROD, "m;2022;s;p")
    for root in ("land//core", "land/../land/core", "land/core/"):
        paths = core_load.CorePaths(f"{folder}/{root}", *(f"{folder}/{abs(hash(root))}/{k}" for k in "pkl"))
        assert core_load.load_core(spark, paths, "2024-02-29", KEEP)["modprod"] == 1
    paths = core_load.CorePaths(f"{folder}/land/co*", *(f"{folder}/glob/{k}" for k in "pkl"))
    with pytest.raises(ValueError, match="is a pattern"):
        core_load.load_core(spark, paths, "2024-02-29", KEEP)
    found = listing.relative_to(listing.list_files(spark, f"{folder}/land/co*"), f"{folder}/land/co*")
    with pytest.raises(Exception, match="is not below"):
        found.collect()


def test_dimensions_need_their_sources(spark, folder):
    args = jobs.parser().parse_args(
        ["dimensions", "--error-fact", folder, "--output", folder, "--only", "dim_fault_type"]
    )
    with pytest.raises(ValueError, match="complaint"):
        jobs.run_dimensions(spark, args)


def test_a_logged_batch_is_not_merged_again(spark, folder):
    schema = spark.createDataFrame([], "k string, day date").schema
    table = upsert.Table("t", f"{folder}/t", schema, ["k"], "day", f"{folder}/log")
    df = spark.createDataFrame([(None, D(2024, 1, 1))], schema)
    counts = [
        upsert.upsert_insert_only(spark, df, table, load_id="1", once=True)
        for _ in range(2)
    ]
    assert counts == [1, 0]


# --- dimension batch --------------------------------------------------------------------------------


@pytest.mark.parametrize("together", [True, False])
def test_dimension_batch(spark, folder, together):
    sources = queries.dimension_sources(spark, "/root/testdata/sf0.001")
    names = ["dim_main", "dim_dtc", "dim_fault_type", "dim_mis_label", "dim_zp8_date"]
    names += ["dim_ecu_name", "dim_sw_version", "dim_hw_sw_number"]
    chosen = [dimensions.BY_NAME[n] for n in names]
    paths = dimension_batch.write_dimensions(
        spark, sources, folder, chosen, together=together
    )
    assert os.path.basename(paths["dim_main"]) == "error_recovery_main"
    assert any(f.startswith("brand=") for f in os.listdir(paths["dim_dtc"]))
    for d in chosen:
        back = spark.read.parquet(paths[d.name]).select(*d.columns)
        assert rows(back) == rows(dimensions.build(d, sources))


def test_staging_an_empty_table(spark, folder):
    df = spark.createDataFrame([], "dimension string, n int")
    for partition in (None, "dimension"):
        back = staging.stage(df, f"{folder}/{partition}", partition)
        assert (back.columns, back.count()) == (["dimension", "n"], 0)


def test_staging_uses_the_shared_folder(spark, folder):
    shared = spark.conf.get(staging.CHECKPOINT_DIR, None) or folder
    first, second = [staging.staging_folder(spark, folder) for _ in range(2)]
    assert first.startswith(f"{shared.rstrip('/')}/")
    assert first != second


def test_land_responses(spark, folder):
    raw = spark.createDataFrame(
        [
            ("u", "V1", "1", 200, '{\r\n"content": {"productId": "V1"}}'),
            ("u", "V1", "2", 404, None),
            ("u", "V1", "3", 403, None),
            ("u", None, "4", 200, "<p>"),
        ],
        schemas.RAW_RESPONSE,
    )
    with pytest.raises(response_landing.FailedResponses):
        response_landing.land_responses(raw, folder, "2024-03-01")
    for _ in range(2):  # a rerun replaces the day
        found = response_landing.land_responses(raw, f"{folder}/baselines", "2024-03-01", strict=False)
    assert found == {"ok": 1, "skipped": 1, "error": 1, "invalid_json": 1}
    day = f"{folder}/baselines/2024-03-01"
    write(day, "bare", '{"content":{"productId":"V2"}}')
    landed = readers.read_baselines(spark, day)
    assert rows(landed.select("content.productId")) == [("V1",), ("V2",)]
    (row,) = readers.read_landed_responses(spark, day).where("body is not null").collect()
    assert row.body == raw.first().body
    assert row.object_key == "baselines/2024-03-01/V1_2024-03-01_1"
    rebuilt = text.raw_object_key("baselines/", F.lit("2024-03-01"), F.lit(row.product_id), F.lit(row.uuid))
    assert spark.range(1).select(rebuilt).first()[0] == row.object_key


def test_landed_responses_load_like_bare_documents(spark, folder):
    """A batch load and a stream over landed rows give the table of bare documents."""
    bodies = [_baseline("V1", "p", "h1"), _baseline("V2", "p", "h1")]
    raw = [("u", f"V{k + 1}", str(k), 200, body) for k, body in enumerate(bodies)]
    response_landing.land_responses(
        spark.createDataFrame(raw, schemas.RAW_RESPONSE), f"{folder}/landed", "2024-01-01"
    )
    for k, body in enumerate(bodies):
        write(f"{folder}/bare", f"2024-01-01/{k}", body)
    tables = []
    for kind in ("landed", "bare"):
        paths = baseline_load.BaselinePaths(f"{folder}/{kind}", f"{folder}/t-{kind}", f"{folder}/l-{kind}")
        baseline_load.load_baselines(spark, paths, "2024-02-01", KEEP)
        tables.append(_validity(spark, paths.table))
        streamed = baseline_load.BaselinePaths(f"{folder}/{kind}", f"{folder}/ts-{kind}", f"{folder}/ls-{kind}")
        landing_stream.stream_baselines(spark, f"{folder}/{kind}/*", streamed, f"{folder}/cp-{kind}", "2024-02-01", KEEP)
        tables.append(_validity(spark, streamed.table))
    assert all(t == [("V1", "h1", "1600-01-01"), ("V2", "h1", "1600-01-01")] for t in tables)


# --- command line ----------------------------------------------------------------------------------


def test_jobs(spark, folder, core_paths):
    common = ["--landing", core_paths.landing, "--load-date", "2024-02-29"]
    done = jobs.main(["core-load", *common, "--storage", f"{folder}/store"])
    assert done == {"modprod": 5, "modkpb": 1}

    stream = ["core-stream", "--landing", f"{core_paths.landing}/2024-*", "--load-date", "2024-02-29"]
    stream += ["--storage", f"{folder}/streamed", "--checkpoint", f"{folder}/cp"]
    assert jobs.main(stream) == done
    assert jobs.main(stream) == {"modprod": 0, "modkpb": 0}

    width = len(schemas.INTERFACE_COLUMNS)
    at = schemas.INTERFACE_COLUMNS.index("produktkennzeichen")
    lines = [";".join(p if k == at else "x" for k in range(width)) for p in ("V1", "V1", "", "V2")]
    write(folder, "interface.csv", *lines)
    ask = ["requests", "--interface", f"{folder}/interface.csv", "--api-version", "2"]
    ask += ["--template", "https://example.invalid/{api_version}/{vpId}", "--output", f"{folder}/urls"]
    jobs.main(ask)
    assert rows(spark.read.parquet(f"{folder}/urls")) == [
        ("V1", "https://example.invalid/2/V1"),
        ("V2", "https://example.invalid/2/V2"),
    ]

    write(folder, "inbox/core/2024-01-05/a.csv", PROD)
    write(folder, "land/core/2024/01/05/a.csv", PROD)
    where = ["--inbox", f"{folder}/inbox", "--landing", f"{folder}/land"]
    plan = ["move-plan", *where, "--load-date", "2024-02-29", "--output", f"{folder}/plan"]
    assert jobs.main(plan) == {"total": 1, "duplicates": 1}
    key = spark.read.parquet(f"{folder}/plan").first().write_key
    assert key == "core/core_duplicates/2024/01/05/a.csv"

    write(
        folder,
        "control.csv",
        "table_name,s3_table_path,days,vacuum_flag,retention_days,vacuum_last_run,vacuum_next_run",
        "t,p,1,true,7,2024-02-01,",
        "u,p,1,false,7,2024-02-01,",
        "v,p,1,,,,",
        "w,p,,true,,,",
    )
    due = ["due", "--control", f"{folder}/control.csv", "--task", "vacuum"]
    jobs.main([*due, "--today", "2024-02-02", "--output", f"{folder}/due"])
    due = spark.read.parquet(f"{folder}/due")
    assert rows(due.select("table_name")) == [("t",), ("w",)]
    assert dict(due.dtypes)["vacuum_next_run"] == "date"

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetquill import schemas
from fleetquill.catalog import queries
from fleetquill.functions import dates
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
from fleetquill.sources import listing, load_log, readers

D = dt.date


# --- core ------------------------------------------------------------------------------


def test_normalization_gives_a_row_per_series_and_year(spark):
    df = spark.createDataFrame(
        [
            ("N1", "first", "K", "QA (2031 - 2034)"),  # three years, the end is not one
            ("N2", "second", "K", "QB (2040), QC (2041 - 2042), QB (2044)"),  # one each
            ("N3", "third", "L", "QD (2036 - 2036)"),  # an empty range
            ("N4", "fourth", "L", "QE (2038 - 2035)"),  # a range that runs backwards
            ("N5", "fifth", "L", ""),
            ("N6", "sixth", "L", None),
        ],
        "Produkt string, Beschreibung string, Produkttyp string, Vertriebliche_Klasse string",
    )
    dated = core.with_load_dates(df, "2024-03-01", dates.Retention(15))
    out = core.normalize_sales_classes(dated)
    assert rows(out.select("Produkt", "series", "modelljahr")) == [
        ("N1", "QA", 2031),
        ("N1", "QA", 2032),
        ("N1", "QA", 2033),
        ("N2", "QB", 2040),
        ("N2", "QB", 2044),
        ("N2", "QC", 2041),
    ]


def test_classify_schema(spark):
    def dated(names):
        df = spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
        return core.with_load_dates(df, "2024-03-01", dates.Retention(15)).schema

    assert classify.classify_schema(dated(schemas.MODPROD_HEADER)) == "modprod"
    assert classify.classify_schema(dated(schemas.MODKPB_HEADER)) == "modkpb"
    assert classify.classify_schema(dated(schemas.MODKPB_HEADER[::-1])) is None
    assert classify.classify_schema(dated([*schemas.MODPROD_HEADER, "X"])) is None


def test_classify_files_by_first_line(spark):
    prod = "MODEL;MODEL_YEAR;SALES_CLASS;PRODUCT"
    lines = [
        ("a", 5, prod),
        ("a", 6, "x;1;y;z"),
        ("b", 1, '"MODEL";"SALES_CLASS";"PRODUCT";"KPB"'),
        ("c", 1, prod.lower()),
        ("d", 1, "MODEL_YEAR;MODEL;SALES_CLASS;PRODUCT"),
        ("e", 1, prod + ";X"),
        ("f", 1, "x;1;y;z"),
        ("f", 2, prod),
    ]
    df = spark.createDataFrame(lines, "path string, position bigint, line string")
    got = rows(classify.classify_files(df).select("path", "table_class"))
    assert got == [
        ("a", "modprod"),
        ("b", "modkpb"),
        ("c", None),
        ("d", None),
        ("e", None),
        ("f", None),
    ]
    data = classify.data_lines(df, classify.classify_files(df))
    assert rows(data.select("path", "line")) == [("a", "x;1;y;z")]


# --- merge -------------------------------------------------------------------------------


def test_merge_inserts_unknown_rows_and_null_keys(spark):
    target = spark.createDataFrame([("a", "1"), ("b", None)], "k string, v string")
    updates = spark.createDataFrame(
        [("a", "1"), ("b", None), ("c", "3"), ("c", "3")], "k string, v string"
    )
    new = merge.new_rows(updates, target, ["k", "v"])
    assert rows(new) == [("b", None), ("c", "3"), ("c", "3")]
    safe = merge.new_rows(updates, target, ["k", "v"], null_safe=True)
    assert rows(safe) == [("c", "3"), ("c", "3")]
    assert merge.merged(updates, target, ["k", "v"]).count() == 5
    empty = target.limit(0)
    assert merge.new_rows(updates, empty, ["k", "v"]).count() == 4


def test_merge_of_files_one_after_the_other(spark):
    batch = [("x", "1", "f1"), ("x", "1", "f1"), ("x", "1", "f2"), ("x", "1", "f2")]
    batch += [("x", "1", "f2"), ("y", "2", "f2"), ("n", None, "f1"), ("n", None, "f2")]
    updates = spark.createDataFrame(batch, "k string, v string, file string")
    target = spark.createDataFrame([("y", "2")], "k string, v string")
    new = merge.new_rows(updates, target, ["k", "v"], file_order="file")
    assert rows(new) == [("n", None), ("n", None), ("x", "1"), ("x", "1")]


def test_merge_with_constants_looks_at_matching_rows_only(spark):
    target = spark.createDataFrame(
        [("a", D(2024, 1, 1)), ("b", D(2024, 1, 2))], "k string, day date"
    )
    updates = spark.createDataFrame([("a",), ("b",)], "k string")
    new = merge.new_rows(
        updates, target, ["day", "k"], constants={"day": dates.as_date("2024-01-02")}
    )
    assert rows(new) == [("a", D(2024, 1, 2))]


@pytest.mark.parametrize("copies", [1, 63, 64, 65, 65536, 65537, 200000])
def test_copies_are_repeated_exactly(spark, copies):
    counted = spark.createDataFrame([("a", copies), ("b", 1)], f"k string, {merge.COPIES} long")
    got = merge.repeat_copies(counted).groupBy("k").count()
    assert rows(got) == [("a", copies), ("b", 1)]


# --- baselines ----------------------------------------------------------------------------


DOCUMENTS = [
    # two addresses by two versions; one version lacks its frozen status
    '{"content":{"productId":"V1","status":"Published","materials":[{"partNumber":"P","naming":'
    '"N","materialType":"T","diagnosisAddresses":["1","2"],"ecuVersions":[{"hardwareVersion":"H",'
    '"softwareVersion":"S","hardwarePartNumber":"N1","frozenStatus":{"abbreviation":"F"}},'
    '{"hardwareVersion":"H2","softwareVersion":"S","hardwarePartNumber":"N1"}]},null]}}',
    '{"content":{"productId":"V2","status":"PUBLISHED","materials":[{"partNumber":"P"}]}}',
    '{"content":{"productId":"V3","status":"published","materials":[]}}',
    '{"content":{"productId":"V4","status":"published"}}',
    '{"content":{"productId":"V5","status":"draft","materials":[{"partNumber":"P"}]}}',
]


@pytest.fixture
def documents(spark):
    df = spark.createDataFrame([(d,) for d in DOCUMENTS], "d string")
    return df.select(F.from_json("d", schemas.BASELINE_DOCUMENT).alias("x")).select("x.*")


def test_flatten(documents):
    flat = baseline.flatten(documents)
    got = rows(
        flat.select("productId", "diagnosisAddresses", "hardwareVersion", "abbreviation")
    )
    assert got == [
        ("V1", "1", "H", "F"),
        ("V1", "1", "H2", None),
        ("V1", "2", "H", "F"),
        ("V1", "2", "H2", None),
        ("V2", None, None, None),
    ]
    assert baseline.complete_rows(flat).count() == 2
    assert baseline.rejected_rows(flat).count() == 3


def test_flatten_with_inferred_schemas(spark):
    """Inference types an empty material list as strings and knows only fields it saw."""

    def flat(*texts):
        schema = F.schema_of_json(F.lit(texts[0]))
        df = spark.createDataFrame([(t,) for t in texts], "d string")
        return baseline.flatten(df.select(F.from_json("d", schema).alias("x")).select("x.*"))

    start = '{"content":{"productId":"V1","status":"published","materials":'
    bare = flat(start + '["x"]}}')
    assert rows(bare) == [(None,) * 8 + ("V1",)]
    assert set(dict(bare.dtypes).values()) == {"string"}
    part = flat(
        start + '[{"partNumber":"P","naming":"N","materialType":"T",'
        '"diagnosisAddresses":["1"],"ecuVersions":[{"hardwareVersion":"H"}]}]}}'
    )
    assert rows(part) == [("P", "N", "T", "1", "H", None, None, None, "V1")]


def test_json_is_parsed_once_and_bad_texts_give_nulls(spark):
    texts = [DOCUMENTS[0], "junk", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    parsed = readers.parse_json_column(df, "d", schemas.BASELINE_DOCUMENT)
    assert rows(parsed.select("content.productId")) == [(None,), (None,), ("V1",)]
    kept = baseline.flatten(parsed)
    assert kept.count() == 4
    assert kept._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_first_seen_equals_merging_one_snapshot_after_the_other(spark, documents):
    keep = dates.Retention(15)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    dated = [documents.withColumn("snapshot_date", dates.as_date(d)) for d in days]
    stream = dated[1].unionByName(dated[2]).unionByName(dated[1])
    once = baseline.first_seen(stream, "2024-03-01", keep)
    table = baseline.first_seen(dated[1], "2024-03-01", keep)
    later = baseline.first_seen(dated[2], "2024-03-01", keep)
    table = merge.merged(later, table, schemas.BASELINE_KEYS, unique=True)
    assert rows(once) == rows(table)
    assert {r.validfrom for r in once.collect()} == {"2024-01-02"}
    opened = baseline.first_seen(
        stream, "2024-03-01", keep, opening=baseline.first_snapshot(stream)
    )
    assert {r.validfrom for r in opened.collect()} == {dates.BEGINNING_OF_TIME}


def test_validity(spark):
    df = spark.createDataFrame([(0,), (2,), (-1,), (None,)], "n int")
    got = [r[0] for r in df.select(baseline.validity(F.col("n"))).collect()]
    assert got == [True, False, None, None]


# --- dimensions ----------------------------------------------------------------------------


def test_all_dimensions_are_defined():
    assert len(dimensions.DIMENSIONS) == 28
    assert len({d.table_name for d in dimensions.DIMENSIONS}) == 28
    assert sum(d.by_brand for d in dimensions.DIMENSIONS) == 5


def test_covering_dimension():
    def parent(name):
        found = dimensions.covering(dimensions.BY_NAME[name], dimensions.DIMENSIONS)
        return found and found.name

    assert parent("dim_sw_version") == "dim_hw_sw_number"
    assert parent("dim_online_status") == "dim_source_system"
    assert parent("dim_factory_desc") == "dim_vehicle_model"
    assert parent("dim_main") is not None
    assert parent("dim_dfcc") is None
    assert parent("dim_fault_type") is None


def test_together_equals_one_by_one(spark):
    from fleetquill.catalog import queries

    sources = queries.dimension_sources(spark, "/root/testdata/sf0.001")
    chosen = [
        dimensions.BY_NAME[n]
        for n in ("dim_main", "dim_dfcc_hex", "dim_source_system", "dim_online_status")
    ]
    both = dimensions.build_together(chosen, sources)
    for d in chosen:
        mine = both.where(F.col("dimension") == d.name).select(*d.columns)
        assert rows(mine) == rows(dimensions.build(d, sources))


def test_early_distinct_changes_nothing(spark):
    import bench
    from fleetquill.catalog.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    late = bench.late_distinct(spark, sf_dir)
    assert rows(late) == rows(QUERIES["dim_fault_type"](spark, sf_dir))


# --- files -----------------------------------------------------------------------------------


def _listing(spark, paths):
    day = dt.datetime(2024, 1, 1)
    data = [(p, day + dt.timedelta(hours=i)) for i, p in enumerate(paths)]
    return spark.createDataFrame(data, "path string, modified_at timestamp")


def test_pattern_filter_keeps_two_of_four(spark):
    df = spark.createDataFrame([("a.csv",), ("b.txt",), ("c.csv",), ("d",)], "target_file string")
    assert listing.matching_names(df, r"\.csv").count() == 2


def test_select_objects(spark):
    df = _listing(spark, ["a/1.csv", "a/2.txt", "b/1.csv", "c/1.csv"])
    assert rows(listing.select_objects(df, ["a/", "c/"], ".csv").select("path")) == [
        ("a/1.csv",),
        ("c/1.csv",),
    ]
    assert listing.select_objects(df).count() == 4
    assert listing.select_objects(df, []).count() == 0


def test_move_plan_edges(spark):
    paths = ["core/2024-01-05/a", "core/2024-01-05/b.txt", "core/2024-01-05/dummy.csv"]
    paths += ["core/not-a-date/c.csv", "core/2024-01-05/d.csv"]
    plan = moves.move_plan(_listing(spark, paths), moves.MoveSettings(), "2024-03-01")
    got = rows(plan.select("source_file", "target_path", "target_file", "final_key"))
    assert got == [
        ("a", "core/2024/01/05/", "a.csv", "core/2024-03-01/a.csv"),
        ("b.txt", "core/2024/01/05/", "b.txt.csv", "core/2024-03-01/b.txt.csv"),
        ("c.csv", "core/not/a/date/", "c.csv", "core/2024-03-01/c.csv"),
        ("d.csv", "core/2024/01/05/", "d.csv", "core/2024-03-01/d.csv"),
    ]


def test_duplicate_versions_take_the_first_gaps(spark):
    inbox = ["core/2024-01-05/a", "core/2024-01-05/a.csv", "core/2024-01-06/a.csv"]
    inbox += ["core/2024-01-07/b.csv", "core/2024-01-07/b"]
    plan = moves.move_plan(_listing(spark, inbox), moves.MoveSettings(), "2024-03-01")
    base = "core/core_duplicates/"
    kept = [base + "2024/01/05/a.csv" + s for s in ("", "_0", "_2", "_01", "_x")]
    kept += [base + "2024/01/07/b.csv_0"]
    got = moves.duplicate_versions(plan, _listing(spark, kept))
    assert rows(got.select("path", "version")) == [
        ("core/2024-01-05/a", 1),
        ("core/2024-01-05/a.csv", 3),
        ("core/2024-01-06/a.csv", -1),
        ("core/2024-01-07/b", 1),
        ("core/2024-01-07/b.csv", -1),
    ]


def test_duplicate_versions_equal_brute_force(spark):
    """Many competing files and gappy versions against a loop over free numbers."""
    import random

    chance = random.Random(7)
    base = "core/core_duplicates/2024/01/05/"
    folders = ["2024-01-05", "2024/01/05", "2024-01/05", "2024/01-05"]
    inbox, kept, expected = [], [], {}
    for i in range(30):
        mine = [f"core/{f}/n{i}{e}" for f in folders for e in ("", ".csv")]
        mine = mine[: chance.randint(1, 8)]
        inbox += mine
        taken = {n for n in range(80) if chance.random() < 0.8}
        plain = chance.random() < 0.5
        kept += [f"{base}n{i}.csv_{n}" for n in taken]
        kept += [f"{base}n{i}.csv"] * plain
        free = iter(n for n in range(200) if n not in taken)
        for j, path in enumerate(mine):
            expected[path] = -1 if j == 0 and not plain else next(free)
    plan = moves.move_plan(_listing(spark, inbox), moves.MoveSettings(), "2024-03-01")
    got = moves.duplicate_versions(plan, _listing(spark, kept))
    assert {r.path: r.version for r in got.collect()} == expected


def test_strategies(spark):
    inbox = ["core/2024-01-05/a.csv", "core/2024-01-05/b.csv"]
    plan = moves.move_plan(_listing(spark, inbox), moves.MoveSettings(), "2024-03-01")
    landed = _listing(spark, ["core/2024/01/05/a.csv", "core/2024-03-01/b.csv"])
    kept = _listing(spark, ["core/core_duplicates/2024/01/05/a.csv"])

    def decide(strategy):
        done = moves.apply_strategy(plan, landed, kept, strategy)
        return rows(done.select("source_file", "action", "write_key"))

    moved = ("b.csv", "move", "core/2024-03-01/b.csv")
    folder = "core/core_duplicates/2024/01/05/"
    assert decide("skip") == [("a.csv", "skip", None), moved]
    assert decide("overwrite") == [("a.csv", "overwrite", folder + "a.csv"), moved]
    assert decide("version") == [("a.csv", "version", folder + "a.csv_0"), moved]
    with pytest.raises(ValueError):
        decide("rename")
    report = moves.move_report(moves.mark_duplicates(plan, landed)).first()
    assert (report.total, report.duplicates) == (2, 1)


def test_files_in_load_order(spark):
    df = _listing(spark, ["b", "a", "c"])
    watermark = F.lit(dt.datetime(2024, 1, 1, 1))
    ordered = listing.new_files_last(df, watermark)
    assert [(r.path, r.is_new) for r in ordered.collect()] == [
        ("a", False),
        ("b", False),
        ("c", True),
    ]
    only = listing.new_files_last(df, watermark, only_new=True)
    assert [r.path for r in only.collect()] == ["c"]
    with pytest.raises(FileNotFoundError):
        listing.require_files(df.limit(0), "nothing there")


# --- responses, log, maintenance ------------------------------------------------------------------


def test_triage(spark):
    data = [(200, "{}"), (200, "<p>"), (404, ""), (426, ""), (500, ""), (403, "{}")]
    data += [(399, "1"), (None, "junk")]
    df = spark.createDataFrame(data, "status int, body string")
    got = [r.outcome for r in responses.triage(df).collect()]
    assert got == ["ok", "invalid_json", *["skipped"] * 3, "error", "ok", "invalid_json"]
    report = responses.response_report(df).first()
    assert (report.ids, report.usable_ids, report.failed_ids) == (8, 5, 3)


def test_watermarks(spark):
    log = spark.createDataFrame(
        [
            ("a", dt.datetime(2024, 1, 2, 23)),
            ("a", dt.datetime(2024, 1, 5, 1)),
            ("b", dt.datetime(2024, 1, 3)),
        ],
        "table_name string, committed_at timestamp",
    )
    assert rows(load_log.latest_load(log)) == [("a", D(2024, 1, 5)), ("b", D(2024, 1, 3))]
    assert load_log.shared_watermark(log).first().watermark == D(2024, 1, 3)

    def effective(**how):
        wm = load_log.effective_watermark(dates.as_date("2024-01-03"), **how)
        return spark.range(1).select(wm.alias("w")).first().w

    assert effective() == D(2024, 1, 3)
    assert effective(explicit="2024-02-01") == D(2024, 2, 1)
    assert effective(explicit="2024-02-01", initial=F.lit(True)) == D(1600, 1, 1)


def test_maintenance_due(spark):
    control = [
        ("never", "p", 3, True, 7, None, None),
        ("today", "p", 3, True, 7, D(2024, 1, 7), None),
        ("later", "p", 4, True, 7, D(2024, 1, 7), None),
        ("off", "p", 1, False, 7, D(2024, 1, 1), None),
        ("unset", "p", 1, None, 7, D(2024, 1, 1), None),
    ]
    df = spark.createDataFrame(control, schemas.VACUUM_CONTROL)
    due = maintenance.due(df, "vacuum", "2024-01-10")
    assert rows(due.select("table_name")) == [("never",), ("today",)]


# --- merges, versions, counts at size ---------------------------------------------------------


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_an_ordinary_batch_is_not_shuffled_for_its_repeats(spark):
    keys = ["k"]
    target = spark.createDataFrame([("a",), ("b",)], "k string")
    updates = spark.createDataFrame([("b",), ("c",), ("c",), (None,), (None,)], "k string")
    new = merge.new_rows(updates, target, keys)
    assert rows(new) == [(None,), (None,), ("c",), ("c",)]
    assert "REPARTITION" not in final_plan(new)
    many = merge.new_rows(updates.union(spark.range(1000).select(F.lit("d"))), target, keys)
    assert many.groupBy("k").count().where("k = 'd'").first()["count"] == 1000
    assert "REPARTITION" in final_plan(many)


def test_versions_of_a_name_with_a_million(spark):
    """Every tenth number is free; ten thousand files take the first of them in order."""
    taken = spark.range(1_000_000).where("id % 10 <> 3").select(F.concat(F.lit("dup/a.csv_"), "id").alias("path"))
    listed = taken.unionByName(spark.createDataFrame([("dup/a.csv",), ("dup/a.csv_007",), ("dup/b.csv_0",)], "path string"))
    plan = spark.range(10_000).select(
        F.format_string("in/%05d", "id").alias("path"),
        F.lit(dt.datetime(2024, 1, 1)).alias("modified_at"),
        F.lit("dup/a.csv").alias("duplicate_key"),
    )
    got = {r.path: r.version for r in moves.duplicate_versions(plan, listed).select("path", "version").collect()}
    assert got == {f"in/{k:05d}": 10 * k + 3 for k in range(10_000)}


def test_versions_equal_a_search_one_by_one(spark):
    draw = random.Random(6)
    names = [f"d/{c}.csv" for c in "abcde"]
    taken = {n: {draw.randrange(12) for _ in range(draw.randrange(14))} for n in names}
    taken["d/e.csv"] |= {moves.STRETCH - 1, moves.STRETCH, moves.STRETCH + 1}
    plain = {n for n in names if draw.random() < 0.6}
    listed = [(f"{n}_{v}",) for n in names for v in taken[n]] + [(n,) for n in plain]
    plan = [(f"in/{k}", dt.datetime(2024, 1, 1 + draw.randrange(9)), draw.choice(names)) for k in range(60)]
    want = {}
    for path, _, name in sorted(plan, key=lambda p: (p[1], p[0])):
        if name not in plain:
            plain.add(name)
            want[path] = -1
            continue
        want[path] = next(v for v in range(100) if v not in taken[name])
        taken[name].add(want[path])
    df = spark.createDataFrame(plan, "path string, modified_at timestamp, duplicate_key string")
    numbered = moves.duplicate_versions(df, spark.createDataFrame(listed, "path string"))
    assert {r.path: r.version for r in numbered.collect()} == want


def test_counts_read_the_bridge_once_and_covered_dimensions_from_wider_ones(spark):
    sources = queries.dimension_sources(spark, "/root/testdata/sf0.001")
    counts = dimensions.distinct_counts(dimensions.DIMENSIONS, sources)
    got = {r["dimension"]: r["tuples"] for r in counts.collect()}
    some = ["dim_main", "dim_ecu_name", "dim_online_status", "dim_factory_desc", "dim_mis_label", "dim_zp8_date"]
    assert {n: got[n] for n in some} == {n: dimensions.build(dimensions.BY_NAME[n], sources).count() for n in some}
    assert set(got) == set(dimensions.BY_NAME)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    fact = next(line for line in plan.splitlines() if "Expand" in line and "dfcc" in line)
    assert fact.count("[") - 2 <= 14, "one projection for every dimension that no other covers"
    assert plan.count("Join Inner, (model_key_3") == 1


def test_counts_shuffle_rows_of_the_source_once_and_counted_rows_as_counts(spark):
    sources = queries.dimension_sources(spark, "/root/testdata/sf0.001")
    fact = sources[dimensions.ERROR_FACT]
    nothing = spark.range(2).select(*[F.lit(None).cast(t).alias(c) for c, t in fact.dtypes])
    sources[dimensions.ERROR_FACT] = fact.unionByName(nothing)
    counts = dimensions.distinct_counts(dimensions.DIMENSIONS, sources)
    got = {r["dimension"]: r["tuples"] for r in counts.collect()}
    some = ["dim_main", "dim_ecu_name", "dim_source_system", "dim_sw_version", "dim_dtc", "dim_fault_type"]
    assert {n: got[n] for n in some} == {n: dimensions.build(dimensions.BY_NAME[n], sources).count() for n in some}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [model_desc" in plan
    levels = [line for line in plan.split("Union")[0].splitlines() if "Aggregate" in line]
    assert len(levels) >= 2
    assert not any("dtc#" in line for line in levels), "no cut dimension holds it"

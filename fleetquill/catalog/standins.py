"""Stand-ins for the operators' inputs, derived by Spark from the test tables.

Every stand-in covers its tables whole, so work grows with them. The same mappings
are spelled in SQL in `oracle.py`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.plans import staging
from fleetquill.sources import files

# Fixed dates of the examples; a run never depends on the current day.
LOAD_DATE = "2024-03-01"
EARLIER_LOAD_DATE = "2024-02-01"


# Bytes of order and line files that one task of a join is dealt. By the bytes it shuffles,
# AQE would leave a task several times as many rows, which it sorts and makes distinct.
TASK_BYTES = 8 << 20
# Inputs of fewer tasks are left to Spark.
LEAST_TASKS = 16
# Bytes of order and line files that one slice of a job in slices takes, and the most slices,
# as each of them reads its input whole.
SLICE_BYTES = 128 << 20
MOST_SLICES = 16

# Columns of placed orders and of order lines that the stand-ins below are made of.
ORDER_COLUMNS = (
    "o_orderkey o_orderstatus o_orderdate o_orderpriority brand delivery_region_de "
    "delivery_country_de"
).split()
ITEM_COLUMNS = (
    "l_partkey l_suppkey l_linenumber l_quantity l_returnflag l_linestatus l_shipdate "
    "p_type p_size p_brand p_name"
).split() + ORDER_COLUMNS[1:]


# Declared, so that planning a query reads no footers.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _size(spark: SparkSession, sf_dir: str, *names: str) -> int:
    return sum(files.size(spark, f"{sf_dir}/{name}.parquet") for name in names)


def slices(spark: SparkSession, sf_dir: str) -> int:
    """Slices for a job over orders and their lines, so that a part of it is on disk at once."""
    size = _size(spark, sf_dir, "lineitem", "orders")
    return max(1, min(MOST_SLICES, size // SLICE_BYTES))


def _dealt(df: DataFrame, sf_dir: str, key: str, *names: str, of: int = 1) -> DataFrame:
    """The smaller side of a join by ``key``, dealt to as many tasks as the given tables
    need, or one of ``of`` slices of them. The number then grows with them, and the larger
    side is dealt alike."""
    spark = df.sparkSession
    tasks = _size(spark, sf_dir, *names) // of // TASK_BYTES
    if tasks < LEAST_TASKS:
        return df
    return df.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer key with brand, delivery country and region."""
    country = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(country, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.col("c_mktsegment").alias("brand"),
            F.col("r_name").alias("delivery_region_de"),
            F.col("n_name").alias("delivery_country_de"),
        )
    )


def _placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _dealt(_places(spark, sf_dir), sf_dir, "c_custkey", "orders")
    return table(spark, sf_dir, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))


def _items(
    spark: SparkSession,
    sf_dir: str,
    placed: DataFrame | None = None,
    number: int = 0,
    of: int = 1,
) -> DataFrame:
    """Order lines with order, place and part: orders meet customers first, so the
    large table is shuffled for two joins only. With ``of`` slices, the lines of one."""
    both = ("lineitem", "orders")
    placed = _placed_orders(spark, sf_dir) if placed is None else placed
    some = staging.in_slice(placed, ["o_orderkey"], number, of)
    lines = staging.in_slice(table(spark, sf_dir, "lineitem"), ["l_orderkey"], number, of)
    orders = _dealt(some, sf_dir, "o_orderkey", *both, of=of)
    parts = _dealt(table(spark, sf_dir, "part"), sf_dir, "p_partkey", *both, of=of)
    met = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return met.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def staged(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Placed orders and order lines as stored tables for stand-ins that are read often."""
    of = slices(spark, sf_dir)
    with staging.shuffles_freed(spark):
        placed = _placed_orders(spark, sf_dir).select(*ORDER_COLUMNS)
        placed = staging.stage(placed, f"{folder}/orders")
        parts = (_items(spark, sf_dir, placed, n, of).select(*ITEM_COLUMNS) for n in range(of))
        return placed, staging.stage_parts(parts, f"{folder}/items")


def _factory(key: str) -> Column:
    return F.concat(F.lit("F"), (F.col(key) % 4).cast("string"))


def error_fact(
    spark: SparkSession, sf_dir: str, items: DataFrame | None = None
) -> DataFrame:
    items = _items(spark, sf_dir) if items is None else items
    return items.select(
        F.col("p_type").alias("model_desc"),
        "brand",
        _factory("l_suppkey").alias("factory_name"),
        "delivery_region_de",
        "delivery_country_de",
        F.col("p_size").alias("model_key_3"),
        F.col("l_returnflag").alias("diagnosis_address"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("diagnosis_address_text"),
        (F.col("l_partkey") % 500).cast("string").alias("dfcc"),
        F.col("l_suppkey").alias("dtc"),
        F.to_date("l_shipdate").alias("ecu_production_date_cur"),
        F.col("p_brand").alias("factory_desc"),
        F.col("p_name").alias("vehicle_model_de"),
        F.col("l_linenumber").alias("sw_version"),
        F.concat(F.lit("M"), (F.col("l_suppkey") % 10).cast("string")).alias(
            "manufacturer_name_concat"
        ),
        (F.col("l_partkey") % 50).alias("hw_part_number"),
        F.col("l_linenumber").alias("hw_version"),
        F.col("l_suppkey").alias("hw_spare_part_number"),
        F.col("l_quantity").cast("int").alias("id_software_version"),
        F.col("o_orderstatus").alias("maturity_level"),
        F.col("l_returnflag").alias("online_status"),
        F.col("o_orderpriority").alias("source_system"),
        F.year("o_orderdate").alias("model_year"),
        (F.col("l_linestatus") == "O").alias("pivot_event_flag"),
    )


def complaint_daily(
    spark: SparkSession, sf_dir: str, items: DataFrame | None = None
) -> DataFrame:
    items = _items(spark, sf_dir) if items is None else items
    return items.select(
        F.col("p_size").alias("model_key_3"),
        "brand",
        _factory("l_suppkey").alias("factory_name"),
        "delivery_region_de",
        "delivery_country_de",
        F.concat_ws(" ", "p_name", "o_orderstatus").alias("workshop_description_short"),
        F.col("o_orderpriority").alias("repair_shop_fault_type_group"),
        F.col("l_returnflag").alias("repair_shop_fault_type"),
        F.col("p_brand").alias("repair_shop_fault_object_main_group"),
        F.col("p_name").alias("repair_shop_fault_object_detail"),
        F.concat_ws(" ", "p_name", "o_orderpriority").alias("customer_complaint_text"),
        F.col("o_orderstatus").alias("customer_fault_object_main_group"),
        F.to_date("l_shipdate").alias("complaint_date"),
        F.to_date("o_orderdate").alias("delivery_date"),
    )


def vehicle_extended(
    spark: SparkSession, sf_dir: str, placed: DataFrame | None = None
) -> DataFrame:
    placed = _placed_orders(spark, sf_dir) if placed is None else placed
    return placed.select(
        (F.col("o_orderkey") % 50 + 1).cast("int").alias("model_key_3"),
        "brand",
        F.to_date("o_orderdate").alias("zp8_date"),
        _factory("o_orderkey").alias("factory_name"),
        "delivery_region_de",
        "delivery_country_de",
    )


# --- core master data from part ----------------------------------------------------


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def modprod_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_no and a `;` line; every eleventh part lacks its model year."""
    key = F.col("p_partkey")
    year = F.coalesce(
        _unless(key % 11 == 0, (1990 + F.col("p_size")).cast("string")), F.lit("")
    )
    line = F.concat_ws(";", "p_name", year, "p_brand", "p_type")
    return table(spark, sf_dir, "part").select(
        F.expr("p_partkey div 50").alias("file_no"), "p_partkey", line.alias("line")
    )


def modkpb_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for project codes; every eleventh part lacks its code."""
    key = F.col("p_partkey")
    code = F.coalesce(
        _unless(key % 11 == 0, F.concat(F.lit("K"), F.col("p_size").cast("string"))),
        F.lit(""),
    )
    line = F.concat_ws(";", "p_name", "p_brand", "p_type", code)
    return table(spark, sf_dir, "part").select(
        F.expr("p_partkey div 50").alias("file_no"), "p_partkey", line.alias("line")
    )


def stored_core(spark: SparkSession, sf_dir: str, table_class: str) -> DataFrame:
    """A core table before the merge: a third of the rows differ in product, every
    second one was loaded earlier."""
    lines = {"modprod": modprod_lines, "modkpb": modkpb_lines}[table_class]
    _, names = schemas.CORE_CLASSES[table_class]
    key = F.col("p_partkey")
    fields = F.split("line", ";")
    product = names.index("Product")
    columns = [F.nullif(F.get(fields, i), F.lit("")) for i in range(len(names))]
    columns[product] = F.when(
        key % 3 == 0, F.concat(columns[product], F.lit(" old"))
    ).otherwise(columns[product])
    loaded = F.when(key % 2 == 0, F.lit(LOAD_DATE)).otherwise(F.lit(EARLIER_LOAD_DATE))
    day = loaded.cast("date")
    return lines(spark, sf_dir).select(
        *[c.alias(n) for c, n in zip(columns, names)],
        day.alias("Load_Date"),
        F.add_months(day, 180).alias("KSU_LOESCH_DATUM"),
    )


def sales_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with one dated range and one single year, e.g. `ZA (2011 - 2013), ZB (2001)`."""
    first = (2000 + F.col("p_size")).cast("string")
    last = (2000 + F.col("p_size") + F.col("p_partkey") % 4).cast("string")
    single = (1990 + F.col("p_size")).cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Produkt"),
        F.col("p_name").alias("Beschreibung"),
        F.col("p_brand").alias("Produkttyp"),
        F.concat(
            F.lit("ZA ("), first, F.lit(" - "), last, F.lit("), ZB ("), single, F.lit(")")
        ).alias("Vertriebliche_Klasse"),
        F.lit(LOAD_DATE).cast("date").alias("Load_Date"),
        F.add_months(F.lit(LOAD_DATE).cast("date"), 180).alias("KSU_LOESCH_DATUM"),
    )


def interface_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless lines with a sixth column nobody names; some product ids are empty."""
    product = F.when(F.col("p_partkey") % 13 == 0, F.lit("")).otherwise(
        F.concat(F.lit("V"), (F.col("p_partkey") % 700).cast("string"))
    )
    return table(spark, sf_dir, "part").select(
        F.concat_ws(
            ";",
            "p_name",
            (1990 + F.col("p_size")).cast("string"),
            "p_brand",
            product,
            "p_type",
            F.lit("x"),
        ).alias("line")
    )


def _file_kind(number: Column) -> Column:
    return number % 5


def core_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of delivered files, fifty parts to a file: path, position, line.

    By file number: model-product, model-project code, swapped columns, lower-case
    header, one column too many. Position 0 is the header.
    """
    file_no = F.expr("p_partkey div 50")
    kind = _file_kind(file_no)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (file_no % 20).cast("int"))
    path = F.concat(
        F.lit("core/"), day.cast("string"), F.lit("/F"), file_no.cast("string")
    )
    year = (1990 + F.col("p_size")).cast("string")
    code = F.concat(F.lit("K"), F.col("p_size").cast("string"))
    line = (
        F.when(kind == 0, F.concat_ws(";", "p_name", year, "p_brand", "p_type"))
        .when(kind == 1, F.concat_ws(";", "p_name", "p_brand", "p_type", code))
        .when(kind == 2, F.concat_ws(";", year, "p_name", "p_brand", "p_type"))
        .when(kind == 3, F.concat_ws(";", "p_name", year, "p_brand", "p_type"))
        .otherwise(F.concat_ws(";", "p_name", year, "p_brand", "p_type", code))
    )
    header = (
        F.when(F.col("kind") == 0, F.lit("MODEL;MODEL_YEAR;SALES_CLASS;PRODUCT"))
        .when(F.col("kind") == 1, F.lit("MODEL;SALES_CLASS;PRODUCT;KPB"))
        .when(F.col("kind") == 2, F.lit("MODEL_YEAR;MODEL;SALES_CLASS;PRODUCT"))
        .when(F.col("kind") == 3, F.lit("model;model_year;sales_class;product"))
        .otherwise(F.lit("MODEL;MODEL_YEAR;SALES_CLASS;PRODUCT;KPB"))
    )
    data = table(spark, sf_dir, "part").select(
        path.alias("path"),
        (F.col("p_partkey") % 50 + 1).alias("position"),
        line.alias("line"),
        kind.alias("kind"),
    )
    headers = (
        data.select("path", "kind")
        .distinct()
        .select("path", F.lit(0).cast("bigint").alias("position"), header.alias("line"))
    )
    return headers.unionByName(data.select("path", "position", "line"))


# --- baselines from conversations ----------------------------------------------------


def _version(number: Column, part: Column) -> Column:
    text = number.cast("string")
    frozen = F.when(
        number % 4 != 3,
        F.struct(
            F.concat(F.lit("F"), (number % 2).cast("string")).alias("abbreviation")
        ),
    )
    return F.struct(
        F.concat(F.lit("H"), text).alias("hardwareVersion"),
        F.concat(F.lit("S"), (number % 2).cast("string")).alias("softwareVersion"),
        F.concat(F.lit("N"), part.cast("string")).alias("hardwarePartNumber"),
        frozen.alias("frozenStatus"),
    )


def _material(number: Column) -> Column:
    versions = F.when(
        number % 7 != 6, F.array(_version(number, number), _version(number + 1, number))
    )
    return F.struct(
        F.concat(F.lit("P"), number.cast("string")).alias("partNumber"),
        F.concat_ws(": ", "role", "text").alias("naming"),
        F.concat(F.lit("T"), (number % 2).cast("string")).alias("materialType"),
        F.array(
            F.col("role"), F.concat(F.lit("A"), (number % 3).cast("string"))
        ).alias("diagnosisAddresses"),
        versions.alias("ecuVersions"),
    )


def baseline_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per conversation turn with snapshot date: two materials, the
    first of them twice in every seventh turn, none for every fifth conversation."""
    conversation, turn = F.col("conv_id"), F.col("turn")
    status = (
        F.when(conversation % 3 == 0, "Published")
        .when(conversation % 3 == 1, "PUBLISHED")
        .otherwise("draft")
    )
    both = F.array(_material(turn), _material(turn + 1))
    more = F.concat(both, F.when(turn % 7 == 1, F.slice(both, 1, 1)).otherwise(F.slice(both, 1, 0)))
    materials = F.when(conversation % 5 == 0, F.slice(both, 1, 0)).otherwise(more)
    content = F.struct(
        F.concat(F.lit("V"), conversation.cast("string")).alias("productId"),
        status.alias("status"),
        materials.alias("materials"),
    )
    offset = ((conversation + turn) % 4).cast("int")
    return table(spark, sf_dir, "conversations").select(
        F.date_add(F.lit("2024-01-01").cast("date"), offset).alias("snapshot_date"),
        F.to_json(F.struct(content.alias("content"))).alias("document"),
    )


# --- listings and responses from pages -------------------------------------------------


def inbox_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inbox objects: three neighbouring pages share a name in different folders."""
    key = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int"))
    folder = F.when(key % 17 == 0, F.lit("not-a-date")).otherwise(day.cast("string"))
    ending = (
        F.when(key % 4 == 0, ".csv")
        .when(key % 4 == 1, "")
        .when(key % 4 == 2, ".txt")
        .otherwise(F.when(key % 5 == 0, ".dummy.csv").otherwise(".csv"))
    )
    name = F.concat(F.lit("Q"), F.expr("page_id div 3").cast("string"), ending)
    changed = F.date_add(F.lit("2024-01-01").cast("date"), (key % 45).cast("int"))
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("core/"), folder, F.lit("/"), name).alias("path"),
        changed.alias("modified_at"),
        F.length("html").cast("bigint").alias("size"),
    )


def landing_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects landed before: the names of even pages, in their days' folders, and the
    even names in today's folder."""
    key = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int"))
    folder = F.replace(day.cast("string"), F.lit("-"), F.lit("/"))
    name = F.concat(F.lit("Q"), F.expr("page_id div 3").cast("string"), F.lit(".csv"))
    dated = F.when(key % 2 == 0, F.concat(F.lit("core/"), folder, F.lit("/"), name))
    today = F.concat(F.lit(f"core/{LOAD_DATE}/Q"), (key * 2).cast("string"), F.lit(".csv"))
    listed = table(spark, sf_dir, "pages").select(F.explode(F.array(dated, today)).alias("path"))
    return listed.where(F.col("path").isNotNull()).distinct()


def duplicates_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates folder: names of pages with, by page, no, `_0`, `_2` or `_01` suffix."""
    key = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int"))
    folder = F.replace(day.cast("string"), F.lit("-"), F.lit("/"))
    name = F.concat(F.lit("Q"), F.expr("page_id div 3").cast("string"))
    suffixes = F.array(
        F.lit(""),
        F.when(key % 2 == 0, "_0").otherwise("_1"),
        F.when(key % 5 == 0, "_2").otherwise("_01"),
    )
    plain = F.concat(
        F.lit("core/core_duplicates/"), folder, F.lit("/"), name, F.lit(".csv")
    )
    return table(spark, sf_dir, "pages").select(
        F.explode(F.transform(suffixes, lambda s: F.concat(plain, s))).alias("path")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw responses: JSON around the whole page for even pages, the bare page else."""
    key = F.col("page_id")
    status = (
        F.when(key % 7 == 0, 404)
        .when(key % 7 == 1, 500)
        .when(key % 7 == 2, 403)
        .when(key % 7 == 3, 426)
        .otherwise(200)
    )
    body = F.when(key % 2 == 0, F.to_json(F.struct("url", "html"))).otherwise(
        F.col("html")
    )
    return table(spark, sf_dir, "pages").select(
        "url",
        F.concat(F.lit("u"), key.cast("string")).alias("uuid"),
        F.concat(F.lit("V"), (key % 50).cast("string")).alias("product_id"),
        status.alias("status"),
        body.alias("body"),
    )


def overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overview documents with zero to three uuids."""
    key = F.col("page_id")
    some = F.slice(F.array(*[F.lit(i) for i in range(3)]), F.lit(1), (key % 4).cast("int"))
    items = F.transform(
        some,
        lambda i: F.struct(
            F.concat(
                F.lit("u"), key.cast("string"), F.lit("-"), i.cast("string")
            ).alias("uuid")
        ),
    )
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("V"), key.cast("string")).alias("product_id"),
        F.to_json(F.struct(items.alias("content"))).alias("body"),
    )


# --- control tables ---------------------------------------------------------------------


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), F.col("ts").alias("committed_at")
    )


def maintenance_control(spark: SparkSession, sf_dir: str, task: str = "vacuum") -> DataFrame:
    """Control table of one task; only vacuum keeps files for a retention time."""
    key = F.col("s_suppkey")
    last = F.date_add(F.lit("2024-01-01").cast("date"), (key % 40).cast("int"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("table_name"),
        F.concat(F.lit("tables/"), "s_name").alias("s3_table_path"),
        (key % 30).cast("int").alias("days"),
        (key % 5 != 0).alias(f"{task}_flag"),
        *([F.lit(7).alias("retention_days")] if task == "vacuum" else []),
        F.when(key % 7 != 0, last).alias(f"{task}_last_run"),
        F.lit(None).cast("date").alias(f"{task}_next_run"),
    )

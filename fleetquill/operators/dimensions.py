"""Filter dimensions: distinct attribute rows for dashboard filters.

All of them are one shape, so they are data (`DIMENSIONS`) and one builder.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.functions import dates, text

ERROR_FACT = "error_fact"
COMPLAINTS = "complaint_daily"
VEHICLES = "vehicle_extended"

KEY = "model_key_3"
# Columns every dimension carries; model_desc comes from the bridge in joined ones.
PLACE = ["brand", "factory_name", "delivery_region_de", "delivery_country_de"]
BASE = ["model_desc", *PLACE]


@dataclass(frozen=True)
class Dimension:
    """One filter dimension: what it holds besides `BASE` and how it is laid out."""

    name: str
    attributes: tuple[str, ...] = ()
    source: str = ERROR_FACT
    by_brand: bool = False
    cluster: str | None = None
    table: str = ""

    @property
    def columns(self) -> list[str]:
        return [*self.attributes, *BASE]

    @property
    def sources(self) -> list[str]:
        """Sources it is built from: a joined one also needs the fact for its bridge."""
        return list(dict.fromkeys([self.source, ERROR_FACT]))

    @property
    def table_name(self) -> str:
        return self.table or f"error_recovery_by_{self.name.removeprefix('dim_')}"


def _d(name: str, *attributes: str, **layout) -> Dimension:
    return Dimension(f"dim_{name}", attributes, **layout)


# The names of the written tables are fixed values where they differ from the key.
DIMENSIONS: tuple[Dimension, ...] = (
    _d("main", table="error_recovery_main"),
    _d("dfcc", "dfcc", "ecu_name"),
    _d("ecu_name", "ecu_name"),
    _d(
        "ecu_production_date",
        "ecu_production_date_cur",
        "ecu_name",
        table="error_recovery_by_ecu_production_date_cur",
    ),
    _d("factory_desc", "factory_desc"),
    _d(
        "hw_sw_number",
        "ecu_name",
        "sw_version",
        "manufacturer_name_concat",
        "hw_part_number",
        by_brand=True,
        table="error_recovery_by_ecu_name_hw_sw_number",
    ),
    _d("id_software_version", "id_software_version"),
    _d(
        "manufacturer",
        "manufacturer_name_concat",
        table="error_recovery_by_manufacturer_name_concat",
    ),
    _d("maturity_level", "maturity_level"),
    _d("online_status", "online_status"),
    _d("source_system", "source_system", "online_status"),
    _d("model_year", "model_year"),
    _d("dtc", "dtc", "ecu_name", by_brand=True, cluster="ecu_name"),
    _d("dfcc_hex", "dfcc_hex", "ecu_name", by_brand=True, cluster="ecu_name"),
    _d("hw_version", "hw_version", "ecu_name"),
    _d(
        "hw_spare_part",
        "hw_spare_part_number",
        "ecu_name",
        table="error_recovery_by_hw_spare_part_number",
    ),
    _d("pivot_event_flag", "pivot_event_flag", "ecu_name"),
    _d(
        "vehicle_model",
        "vehicle_model_de",
        "factory_desc",
        table="error_recovery_by_Modell",
    ),
    _d("sw_version", "ecu_name", "sw_version"),
    _d("zp8_date", KEY, "zp8_date_start", "zp8_date_end", source=VEHICLES),
    _d(
        "workshop_description",
        "workshop_description_short",
        source=COMPLAINTS,
        by_brand=True,
        cluster="model_desc",
        table="error_recovery_by_workshop_description_short",
    ),
    _d(
        "fault_type_group",
        "repair_shop_fault_type_group",
        source=COMPLAINTS,
        table="error_recovery_by_repair_shop_fault_type_group",
    ),
    _d("mis_label", "mis_label", "months_diff", source=COMPLAINTS),
    _d(
        "fault_type",
        "repair_shop_fault_type",
        source=COMPLAINTS,
        table="error_recovery_by_repair_shop_fault_type",
    ),
    _d(
        "fault_object_main",
        "repair_shop_fault_object_main_group",
        source=COMPLAINTS,
        table="error_recovery_by_repair_shop_fault_object_main_group",
    ),
    _d(
        "fault_object_detail",
        "repair_shop_fault_object_detail",
        source=COMPLAINTS,
        table="error_recovery_by_repair_shop_fault_object_detail",
    ),
    _d(
        "complaint_text",
        "customer_complaint_text",
        source=COMPLAINTS,
        by_brand=True,
        cluster="model_desc",
        table="error_recovery_by_customer_complaint_text",
    ),
    _d(
        "customer_fault_object",
        "customer_fault_object_main_group",
        source=COMPLAINTS,
        table="error_recovery_by_customer_fault_object_main_group",
    ),
)
BY_NAME: dict[str, Dimension] = {d.name: d for d in DIMENSIONS}


def derived_columns(known: Iterable[str] = ()) -> dict[str, Column]:
    """Columns no source holds; each is computed from the source that has its parts, or
    from the months in service where these are ``known``."""
    months = F.col("months_diff")
    if "months_diff" not in known:
        months = dates.months_in_service(F.col("complaint_date"), F.col("delivery_date"))
    return {
        "ecu_name": text.ecu_name(
            F.col("diagnosis_address"), F.col("diagnosis_address_text")
        ),
        "dfcc_hex": text.dfcc_hex(F.col("dfcc")),
        "months_diff": months,
        "mis_label": dates.mis_label(months),
        "zp8_date_start": F.col("zp8_date").cast("string"),
        "zp8_date_end": F.col("zp8_date").cast("string"),
    }


def _pick(source: DataFrame, columns: Iterable[str]) -> DataFrame:
    derived = derived_columns(source.columns)
    return source.select(
        *[
            derived[c].alias(c) if c in derived and c not in source.columns else F.col(c)
            for c in columns
        ]
    )


def model_bridge(error_fact: DataFrame) -> DataFrame:
    """Distinct (model_key_3, model_desc): leads from complaints to model names."""
    return error_fact.select(KEY, "model_desc").distinct()


def _unjoined(dimension: Dimension) -> list[str]:
    """Columns the complaint or vehicle side contributes, join key first."""
    own = [c for c in dimension.attributes if c != KEY]
    return [KEY, *own, *PLACE]


# Texts that one other column determines, so that only that one is shuffled.
TEXT_OF = {"zp8_date_start": "zp8_date", "zp8_date_end": "zp8_date", "mis_label": "months_diff"}


def _carried(columns: Iterable[str]) -> list[str]:
    """The columns that have to be shuffled to know all of the given ones."""
    return list(dict.fromkeys(TEXT_OF.get(c, c) for c in columns))


def build(dimension: Dimension, sources: Mapping[str, DataFrame]) -> DataFrame:
    """One dimension. ``sources`` maps source names to their DataFrames.

    A joined dimension is made distinct before the join as well: the result is the
    same set, but repeated complaints meet the bridge once, and a key that holds a
    large share of them is reduced map-side. Whether the bridge is broadcast is left
    to AQE, which knows its real size and splits skewed keys otherwise.
    """
    source = sources[dimension.source]
    if dimension.source == ERROR_FACT:
        return _pick(source, dimension.columns).distinct()
    bridge = sources.get("model_bridge")
    if bridge is None:
        bridge = model_bridge(sources[ERROR_FACT])
    reduced = _pick(source, _carried(_unjoined(dimension))).distinct()
    joined = reduced.join(bridge, KEY).select(*_carried(dimension.columns))
    if KEY not in dimension.columns:  # with it, distinct sides gave distinct rows
        joined = joined.distinct()
    return _pick(joined, dimension.columns)


def covering(
    dimension: Dimension, others: Sequence[Dimension]
) -> Dimension | None:
    """The narrowest other dimension of the same source that holds all its columns.

    Distinct rows of that one's rows are the dimension, so the source need not be
    read for it.
    """
    wider = [
        d
        for d in others
        if d.source == dimension.source
        and set(d.attributes) > set(dimension.attributes)
    ]
    return min(wider, key=lambda d: len(d.attributes), default=None)


def all_columns(dimensions: Sequence[Dimension]) -> list[str]:
    """Every column of the given dimensions once, `BASE` first."""
    seen = dict.fromkeys(BASE)
    for dimension in dimensions:
        seen.update(dict.fromkeys(dimension.attributes))
    return list(seen)


def _met(source: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """A source's rows dealt by the columns that all of several subsets hold.

    Every row goes into each subset, so from three on they meet first: a task then reduces
    a subset to little more than its distinct rows before these are shuffled. AQE splits a
    share that is too large; what meets late is still made distinct.
    """
    if len(sets) < 3:
        return source
    kept = [set(columns) for columns in sets.values()]
    return source.hint("rebalance", *[c for c in (KEY, *BASE) if all(c in k for k in kept)])


def _distinct_sets(
    df: DataFrame, sets: Mapping[str, Sequence[str]], columns: Sequence[str]
) -> DataFrame:
    """Distinct rows of several column subsets in one pass, labelled by subset name.

    Grouping sets leave null in the columns outside a subset. The subsets must differ.
    """
    # Bit of a column in the grouping id: first column highest, set when grouped away.
    ids = {
        sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in kept): n
        for n, kept in sets.items()
    }
    name = F.lit(None).cast("string")
    for gid, label in ids.items():
        name = F.when(F.col("_gid") == gid, F.lit(label)).otherwise(name)
    groups = [[F.col(c) for c in columns if c in kept] for kept in sets.values()]
    return (
        df.groupingSets(groups, *[F.col(c) for c in columns])
        .agg(F.grouping_id().alias("_gid"))
        .select(name.alias("dimension"), *columns)
    )


def build_together(
    dimensions: Sequence[Dimension], sources: Mapping[str, DataFrame]
) -> DataFrame:
    """All dimensions of one source as one DataFrame with a ``dimension`` label.

    The source is read once and shuffled once instead of once per dimension; rows are
    reduced map-side per dimension before the shuffle.
    """
    (source_name,) = {d.source for d in dimensions}
    if source_name != ERROR_FACT:
        return joined_together(dimensions, sources)
    columns = all_columns(dimensions)
    sets = {d.name: d.columns for d in dimensions}
    return _distinct_sets(_pick(_met(sources[source_name], sets), columns), sets, columns)


def joined_together(
    dimensions: Sequence[Dimension], sources: Mapping[str, DataFrame]
) -> DataFrame:
    """The same for joined dimensions of any sources: each source is reduced by itself, and
    one join leads all of them to the model names."""
    bridge = sources.get("model_bridge")
    if bridge is None:
        bridge = model_bridge(sources[ERROR_FACT])
    columns = all_columns(dimensions)
    parts = []
    for source in dict.fromkeys(d.source for d in dimensions):
        mine = [d for d in dimensions if d.source == source]
        own = [c for c in all_columns(mine) if c not in ("model_desc", KEY)]
        sets = {d.name: _unjoined(d) for d in mine}
        rows = _pick(_met(sources[source], sets), [KEY, *own])
        parts.append(_distinct_sets(rows, sets, [KEY, *own]))
    reduced = parts[0]
    for part in parts[1:]:
        reduced = reduced.unionByName(part, allowMissingColumns=True)
    shown = [c for c in columns if c != KEY]
    if len(dimensions) > 2:  # keys of one tuple meet, so that the join's copies go in its task
        reduced = reduced.hint("rebalance", "dimension", *[c for c in shown if c != "model_desc"])
    shows_key = [d.name for d in dimensions if KEY in d.columns]
    key = F.when(F.col("dimension").isin(shows_key), F.col(KEY)).alias(KEY)
    found = reduced.join(bridge, KEY).select("dimension", *shown, *([key] if shows_key else []))
    return found.select("dimension", *columns).distinct()


def _counted(
    rows: DataFrame, dimension: str | None, kept: Iterable[str], columns: Sequence[str]
) -> Column:
    """A row to count: with ``dimension`` it is cut to the kept columns of that one, without
    it stays in its dimension and is the same as all others there."""
    values = [
        (F.col(c) if c in kept else F.lit(None).cast(rows.schema[c].dataType)).alias(c)
        for c in columns
    ]
    label = F.col("dimension") if dimension is None else F.lit(dimension)
    tuples = F.col("tuples") if dimension is None else F.lit(None).cast("bigint")
    return F.struct(label.alias("dimension"), tuples.alias("tuples"), *values)


def distinct_counts(
    dimensions: Sequence[Dimension], sources: Mapping[str, DataFrame]
) -> DataFrame:
    """Row count of every dimension.

    A source is read and reduced for the dimensions that no other one covers. Those that
    are covered are cut from the rows of the narrowest that covers them, widest first, so
    each is counted from rows that are distinct already. Rows that are counted lose their
    columns, so only the cut ones are shuffled as such. Complaints and vehicles meet the
    bridge in one join.
    """
    covers = {d.name: covering(d, dimensions) for d in dimensions}
    roots = [d for d in dimensions if covers[d.name] is None]
    joined = [d for d in roots if d.source != ERROR_FACT]
    parts = []
    fact = [d for d in roots if d.source == ERROR_FACT]
    if fact:
        parts.append(build_together(fact, sources))
    if joined:
        parts.append(joined_together(joined, sources))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    # a row without a count is a tuple by itself, one with a count stands for so many
    rows = rows.withColumn("tuples", F.lit(1).cast("bigint"))
    depth = 0
    while True:  # as deep as dimensions cover each other, two levels today
        level = [d for d in dimensions if _depth(d, covers) == depth + 1]
        if not level:
            return rows.groupBy("dimension").agg(F.sum("tuples").alias("tuples"))
        columns = all_columns(level)
        narrower: dict[str, list[Dimension]] = {}
        for d in level:
            narrower.setdefault(covers[d.name].name, []).append(d)
        own = _counted(rows, None, (), columns)
        cut = F.array(own)
        for wider, mine in narrower.items():
            more = F.array(own, *[_counted(rows, d.name, d.columns, columns) for d in mine])
            cut = F.when(F.col("dimension") == wider, more).otherwise(cut)
        rows = (
            rows.select(F.inline(cut))
            .groupBy("dimension", *columns)
            .agg(F.coalesce(F.sum("tuples"), F.lit(1)).alias("tuples"))
        )
        depth += 1


def _depth(dimension: Dimension, covers: Mapping[str, Dimension | None]) -> int:
    """How many dimensions lie between one and the source."""
    wider = covers[dimension.name]
    return 0 if wider is None else 1 + _depth(wider, covers)

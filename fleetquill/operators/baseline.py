"""Vehicle baselines: nested documents to flat, complete, first-seen rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates, nested, text


def published(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Materials and product id of the published documents."""
    return (
        documents.where(text.is_published(F.col("content.status")))
        .select(
            *keep,
            F.col("content.productId").alias("productId"),
            F.col("content.materials").alias("materials"),
        )
    )


def explode_materials(baselines: DataFrame, distinct: bool = True) -> DataFrame:
    """Distinct materials; documents without materials and null materials go.

    A material that a document, or a copy of it, holds twice counts once. Without
    ``distinct`` it comes as often, for a caller that makes its own result distinct.
    """
    rest = [c for c in baselines.columns if c != "materials"]
    items = baselines.select(*rest, F.explode("materials").alias("materials_items"))
    items = items.where(F.col("materials_items").isNotNull())
    return items.distinct() if distinct else items


def _field(df: DataFrame, path: str, absent: str = "string") -> Column:
    """A nested field, or a typed null where an inferred schema lacks it."""
    if nested.find_path(df.schema, path) is None:
        return F.lit(None).cast(absent)
    return F.col(path)


def flatten_materials(materials: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every diagnosis address of a material with every of its ECU versions.

    A material without addresses or without versions stays, with nulls in their place.
    With an inferred schema, materials may be no structs and versions may lack fields;
    what is not there is null.
    """
    item = "materials_items"
    ecu = "ecuVersions_items"
    addresses = _field(materials, f"{item}.diagnosisAddresses", "array<string>")
    addressed = materials.select(
        *keep,
        "productId",
        _field(materials, f"{item}.partNumber").alias("partNumber"),
        _field(materials, f"{item}.naming").alias("naming"),
        _field(materials, f"{item}.materialType").alias("materialType"),
        _field(materials, f"{item}.ecuVersions", "array<string>").alias("ecuVersions"),
        F.explode_outer(addresses).alias("diagnosisAddresses"),
    )
    versioned = addressed.select(
        *[c for c in addressed.columns if c != "ecuVersions"],
        F.explode_outer("ecuVersions").alias(ecu),
    )
    return versioned.select(
        "partNumber",
        "naming",
        "materialType",
        "diagnosisAddresses",
        _field(versioned, f"{ecu}.hardwareVersion").alias("hardwareVersion"),
        _field(versioned, f"{ecu}.softwareVersion").alias("softwareVersion"),
        _field(versioned, f"{ecu}.hardwarePartNumber").alias("hardwarePartNumber"),
        _field(versioned, f"{ecu}.frozenStatus.abbreviation").alias("abbreviation"),
        "productId",
        *keep,
    )


def flatten(
    documents: DataFrame, keep: Sequence[str] = (), distinct: bool = True
) -> DataFrame:
    """Published documents to the nine baseline attributes."""
    materials = explode_materials(published(documents, keep), distinct)
    return flatten_materials(materials, keep)


def with_validity(
    flat: DataFrame,
    valid_from: Column,
    load_date: str | dt.date,
    retention: dates.Retention,
) -> DataFrame:
    """The stored columns: attributes, start of validity, deletion date."""
    deletion = retention.deletion_date(dates.as_date(load_date))
    return flat.withColumns(
        {"validfrom": valid_from, "KSU_LOESCH_DATUM": deletion}
    ).select(*schemas.BASELINE_COLUMNS)


def complete_rows(flat: DataFrame) -> DataFrame:
    """Rows without any null."""
    return flat.na.drop("any")


def rejected_rows(flat: DataFrame) -> DataFrame:
    """Rows the completeness rule leaves out, for audit."""
    anything_null = F.lit(False)
    for name in flat.columns:
        anything_null = anything_null | F.col(name).isNull()
    return flat.where(anything_null)


def first_snapshot(documents: DataFrame, snapshot: str = "snapshot_date") -> Column:
    """Earliest snapshot date of all documents, as a scalar subquery."""
    return documents.select(F.min(snapshot)).scalar()


def first_seen(
    documents: DataFrame,
    load_date: str | dt.date,
    retention: dates.Retention,
    snapshot: str = "snapshot_date",
    opening: Column | None = None,
) -> DataFrame:
    """Each attribute combination once, valid from the first snapshot that has it.

    This is what merging the snapshots one after the other leaves behind: the first
    one wins. It takes one aggregate instead of one merge per snapshot; the aggregate
    keeps a date, so it stays a hash aggregate with map-side reduction.

    ``opening`` is the snapshot that opens a new table; its rows are valid from the
    beginning of time.
    """
    flat = complete_rows(flatten(documents, [snapshot], distinct=False))
    first = flat.groupBy(*schemas.BASELINE_KEYS).agg(F.min(snapshot).alias("_first"))
    since = F.date_format("_first", "yyyy-MM-dd")
    if opening is not None:
        since = F.when(
            F.col("_first") == opening, F.lit(dates.BEGINNING_OF_TIME)
        ).otherwise(since)
    return with_validity(first, since, load_date, retention)


def validity(newer_baselines: Column) -> Column:
    """True without newer baselines, false with some, null when unknown."""
    return F.when(newer_baselines == 0, True).when(newer_baselines > 0, False)

"""Core master data: load dates, stored column names, sales-class normalization."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates, text

LOAD_DATE = "Load_Date"
DELETION_DATE = "KSU_LOESCH_DATUM"
# Names of delivered fields while only their position is known.
POSITIONS = ["_c0", "_c1", "_c2", "_c3"]


def load_dates(
    load_date: str | dt.date, retention: dates.Retention
) -> dict[str, Column]:
    """Load date of a batch and the date its rows are to be deleted, as literals."""
    day = dates.as_date(load_date)
    return {LOAD_DATE: day, DELETION_DATE: retention.deletion_date(day)}


def with_load_dates(
    df: DataFrame, load_date: str | dt.date, retention: dates.Retention
) -> DataFrame:
    return df.withColumns(load_dates(load_date, retention))


def stored_names(df: DataFrame, table_class: str, *keep: str) -> DataFrame:
    """Delivered columns in stored order under their stored names, not yet dated."""
    header, names = schemas.CORE_CLASSES[table_class]
    return df.select(
        *[F.col(old).alias(new) for old, new in zip(header, names)], *keep
    )


def to_stored(df: DataFrame, table_class: str) -> DataFrame:
    """A dated delivery as the table stores it."""
    return stored_names(df, table_class, LOAD_DATE, DELETION_DATE)


def name_by_class(fields: DataFrame) -> DataFrame:
    """Positional fields of mixed classes under stored names; a column that a row's
    class does not have is null."""
    named: dict[str, Column] = {}
    for table_class, (_, names) in schemas.CORE_CLASSES.items():
        for position, name in zip(POSITIONS, names):
            value = F.when(F.col("table_class") == table_class, F.col(position))
            named[name] = F.coalesce(named[name], value) if name in named else value
    rest = [c for c in fields.columns if c not in POSITIONS]
    return fields.select(*rest, *[v.alias(n) for n, v in named.items()])


def merge_keys(table_class: str) -> list[str]:
    """A core row is identified by all of its columns, load dates included."""
    return [LOAD_DATE, DELETION_DATE, *schemas.CORE_CLASSES[table_class][1]]


def sales_class_rows(df: DataFrame) -> DataFrame:
    """One row per sales-class entry with series, start year and end year."""
    entry = F.col("entry")
    return df.withColumn(
        "entry", F.explode(text.sales_class_entries(F.col("Vertriebliche_Klasse")))
    ).withColumns(
        {
            "series": text.entry_series(entry),
            "start_year": text.entry_start_year(entry),
            "end_year": text.entry_end_year(entry),
        }
    )


def expand_model_years(df: DataFrame) -> DataFrame:
    """One row per model year of [start_year, end_year)."""
    years = text.model_years(F.col("start_year"), F.col("end_year"))
    return df.withColumn("modelljahr", F.explode(years))


def normalize_sales_classes(df: DataFrame) -> DataFrame:
    """Sales-class master spread to one row per product, series and model year."""
    return expand_model_years(sales_class_rows(df)).select(
        "Produkt",
        "Beschreibung",
        "Produkttyp",
        "series",
        LOAD_DATE,
        DELETION_DATE,
        "modelljahr",
    )


def product_ids(interface: DataFrame) -> DataFrame:
    """Distinct product ids of the interface file, null left out."""
    return (
        interface.select(F.col("produktkennzeichen").alias("product_id"))
        .where(F.col("product_id").isNotNull())
        .distinct()
    )

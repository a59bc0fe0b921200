"""Inbox-to-landing move plans. Planning only: nothing here touches an object."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetquill.functions import text
from fleetquill.sources import listing as listings

# A name's taken version numbers are ranked in stretches of so many numbers.
STRETCH = 65536


@dataclass(frozen=True)
class MoveSettings:
    """Where files come from and go to."""

    source_bucket: str = "inbox"
    source_path: str = "core/"
    target_bucket: str = "landing"
    target_path: str = "core/"
    duplicates_path: str = "core/core_duplicates/"
    suffix: str = ".csv"
    file_pattern: str = r"\.csv"


def move_plan(
    listing: DataFrame, settings: MoveSettings, load_date: str | dt.date
) -> DataFrame:
    """One row per inbox file to be moved, with its landing key.

    ``duplicate_key`` is where the file goes when its landing key is taken.
    """
    below = text.key_below(F.col("path"), settings.source_path)
    folder = F.substring(below, 1, text.FOLDER_CHARS)
    source_file = F.substring(below, text.FOLDER_CHARS + 1, F.length("path"))
    planned = listings.without_dummies(listing).select(
        "path",
        "modified_at",
        F.lit(settings.source_bucket).alias("source_bucket"),
        F.concat(F.lit(settings.source_path), folder).alias("source_path"),
        source_file.alias("source_file"),
        F.lit(settings.target_bucket).alias("target_bucket"),
        F.replace(folder, F.lit("-"), F.lit("/")).alias("_folder"),
        text.with_suffix(source_file, settings.suffix).alias("target_file"),
    )
    matched = listings.matching_names(planned, settings.file_pattern)
    name = F.col("target_file")
    return matched.select(
        "path",
        "modified_at",
        "source_bucket",
        "source_path",
        "source_file",
        "target_bucket",
        F.concat(F.lit(settings.target_path), "_folder").alias("target_path"),
        "target_file",
        F.concat_ws(
            "/", F.lit(settings.target_path.rstrip("/")), F.lit(str(load_date)), name
        ).alias("final_key"),
        F.concat(F.lit(settings.duplicates_path), "_folder", name).alias(
            "duplicate_key"
        ),
    )


def _taken(df: DataFrame, existing: DataFrame, key: str, flag: str) -> DataFrame:
    """Add whether ``key`` is among the paths of a listing (paths are unique there)."""
    marked = existing.select(F.col("path").alias(key), F.lit(True).alias(flag))
    return df.join(marked, key, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def target_key() -> Column:
    """Target folder and file name: the key by which a file counts as landed before."""
    return F.concat("target_path", "target_file")


def mark_duplicates(
    plan: DataFrame, target: DataFrame, key: Column | None = None
) -> DataFrame:
    """Add ``is_duplicate``: the landing zone already has the file, by ``key``."""
    keyed = plan.withColumn("_key", target_key() if key is None else key)
    return _taken(keyed, target, "_key", "is_duplicate").drop("_key")


def taken_ranks(taken: DataFrame) -> DataFrame:
    """(duplicate_key, version, rank): how many smaller versions a name has.

    A name's versions are ranked within stretches of ``STRETCH`` numbers, to which the
    versions in the stretches before are added, so no task sees more than one stretch of
    a name however many versions it has.
    """
    stretch = F.floor(F.col("version") / STRETCH).alias("_stretch")
    placed = taken.select("duplicate_key", "version", stretch)
    sizes = placed.groupBy("duplicate_key", "_stretch").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("duplicate_key").orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "duplicate_key", "_stretch", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("duplicate_key", "_stretch").orderBy("version")
    return (
        placed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(offsets, ["duplicate_key", "_stretch"])
        .select("duplicate_key", "version", (F.col("_before") + F.col("_inside")).alias("rank"))
    )


def taken_versions(existing: DataFrame) -> DataFrame:
    """(duplicate_key, version) of a listing's ``<name>_<N>`` paths."""
    digits = F.regexp_extract("path", r"_([0-9]+)$", 1)
    return (
        existing.select(
            F.regexp_extract("path", r"^(.*)_[0-9]+$", 1).alias("duplicate_key"),
            digits.try_cast("bigint").alias("version"),
            digits.alias("_digits"),
        )
        .where(F.col("version").cast("string") == F.col("_digits"))
        .select("duplicate_key", "version")
    )


def free_versions(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """``wanted`` (duplicate_key, place, ...) and ``version``: of its name's free ``_N``
    numbers the one at its place, counted from 1.

    Below a taken number v of rank r lie v - r free ones, the same for all of an unbroken
    island of taken numbers. The free number with k free ones below it is k plus the taken
    numbers below it: those of the islands with a v - r of at most k. So the islands and
    the places are put in one order and the last island before a place tells its number:
    rows as many as files and islands, not their product.
    """
    names = wanted.groupBy("duplicate_key").agg(F.max("place").alias("_places"))
    mine = taken_versions(existing).join(names, "duplicate_key", "left_semi")
    gap = F.col("version") - F.col("rank")
    islands = (
        taken_ranks(mine)
        .groupBy("duplicate_key", gap.alias("_at"))
        .agg((F.max("rank") + 1).alias("_taken"))
        .join(names, "duplicate_key")
        .where(F.col("_at") < F.col("_places"))  # the others are above all places
        .select("duplicate_key", "_at", "_taken")
    )
    asked = wanted.withColumn("_at", (F.col("place") - 1).cast("bigint"))
    order = Window.partitionBy("duplicate_key").orderBy("_at", F.col("place").asc_nulls_first())
    known = F.coalesce(F.max("_taken").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return (
        asked.unionByName(islands, allowMissingColumns=True)
        .withColumn("version", F.col("_at") + known)
        .where(F.col("place").isNotNull())
        .drop("_at", "_taken")
    )


def duplicate_versions(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """Version per planned file in the duplicates folder.

    -1 means the plain name is free; otherwise the number of the ``_N`` suffix. Files
    competing for a name are served by modification time, then path. Paths are unique
    and lead to one name only if they differ in `-` or `/` within the folder part or in
    the appended suffix, so very few files compete.
    """
    order = Window.partitionBy("duplicate_key").orderBy("modified_at", "path")
    ranked = _taken(plan, existing, "duplicate_key", "_name_taken").withColumn(
        "_rank", F.row_number().over(order)
    )
    # with the plain name free, the first file takes it and the next ones move up
    placed = ranked.withColumn(
        "place", F.col("_rank") - F.when(F.col("_name_taken"), 0).otherwise(1)
    ).drop("_name_taken", "_rank")
    plain = placed.where(F.col("place") == 0).withColumn("version", F.lit(-1).cast("bigint"))
    later = free_versions(placed.where(F.col("place") > 0), existing)
    return plain.unionByName(later).drop("place")


def _version_suffix(version: Column) -> Column:
    return F.when(version == -1, F.lit("")).otherwise(
        F.concat(F.lit("_"), version.cast("string"))
    )


def apply_strategy(
    plan: DataFrame, target: DataFrame, duplicates: DataFrame, strategy: str
) -> DataFrame:
    """Add ``action`` and the key to write, by the strategy for duplicates.

    ``skip`` leaves a duplicate where it is; ``overwrite`` puts it under its name into
    the duplicates folder; ``version`` does so under the first free version.
    """
    marked = mark_duplicates(plan, target)
    is_duplicate = F.col("is_duplicate")
    if strategy == "skip":
        write_key = F.lit(None).cast("string")
    elif strategy == "overwrite":
        write_key = F.col("duplicate_key")
    elif strategy == "version":
        versions = duplicate_versions(marked.where("is_duplicate"), duplicates)
        marked = marked.join(versions.select("path", "version"), "path", "left")
        write_key = F.concat(
            F.col("duplicate_key"), _version_suffix(F.col("version"))
        )
    else:
        raise ValueError(f"unknown strategy for duplicates: {strategy!r}")
    return marked.withColumns(
        {
            "action": F.when(is_duplicate, strategy).otherwise("move"),
            "write_key": F.when(is_duplicate, write_key).otherwise(
                F.col("final_key")
            ),
        }
    )


def move_report(marked: DataFrame) -> DataFrame:
    """Planned files and duplicates among them, as one row."""
    return marked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_duplicate").alias("duplicates"),
    )

"""Object listings as DataFrames: path, modified_at, size."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.functions import dates


def list_files(spark: SparkSession, roots: str | Sequence[str]) -> DataFrame:
    """List files below one or more roots. The content column is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(roots if isinstance(roots, str) else list(roots))
        .select(
            "path",
            F.col("modificationTime").alias("modified_at"),
            F.col("length").alias("size"),
        )
    )


def is_pattern(root: str) -> bool:
    """Whether a root names more than one folder by wildcards."""
    return any(c in root for c in "*?[{")


def plain_root(root: str) -> str:
    """A root as listed paths show it: without empty, `.` and `..` segments."""
    scheme, mark, rest = root.rpartition("://")
    if not mark and rest.startswith("file:"):
        rest = rest.removeprefix("file:")
    host, slash, path = rest.partition("/") if mark else ("", "", rest)
    clean = posixpath.normpath((slash + path) or "/").replace("//", "/")
    return f"{scheme}{mark}{host}{clean}"


def relative_to(listing: DataFrame, root: str) -> DataFrame:
    """Cut everything up to and including ``root`` from the paths, giving object keys.

    A path that does not lie below the root, as with a root that is a pattern, is an
    error when the rows are read: its key could only be guessed.
    """
    marker = plain_root(root).rstrip("/") + "/"
    path = F.col("path")
    start = F.locate(marker, path) + len(marker)
    outside = F.raise_error(F.concat(path, F.lit(f" is not below {root}")))
    return listing.withColumn(
        "path",
        F.when(path.contains(marker), F.substring(path, start, F.length(path))).otherwise(
            outside.cast("string")
        ),
    )


def select_objects(
    listing: DataFrame, prefixes: str | Sequence[str] = "", suffix: str = ""
) -> DataFrame:
    """Objects below any of the prefixes whose key ends with the suffix."""
    wanted = [prefixes] if isinstance(prefixes, str) else list(prefixes)
    if not wanted:
        return listing.where(F.lit(False))
    below: Column = reduce(
        lambda a, b: a | b, [F.col("path").startswith(p) for p in wanted]
    )
    return listing.where(below & F.col("path").endswith(suffix))


def matching_names(
    listing: DataFrame, pattern: str, name: str = "target_file"
) -> DataFrame:
    """Keep rows whose file name holds a match of the regular expression."""
    return listing.where(F.col(name).rlike(pattern))


def without_dummies(listing: DataFrame) -> DataFrame:
    return listing.where(~F.col("path").contains("dummy"))


def snapshot_folders(listing: DataFrame) -> DataFrame:
    """Distinct second path segments."""
    return (
        listing.select(dates.path_segment(F.col("path")).alias("folder"))
        .where(F.col("folder").isNotNull())
        .distinct()
    )


def newer_than(listing: DataFrame, watermark: Column) -> DataFrame:
    """Objects in date folders after the watermark; other folders are left out."""
    return listing.withColumn("folder_date", dates.folder_date(F.col("path"))).where(
        dates.is_newer(F.col("folder_date"), watermark)
    )


def new_files_last(
    listing: DataFrame, watermark: Column, only_new: bool = False
) -> DataFrame:
    """Files in load order: those changed after the watermark come after all others.

    Nothing is left out unless ``only_new`` asks for it.
    """
    marked = listing.withColumn("is_new", F.col("modified_at") > watermark)
    if only_new:
        marked = marked.where("is_new")
    return marked.orderBy("is_new", "path")


def require_files(listing: DataFrame, message: str) -> DataFrame:
    """Raise when a listing is empty; looks at one row only."""
    if listing.isEmpty():
        raise FileNotFoundError(message)
    return listing

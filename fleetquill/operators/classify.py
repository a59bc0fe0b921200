"""Which core table a delivered file belongs to, decided by its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquill import schemas

CLASS_NAMES = list(schemas.CORE_CLASSES)


def classify_schema(schema: T.StructType) -> str | None:
    """Class whose schema is the same in names, order, types and nullability."""
    for name, known in schemas.DELIVERED_SCHEMAS.items():
        if schema == known:
            return name
    return None


def header_code(line: Column) -> Column:
    """Index of the class with exactly this header, -1 for any other line."""
    names = F.transform(F.split(line, ";"), lambda c: F.btrim(c, F.lit('"')))
    code = F.lit(-1)
    for index, name in reversed(list(enumerate(CLASS_NAMES))):
        header, _ = schemas.CORE_CLASSES[name]
        code = F.when(names == F.array(*map(F.lit, header)), index).otherwise(code)
    return code


def classify_files(lines: DataFrame) -> DataFrame:
    """Class per file (null for unknown headers) from its first line.

    Input: path, position, line. All files are classified in one job. Each line is
    reduced to an integer first, so the aggregate keeps two numbers per file, is
    pre-aggregated before the shuffle and never holds a file's text.
    """
    coded = lines.select("path", "position", header_code(F.col("line")).alias("code"))
    return classes_of(coded)


def classes_of(coded: DataFrame) -> DataFrame:
    """The same from lines of which only the code is left: path, position, code."""
    first = coded.groupBy("path").agg(
        F.min_by("code", "position").alias("code"),
        F.min("position").alias("header_position"),
    )
    names = F.array(*map(F.lit, CLASS_NAMES))
    return first.select(
        "path",
        F.get(names, F.col("code")).alias("table_class"),
        "header_position",
    )


def attach_class(rows: DataFrame, classes: DataFrame, salts: int = 32) -> DataFrame:
    """Rows of known files with the class of their file; both sides have ``path``.

    One file may hold a large share of all rows. Rows are dealt out over ``salts``
    join keys per file and the one class row per file is repeated as often, so no
    task gets a whole large file; with few files AQE broadcasts the classes instead.
    """
    known = classes.where(F.col("table_class").isNotNull()).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    return rows.withColumn("_salt", dealt).join(known, ["path", "_salt"]).drop("_salt")


def data_lines(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """Lines below the headers of known files, with their class."""
    return (
        attach_class(lines, classes)
        .where(F.col("position") != F.col("header_position"))
        .drop("header_position")
    )

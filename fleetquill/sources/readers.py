"""File and table readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquill import schemas
from fleetquill.sources import formats

Paths = str | Sequence[str]


def _paths(paths: Paths) -> str | list[str]:
    return paths if isinstance(paths, str) else list(paths)


def read_core_csv(spark: SparkSession, paths: Paths) -> DataFrame:
    """Delivered ``;`` files with a header; every column stays a string."""
    return (
        spark.read.option("header", True).option("delimiter", ";").csv(_paths(paths))
    )


def read_csv_inferred(spark: SparkSession, paths: Paths) -> DataFrame:
    """Comma files with a header and inferred types. Inference reads the files twice."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("timestampFormat", "yyyy-MM-dd")
        .csv(_paths(paths))
    )


def read_csv_positional(
    spark: SparkSession, paths: Paths, names: Sequence[str]
) -> DataFrame:
    """Headerless ``;`` files; the n-th name goes to the n-th column.

    Further columns are dropped; fewer columns than names is an analysis error.
    """
    raw = (
        spark.read.option("header", False).option("delimiter", ";").csv(_paths(paths))
    )
    return raw.selectExpr(*[f"_c{i} AS `{name}`" for i, name in enumerate(names)])


def read_maintenance_control(
    spark: SparkSession, paths: Paths, task: str
) -> DataFrame:
    """Control file of one maintenance task; its mostly empty columns have real types."""
    return (
        spark.read.schema(schemas.maintenance_control(task))
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(_paths(paths))
    )


def read_baselines(
    spark: SparkSession, paths: Paths, multi_line: bool = False
) -> DataFrame:
    """Baseline documents, one per line (``multi_line`` for pretty-printed files), and
    responses as they are landed, each with its document as a text."""
    found = spark.read.schema(schemas.LANDED_BASELINE).option("multiLine", multi_line)
    return whole_documents(found.json(_paths(paths)))


def whole_documents(found: DataFrame, *keep: str | Column) -> DataFrame:
    """(content, *keep): documents that are lines themselves or texts in a landed row."""
    parsed = F.from_json("body", schemas.BASELINE_DOCUMENT)["content"]
    return found.select(F.coalesce("content", parsed).alias("content"), *keep)


def read_landed_responses(spark: SparkSession, paths: Paths) -> DataFrame:
    """Landed responses: object_key, product_id, uuid and the body as it came."""
    return spark.read.schema(schemas.LANDED_RESPONSE).json(_paths(paths))


def read_table_path(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    table_format: str = "parquet",
) -> DataFrame:
    """A table by its path.

    A declared schema keeps text partition values text and columns in its order.
    """
    reader = formats.reader(spark, table_format)
    if schema is None:
        return reader.load(path)
    return reader.schema(schema).load(path).select(*schema.fieldNames())


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_files(spark: SparkSession, paths: Paths, file_format: str) -> DataFrame:
    """Read by format name; a format nobody knows is an error, not an empty answer."""
    if file_format == "csv":
        return read_csv_inferred(spark, paths)
    if file_format in ("parquet", "delta"):
        return spark.read.format(file_format).load(_paths(paths))
    raise ValueError(f"unknown file format: {file_format!r}")


def located_lines(text: DataFrame) -> DataFrame:
    """(path, start, line): non-blank lines of a text scan, batch or stream, with the
    place of their split in the file."""
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    ).where(F.trim("line") != "")


def positioned(lines: DataFrame) -> DataFrame:
    """(path, position, line): ``position`` orders the lines of one file, first by the
    split they come from, then within it, which one task reads in order."""
    number = F.monotonically_increasing_id().alias("number")
    return lines.select("path", F.struct("start", number).alias("position"), "line")


def read_core_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Lines of any mix of core files."""
    return positioned(located_lines(spark.read.text(_paths(paths))))


def parse_csv_column(
    df: DataFrame, line: str, names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Split a ``;`` text column into string columns; an empty field is null.

    ``inline`` keeps a later filter on a field from being pushed into the parse, where
    it would parse every line once more.
    """
    schema = ", ".join(f"`{n}` STRING" for n in names)
    return df.select(
        *keep, F.inline(F.array(F.from_csv(line, schema, {"sep": ";"})))
    )


def parse_json_column(
    df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Parse a JSON text column; the document's fields become columns.

    Each text is parsed once, as above. A text that is no JSON gives nulls.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(body, schema))))

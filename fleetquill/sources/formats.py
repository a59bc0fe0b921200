"""Table formats: what a format needs so that a table reads back as it was written.

Text formats keep no types. A table of any format is read with its declared schema, partition
columns included, and the options here are the same for reading and writing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

DEFAULT = "parquet"
TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: A null is written as this text, which no value can be; empty texts, blanks and line
#: breaks stay what they are.
NULL = "\\N"
CSV = {
    "header": True,
    "nullValue": NULL,
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": TIMESTAMP,
}
JSON = {"timestampFormat": TIMESTAMP, "ignoreNullFields": False}
OPTIONS: dict[str, dict] = {"csv": CSV, "json": JSON}


def reader(spark: SparkSession, table_format: str = DEFAULT) -> DataFrameReader:
    return spark.read.format(table_format).options(**OPTIONS.get(table_format, {}))


def writer(df: DataFrame, table_format: str = DEFAULT) -> DataFrameWriter:
    return df.write.format(table_format).options(**OPTIONS.get(table_format, {}))


def is_data_file(name: str, table_format: str) -> bool:
    """Whether a file below a table's folder makes it a table of the format."""
    if table_format == "delta":
        return "/_delta_log/" in name
    base = name.rsplit("/", 1)[-1]
    return not base.startswith(("_", ".")) and f".{table_format}" in base

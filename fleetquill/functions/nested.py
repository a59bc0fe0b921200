"""Access to nested fields and JSON texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find_path(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a dotted struct path, or None when the schema has no such path."""
    node: T.DataType = schema
    for part in path.split("."):
        if not isinstance(node, T.StructType) or part not in node.fieldNames():
            return None
        node = node[part].dataType
    return node


def optional_path(df: DataFrame, name: str, path: str) -> DataFrame:
    """Add column ``name`` from a nested path; a null string when the path is absent.

    The decision is made on the schema, before any job runs.
    """
    found = find_path(df.schema, path) is not None
    return df.withColumn(name, F.col(path) if found else F.lit(None).cast("string"))


def is_json(text: Column) -> Column:
    """True when the whole text is exactly one JSON value; false otherwise, also for null.

    The parser stops after the first complete value, so ``{} junk`` alone would pass.
    A text that parses both as the only element of an array and as the only member of
    an object has nothing before, after or beside its value. Object names must be unique.
    """
    element = F.concat(F.lit("["), text, F.lit("]"))
    member = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return (
        F.try_parse_json(element).isNotNull() & F.try_parse_json(member).isNotNull()
    )

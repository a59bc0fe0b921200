"""Helpers that several operators use: staged tables, Arrow texts as bytes, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.plans import staging

CHECKPOINT_DIR = "spark.checkpoint.dir"
LOCAL_FALLBACK = "/tmp/checkpoints"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names; one of our own only in local mode."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = LOCAL_FALLBACK
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to shared storage and read back: lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    staged.staged_at = path  # for release()
    return staged


def release(*staged: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in staged:
        staging.drop(df.sparkSession, df.staged_at)


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the tables has, in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array and their offsets; null is empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes together; a longer text is alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def text_key(text: Column, row_id: Column) -> list[Column]:
    """Two columns that identify a row by its id and its text; rows that are equal in
    both share it, which is right wherever the result depends on nothing else."""
    return [
        F.coalesce(row_id.cast("string"), F.lit("null")).alias("__id"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("__text"),
    ]

"""Intermediate tables that cut a plan's lineage and can be read many times."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.sources import files

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: From Spark 4.1 on; an older one knows no such setting and ignores it.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def is_machine_local(spark: SparkSession, path: str) -> bool:
    """Whether a path, with the default file system if it names none, is on a single disk."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getUri().getScheme() == "file"


def staging_folder(spark: SparkSession, fallback: str) -> str:
    """A new folder in the shared folder the cluster names for checkpoints.

    ``fallback`` serves where none is named; it has to be shared storage as well. A path
    without a scheme, or one on a member's own disk, is taken on a cluster only if it is
    named for checkpoints, as that folder may be mounted everywhere.
    """
    master = spark.sparkContext.master
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named and not master.startswith("local") and is_machine_local(spark, fallback):
        raise ValueError(f"{fallback} is not shared: set {CHECKPOINT_DIR}")
    shared = named or fallback
    return f"{shared.rstrip('/')}/fleetquill-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    files.delete(spark, path)


def stage(df: DataFrame, path: str, partition: str | None = None) -> DataFrame:
    """Write a table and read it back: Spark then knows its real size, and lost
    executors cost no recomputation of what came before. An empty table works too."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def stage_parts(parts: Iterable[DataFrame], path: str) -> DataFrame:
    """The parts of one table, written one after the other and read back as a whole."""
    for part in parts:
        part.write.mode("append").parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path).select(*part.columns)


def in_slice(df: DataFrame, columns: Sequence[str], number: int, slices: int) -> DataFrame:
    """The rows of one of several slices; equal values of the columns are in one slice."""
    if slices == 1:
        return df
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(slices)) == number)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs in here leave no shuffle files: without it these stay until the driver happens to
    collect its garbage. A DataFrame made in here should run once only."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)

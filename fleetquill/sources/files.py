"""What the driver asks a file system: single paths and one level of folders, no content."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder."""
    system, target = _located(spark, path)
    return system.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    system, target = _located(spark, path)
    system.delete(target, True)


def files_below(spark: SparkSession, path: str) -> Iterator[str]:
    """Paths of the files below a folder, asked for as they are taken; none without it."""
    system, target = _located(spark, path)
    if not system.exists(target):
        return
    found = system.listFiles(target, True)
    while found.hasNext():
        yield found.next().getPath().toString()


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder has a file that a scan would read, at any depth."""
    names = (file.rsplit("/", 1)[-1] for file in files_below(spark, path))
    return any(not name.startswith(("_", ".")) for name in names)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder; nothing below them is listed."""
    system, target = _located(spark, path)
    if not system.exists(target):
        return []
    return [s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()]

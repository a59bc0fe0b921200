"""File-source streams that load landed files as they come.

The stream's checkpoint remembers which files were taken, so no date watermark is
needed. Micro-batches only collect: each writes its lines or documents below a pending
folder, under its batch number, so a batch that is replayed overwrites itself. When the
stream has taken all that had arrived, everything pending is merged at once, as the
batch loads do. Neither the size of the batches nor the order in which files arrived
shows in the tables.

A ledger keeps what each table has: a load is logged as ``<stream id>#<last batch>``, and of
what is pending a table is given the batches after the last one in its log. So a run that
dies anywhere, even between its log rows and the removal of what was pending, is followed
by one that merges every batch once. Before a load begins, its last batch and its date are
written down; a load that did not finish is finished first, with the date it began with, so
that rows it had already written are found again. The stream id is that of the checkpoint: a
new checkpoint starts a new ledger.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import dates
from fleetquill.operators import baseline
from fleetquill.plans import baseline_load, core_load, staging, upsert
from fleetquill.sources import files, load_log, readers

BATCH = "_batch"
QUERY_ID = "sql.streaming.queryId"
LEDGER = "stream string, batch long, load_date date"


@dataclass(frozen=True)
class Pending:
    """What a stream has taken and not removed yet, with its batch numbers."""

    rows: DataFrame
    stream: str
    last: int


@dataclass(frozen=True)
class Load:
    """The batches up to ``batch``, merged under one date."""

    batch: int
    load_date: dt.date
    load_id: str


def pending_folder(checkpoint: str, stream: str | None = None) -> str:
    root = f"{checkpoint.rstrip('/')}-pending"
    return root if stream is None else f"{root}/{stream}"


def ledger_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-ledger"


def collect(
    stream: DataFrame,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> Pending | None:
    """All that had arrived and was not removed yet.

    ``prepare`` adds to a batch what a stream cannot.
    """
    spark = stream.sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        folder = pending_folder(checkpoint, own)
        prepare(batch).write.mode("overwrite").parquet(f"{folder}/{BATCH}={number}")

    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    name = str(query.id)
    folder = pending_folder(checkpoint, name)
    numbers = [int(f.partition("=")[2]) for f in files.folders(spark, folder) if f.startswith(f"{BATCH}=")]
    if not numbers:
        return None
    return Pending(spark.read.parquet(folder), name, max(numbers))


def loads(
    spark: SparkSession,
    checkpoint: str,
    pending: Pending,
    merged: Mapping[str, int],
    load_date: str | dt.date,
) -> Iterator[Load]:
    """The loads to run, oldest first: those begun and not in every table's log, then one of
    what came after, which is written down first. ``merged`` is the last batch per table."""
    ledger = ledger_folder(checkpoint)
    begun: list[tuple[int, dt.date]] = []
    if files.holds_files(spark, ledger):
        mine = F.col("stream") == pending.stream
        open_ones = spark.read.schema(LEDGER).parquet(ledger).where(
            mine & (F.col("batch") > min(merged.values()))
        )
        # of one batch the first date counts; a run that did not finish leaves one row
        first = open_ones.groupBy("batch").agg(F.min("load_date").alias("load_date"))
        begun = sorted((r["batch"], r["load_date"]) for r in first.collect())
    reached = max([*merged.values(), *(batch for batch, _ in begun)])
    if pending.last > reached:
        day = dt.date.fromisoformat(str(load_date))
        row = spark.createDataFrame([(pending.stream, pending.last, day)], LEDGER)
        row.coalesce(1).write.mode("append").parquet(ledger)
        begun.append((pending.last, day))
    for batch, day in begun:
        yield Load(batch, day, f"{pending.stream}#{batch}")


def stream_core(
    spark: SparkSession,
    landing: str,
    paths: core_load.CorePaths,
    checkpoint: str,
    load_date: str | dt.date,
    retention: dates.Retention = dates.Retention(),
    files_per_batch: int = 1000,
) -> dict[str, int]:
    """Merge all new files below ``landing`` (a folder or a glob) into the table of their
    class; files with unknown headers are left out. Rows written per table."""
    written = dict.fromkeys(schemas.CORE_CLASSES, 0)
    text = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(landing)
    pending = collect(readers.located_lines(text), checkpoint, readers.positioned)
    if pending is None:
        return written
    log = load_log.read_load_log(spark, paths.load_log, paths.table_format)
    merged = {name: load_log.last_number(log, name, pending.stream) for name in written}
    for load in loads(spark, checkpoint, pending, merged, load_date):
        number = F.col(BATCH)
        lines = pending.rows.where((number > min(merged.values())) & (number <= load.batch))
        done = core_load.merge_lines(
            spark,
            lines,
            paths,
            load.load_date,
            retention,
            load.load_id,
            once=True,
            only={name: number > merged[name] for name in merged},
        )
        written = {name: written[name] + done[name] for name in written}
        merged = dict.fromkeys(merged, load.batch)
    staging.drop(spark, pending_folder(checkpoint, pending.stream))
    return written


def stream_baselines(
    spark: SparkSession,
    landing: str,
    paths: baseline_load.BaselinePaths,
    checkpoint: str,
    load_date: str | dt.date,
    retention: dates.Retention = dates.Retention(),
    files_per_batch: int = 1000,
) -> int:
    """Merge all new baseline documents below ``landing/<date>/``; rows written.

    The first run opens the table: the oldest snapshot that had arrived by then is valid
    from the beginning of time.
    """
    found = (
        spark.readStream.schema(schemas.LANDED_BASELINE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )
    snapshot = baseline_load.snapshot_of_file().alias("snapshot_date")
    pending = collect(readers.whole_documents(found, snapshot), checkpoint)
    if pending is None:
        return 0
    table = baseline_load.stored_table(paths)
    merged = {table.name: load_log.last_number(table.log(spark), table.name, pending.stream)}
    written = 0
    for load in loads(spark, checkpoint, pending, merged, load_date):
        number = F.col(BATCH)
        documents = pending.rows.where((number > merged[table.name]) & (number <= load.batch)).drop(BATCH)
        initial = baseline_load.is_initial_load(spark, paths)
        written += upsert.upsert_insert_only(
            spark,
            baseline.first_seen(
                documents,
                load.load_date,
                retention,
                opening=baseline.first_snapshot(documents) if initial else None,
            ),
            table,
            load_id=load.load_id,
            once=True,
            unique=True,
        )
        merged[table.name] = load.batch
    staging.drop(spark, pending_folder(checkpoint, pending.stream))
    return written

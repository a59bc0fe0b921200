"""Exact duplicates against a persistent index of digests.

A text's digest is the SHA-256 of its normalised form: A to Z in lower case, nothing else
changed. The index is a table (digest, doc_id) in a shared folder, bucketed and sorted by
digest. A batch of documents is reduced to one row per digest, map-side first, so a text that
makes up a third of all rows arrives once per map task; what the index lacks is found by a
sort-merge anti-join for which the index is neither shuffled nor read into memory, and is
appended in the same buckets. Texts are never shuffled for it.

Of equal texts of a batch the row with the largest id stays, unless the index holds the
digest from before: then that document stays and the batch's rows go. Adding the same batch
again, as after a crash, changes nothing and gives the same answer. One writer at a time.

Defined results: a null text is empty, and an empty text is a text like any other; a null id
is smaller than any other; of rows that tie in text and id one stays; an empty table gives an
empty table and leaves the index as it is; other columns are ignored by ``add`` and kept by
``unique``.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.llm import shared
from fleetquill.plans import staging

ENTRIES = "digest binary, doc_id long"


@dataclass(frozen=True)
class Index:
    """A digest index and the name under which this session knows it."""

    path: str
    table: str
    buckets: int

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


def digest(text: Column) -> Column:
    """The digest of a text's normalised form."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(lower.cast("binary"), 256))


def open_index(spark: SparkSession, path: str, buckets: int | None = None) -> Index:
    """The index at a shared path, made there if it is new.

    A new index has as many buckets as a shuffle has partitions, so that joining it with a
    batch takes one shuffle, of the batch. The number is kept beside the entries.
    """
    path = path.rstrip("/")
    layout = f"{path}/layout"
    if staging.exists(spark, f"{layout}/_SUCCESS"):
        buckets = spark.read.parquet(layout).first()["buckets"]
    else:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(layout)
    name = spark.range(1).select(F.md5(F.lit(path).cast("binary")).alias("h")).first()["h"]
    table = f"digests_{name}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ENTRIES}) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/entries'"
    )
    return Index(path, table, buckets)


def close(spark: SparkSession, index: Index) -> None:
    """Forget the table's name; the index stays where it is."""
    spark.sql(f"DROP TABLE IF EXISTS {index.table}")


def unknown(classes: DataFrame, index: Index) -> DataFrame:
    """Rows of (digest, ...) whose digest the index lacks."""
    held = index.entries(classes.sparkSession).select("digest")
    return classes.join(held.hint("merge"), "digest", "left_anti")


def append(index: Index, entries: DataFrame) -> None:
    """Different digests that the index lacks, one sorted file per bucket that gets any."""
    rows = entries.select("digest", "doc_id").repartition(index.buckets, "digest")
    rows.write.insertInto(index.table)


def add(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add a batch; (doc_id, digest, keep_id, group_size, kept) for each of its rows.

    ``keep_id`` is the document that stays for the text, of this batch or of an earlier one;
    ``group_size`` counts the batch's rows with the text.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("digest"))
    rows = shared.stage(own.withColumn("row", F.monotonically_increasing_id()), "digests")
    last = F.max(F.struct("doc_id", "row")).alias("last")
    classes = shared.stage(
        rows.groupBy("digest")
        .agg(last, F.count("*").alias("group_size"))
        .select("digest", "group_size", F.col("last.doc_id").alias("doc_id"), F.col("last.row").alias("last_row")),
        "digest-classes",
    )
    append(index, unknown(classes, index))
    kept_ids = index.entries(docs.sparkSession).select("digest", F.col("doc_id").alias("keep_id"))
    # written, so that the rows of a frequent text are a shuffle that can be split
    known = shared.stage(classes.join(kept_ids.hint("merge"), "digest"), "digest-kept")
    stays = (F.col("row") == F.col("last_row")) & F.col("r.doc_id").eqNullSafe(F.col("keep_id"))
    return (
        rows.alias("r")
        .join(known.alias("k"), "digest")
        .select("r.doc_id", "digest", "keep_id", "group_size", stays.alias("kept"))
    )


def unique(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of a batch that stay, all their columns, once the batch is added."""
    own, mine = shared.fresh("digest", docs), shared.fresh("id", docs)
    stay = add(index, docs, id_col, text_col).where("kept").select(F.col("digest").alias(own), F.col("doc_id").alias(mine))
    keyed = docs.withColumns({own: digest(F.col(text_col)), mine: F.col(id_col).cast("long")})
    same = (F.col(f"d.{own}") == F.col(f"s.{own}")) & F.col(f"d.{mine}").eqNullSafe(F.col(f"s.{mine}"))
    chosen = keyed.alias("d").join(stay.alias("s"), same, "left_semi")
    return chosen.dropDuplicates([own, mine]).drop(own, mine)

"""A training corpus from documents: five stages, each written as Parquet and read again.

What holds for all stages: a null text is empty where it is judged and stays null where rows
are only chosen; repeated rows are judged each, and the second stage keeps one of them; ids may
be null; an empty table gives an empty table; all columns of ``documents`` come back as they
were, whatever they are called, but for those that a stage says it changes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.llm import decontamination, pii, queries, shared, simhash


def beside(docs: DataFrame, results: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """The documents with columns that are named like an operator's results out of its way,
    and the columns as they were."""
    taken = {name.lower() for name in results}
    moved = {c: shared.fresh(f"own_{c}", docs) for c in docs.columns if c.lower() in taken}
    return docs.withColumnsRenamed(moved), [F.col(f"`{moved.get(c, c)}`").alias(c) for c in docs.columns]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not reject; an empty text
    scores as low as any, and without labels of both kinds nothing is rejected."""
    given, own = beside(docs, ["toxicity"])
    rated = queries.rated(given, queries.table(spark, sf_dir, "labels"))
    return rated.where(F.col("toxicity") < 0.5).select(*own)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id; rows that share an id but not
    their text are different documents, and all empty texts are one group."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows; texts without
    words stay."""
    given, own = beside(docs, ["n_words", "n_hit", "item_ids"])
    checked = decontamination.annotate(given, queries.table(spark, sf_dir, "benchmark"))
    return checked.where(~decontamination.contaminated()).select(*own)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in ``text``, their length counted anew in
    ``n_chars`` where there is that column; a null text stays null."""
    given, own = beside(docs, ["pii"])
    masked = pii.redact(pii.find(given))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*own)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths, of every document; of an empty text the closing
    token alone. The documents' other columns end here."""
    return queries.pieces(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near-duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal-data", without_personal_data),
    ("packing", packed),
]

#: Training, hashing and tokenizing have no counterpart in SQL; tests/llm/test_pipeline.py holds
#: every stage and the result of run() against the stages written in plain Python, the first
#: with the fitted machine asked text by text.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what a stage read goes once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        kept = shared.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            shared.release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)

"""Benchmark decontamination as a prefix-filtered set join, built-in functions only.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window.
A window can occur in a document only if each of its shingles does, so one of them, the
necessary prefix of length one, is enough to find it: the rarest, counted over all
documents. The join on these rarest shingles gives aligned places; length and position
bound how far a match can reach from there, and comparing the words around both places
verifies the exact containment.

Items' shingles are few and bounded by the benchmark, not by the corpus: up to
``BROADCAST_ROWS`` of them are broadcast, after counting them; more are joined by a shuffle,
with the same result.

Defined results: a null or empty text has no words and no hits; a null item has no window;
items with equal ids count once; repeated rows of documents are treated each; an empty
benchmark hits nothing; an empty table gives an empty table; extra columns are kept by
``annotate``, but for columns named like its results, which it replaces.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared

WINDOW = 13
SHINGLE = 5
BROADCAST_ROWS = 500_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULTS = ["n_words", "n_hit", "item_ids"]


def words(text: Column) -> Column:
    """Words of a text with A to Z in lower case; other letters stay as they are."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(plain) == F.length(plain)
    folded = F.when(ascii_only, F.lower(plain)).otherwise(
        F.translate(plain, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def shingle_hash(tokens: Column, place: Column, size: int) -> Column:
    """Hash of ``size`` words from a place on, counted from 0; null at the text's end."""
    words_there = [F.get(tokens, place + k) for k in range(size)]
    return F.when(words_there[-1].isNotNull(), F.xxhash64(F.lit(size), *words_there))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once a row, however often it is used."""
    return F.get(F.transform(F.array(value), lambda bound: use(bound)), F.lit(0))


def item_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, tokens, size, shingle, at): every window of every item."""
    items = (
        benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("tokens"))
        .where(F.size("tokens") > 0)
        .withColumn("size", F.least(F.size("tokens"), F.lit(WINDOW)))
        .withColumn("shingle", F.least("size", F.lit(SHINGLE)))
    )
    starts = F.sequence(F.lit(0), F.size("tokens") - F.col("size"))
    return items.select("*", F.explode(starts).alias("at"))


def sized(df: DataFrame) -> DataFrame:
    """The side to broadcast where its counted rows are few enough for that."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def document_shingles(docs: DataFrame, text_col: str, sizes: list[int]) -> DataFrame:
    """(__id, __text, place, hash) for every place of every document and every size.

    The outer explode keeps the optimizer from testing for empty lists first, for which
    it would take every text apart twice. Places at a text's end have no hash.
    """
    tokens = docs.select("__id", "__text", words(F.col(text_col)).alias("__tokens"))
    placed = tokens.select("*", F.posexplode_outer("__tokens").alias("place", "__word"))
    hashes = [shingle_hash(F.col("__tokens"), F.col("place"), size) for size in sizes]
    hashed = hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes))
    return placed.select("__id", "__text", "place", hashed.alias("hash"))


def rarest(windows: DataFrame, met: DataFrame, sizes: list[int]) -> DataFrame:
    """Every window's rarest shingle, each place of an item once, with the item's words
    around it: (hash, item, size, shingle, left, middle, right), nearest words first."""
    hashed = F.lit(None).cast("long")
    for size in sizes:
        hashed = F.when(F.col("shingle") == size, shingle_hash(F.col("tokens"), F.col("spot"), size)).otherwise(hashed)
    spots = F.sequence(F.col("at"), F.col("at") + F.col("size") - F.col("shingle"))
    candidates = windows.select("*", F.explode(spots).alias("spot")).withColumn("hash", hashed)
    counted = shared.stage(met.groupBy("hash").count(), "bench-counts")
    rarity = F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.col("hash"), F.col("spot"))
    chosen = (
        candidates.join(counted, "hash", "left")
        .groupBy("item", "tokens", "size", "shingle", "at")
        .agg(F.min(rarity).alias("r"))
        .where(F.col("r.n") > 0)  # where a shingle is nowhere, its window is not either
        .select("item", "tokens", "size", "shingle", F.col("r.hash").alias("hash"), F.col("r.spot").alias("spot"))
        .distinct()
    )
    sides = around(F.col("tokens"), F.col("spot"), F.col("shingle"))
    return shared.stage(chosen.select("hash", "item", "size", "shingle", *sides), "bench-anchors")


def around(tokens: Column, at: Column, size: Column) -> list[Column]:
    """A shingle's words and those on either side of it, as far as a window reaches."""
    reach = F.lit(WINDOW) - size
    before = F.least(at, reach)
    return [
        F.reverse(F.slice(tokens, at - before + 1, before)).alias("left"),
        F.slice(tokens, at + 1, size).alias("middle"),
        F.slice(tokens, at + size + 1, reach).alias("right"),
    ]


def agreeing(a: Column, b: Column) -> Column:
    """How many words two lists have in common from their start."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False)).cast("int")
    return F.when(first == 0, F.size(same)).otherwise(first - 1)


def verified(tokens: Column, places: Column) -> Column:
    """Of aligned places those in a whole window, as (low, high, item), high exclusive:
    every word between lies in an occurrence of one of the item's windows."""

    def reach(at: Column) -> Column:
        left, middle, right = around(tokens, at["place"], at["shingle"])
        low = at["place"] - agreeing(left, at["left"])
        high = at["place"] + at["shingle"] + agreeing(right, at["right"])
        held = F.when((middle == at["middle"]) & (high - low >= at["size"]), True).otherwise(False)
        return F.struct(low.alias("low"), high.alias("high"), at["item"].alias("item"), held.alias("held"))

    def room(at: Column) -> Column:  # length and position: could a whole window lie here?
        before = F.least(at["place"], F.size(at["left"]))
        after = F.least(F.size(tokens) - at["place"] - at["shingle"], F.size(at["right"]))
        return (F.size(tokens) >= at["size"]) & (before + at["shingle"] + after >= at["size"])

    return F.filter(F.transform(F.filter(places, room), reach), lambda at: at["held"])


def covered(spans: Column) -> Column:
    """Number of places in the union of sorted (low, high, ...) spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, span: Column) -> Column:
        more = F.greatest(F.lit(0), span["high"] - F.greatest(span["low"], state["end"]))
        return F.struct(F.greatest(state["end"], span["high"]).alias("end"), (state["n"] + more).alias("n"))

    return F.aggregate(spans, start, add, lambda state: state["n"])


def candidates(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """(__id, __text, places): per document the places aligned with a window's rarest shingle."""
    windows = shared.stage(item_windows(benchmark, item_col, item_text_col), "bench-windows")
    sizes = [row["shingle"] for row in windows.select("shingle").distinct().collect()] or [SHINGLE]
    known = None
    for size in sizes:
        spots = F.sequence(F.lit(0), F.size("tokens") - size)
        own = windows.where(F.col("shingle") == size).select("tokens").distinct()
        own = own.select("tokens", F.explode(spots).alias("spot")).select(
            shingle_hash(F.col("tokens"), F.col("spot"), size).alias("hash")
        )
        known = own if known is None else known.unionByName(own)
    known = shared.stage(known.distinct(), "bench-shingles")
    met = shared.stage(
        document_shingles(docs, text_col, sizes).join(sized(known), "hash").distinct(), "bench-matches"
    )
    marks = rarest(windows, met, sizes)
    place = F.struct("place", "item", "size", "shingle", "left", "middle", "right")
    aligned = met.join(sized(marks), "hash").groupBy("__id", "__text").agg(F.collect_list(place).alias("__places"))
    return shared.stage(aligned, "bench-aligned")


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """All columns and n_words, n_hit, item_ids (sorted as strings)."""
    row, hashed, at, found = (shared.fresh(name, docs) for name in ("id_key", "text_key", "places", "found"))
    key = shared.text_key(F.col(text_col), F.col(id_col))
    aligned = candidates(docs.select(*key, F.col(text_col).alias("text")), benchmark, "text", item_col, item_text_col)
    aligned = aligned.toDF(row, hashed, at)
    keyed = docs.select("*", key[0].alias(row), key[1].alias(hashed))

    def result(tokens: Column) -> Column:
        spans = F.when(F.col(at).isNotNull(), F.array_sort(verified(tokens, F.col(at))))
        return F.struct(F.size(tokens).cast("long").alias("n_words"), spans.alias("spans"))

    joined = keyed.join(aligned, [row, hashed], "left")
    checked = joined.withColumn(found, once(words(F.col(text_col)), result))
    spans = F.col(f"{found}.spans")
    return checked.select(
        *[c for c in docs.columns if c not in RESULTS],
        F.col(f"{found}.n_words").alias("n_words"),
        F.when(spans.isNull(), 0).otherwise(covered(spans)).cast("long").alias("n_hit"),
        F.coalesce(
            F.array_sort(F.array_distinct(F.transform(spans, lambda span: span["item"]))),
            F.array().cast("array<string>"),
        ).alias("item_ids"),
    )


def contaminated() -> Column:
    """A twentieth of the words, or more, lies in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))

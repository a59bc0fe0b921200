"""Language identification by prediction by partial matching (PPM).

Per language a variable-order tree of byte contexts, up to three bytes long, holds frozen
symbol counts. A symbol unseen in a context costs that context's escape and is then coded
in the next shorter one, without the symbols already excluded; below the empty context all
bytes are equally likely. A text's score under a language is its exact code length in bits,
and the language with the shortest code wins.

Counts cover every training document. How many byte sequences are kept grows with them: one
is kept if it occurs at least total^(2/3) / ``DETAIL`` times among its language's ``total``
bytes, so a language has at most DETAIL * total^(1/3) of them and a small one keeps all; the most frequent one
always stays.
Trees hold what was seen and nothing else, as sorted arrays. They are sent to executors in
groups of at most ``GROUP`` bytes (a larger tree is alone), each of which reads the texts once.

Defined results: a null text, or one without a letter, is `und` with score 0; ties go to the
language first in alphabetical order; rows without a language or with an empty text teach
nothing; without any training row every text is `und`; repeated rows count each; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared

UNDETERMINED = "und"
ORDER = 3
DETAIL = 10_000
GROUP = 256 << 20
BLOCK = 2 << 20
FLUSH = 1 << 20


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte its own value and the three before it in the text (0 before its
    start) as one 32-bit number, oldest byte highest."""
    wide = data.astype(np.uint32)
    code = wide.copy()
    starts = offsets[:-1]
    ends = offsets[1:]
    for back in range(1, ORDER + 1):
        older = np.zeros_like(wide)
        older[back:] = wide[:-back]
        for early in range(back):  # these have fewer than ``back`` bytes before them
            older[(starts + early)[starts + early < ends]] = 0
        code |= older << np.uint32(8 * back)
    return code


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all documents that have a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (codes, n) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            data, offsets = shared.byte_view(batch.column(0))
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, last in shared.blocks(offsets, BLOCK):
                bounds = offsets[first : last + 1]
                codes = grams(data[bounds[0] : bounds[-1]], bounds - bounds[0])
                sizes = np.diff(bounds)
                for lang in set(langs[first:last]):
                    own = np.repeat(langs[first:last] == lang, sizes)
                    new, n = np.unique(codes[own], return_counts=True)
                    if lang in held:
                        old, m = held[lang]
                        both = np.concatenate([old, new])
                        new, place = np.unique(both, return_inverse=True)
                        n = np.bincount(place, np.concatenate([m, n])).astype(np.int64)
                    held[lang] = (new, n)
                if sum(len(c) for c, _ in held.values()) > FLUSH:
                    yield from rows()
        yield from rows()

    learn = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = learn.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(
        count, "lang string, gram long, n long"
    )
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """Contexts of one length: the bits of the symbols seen in them, and of their escapes."""

    cells: np.ndarray  # context and symbol as one number, sorted
    bits: np.ndarray
    contexts: np.ndarray  # sorted
    escapes: np.ndarray  # what a shorter context's bits are raised by


@dataclass
class Model:
    languages: list[str]
    trees: list[list[Level]]  # levels from the empty context to the longest


def compile_tree(codes: np.ndarray, n: np.ndarray) -> list[Level]:
    """Frozen statistics of one language. Escape of a context with n symbols, d of them
    different: d / (n + d); a seen symbol: its count / (n + d); an unseen one: the escape
    times its share of what the shorter context leaves when the seen ones are excluded."""
    levels: list[Level] = []
    for order in range(ORDER + 1):
        cells, place = np.unique(codes & (1 << 8 * (order + 1)) - 1, return_inverse=True)
        seen = np.bincount(place, n)
        contexts, starts = np.unique(cells >> 8, return_index=True)
        kinds = np.diff(np.append(starts, len(cells)))
        total = np.add.reduceat(seen, starts)
        if order:  # a symbol seen here was seen in the shorter context too
            shorter = probability[np.searchsorted(levels[-1].cells, cells & (1 << 8 * order) - 1)]
        else:
            shorter = np.full(len(cells), 1 / 256)
        left = np.maximum(1 - np.add.reduceat(shorter, starts), 1e-15)
        probability = seen / np.repeat(total + kinds, kinds)
        escapes = -np.log2(kinds / (total + kinds) / left)
        levels.append(
            Level(cells.astype(np.uint32), (-np.log2(probability)).astype(np.float32), contexts.astype(np.uint32), escapes.astype(np.float32))
        )
    return levels


def build(names: np.ndarray, codes: np.ndarray, n: np.ndarray) -> Model:
    """The model from a language, a sequence and its count per row."""
    languages = sorted(set(names.tolist()))
    trees = [compile_tree(codes[names == lang], n[names == lang].astype(np.float64)) for lang in languages]
    return Model(languages, trees)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", detail: float = DETAIL) -> Model:
    counts = shared.stage(gram_counts(docs, text_col, lang_col), "ppm-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.max(F.struct("n", "gram"))["gram"].alias("top"))
    often = F.pow(F.col("total").cast("double"), F.lit(2 / 3)) / detail
    keep = (F.col("n") >= often) | (F.col("gram") == F.col("top"))
    kept = counts.join(totals, "lang").where(keep).select("lang", "gram", "n").toArrow()
    shared.release(counts)
    names = kept.column(0).to_numpy().astype(object)
    return build(names, kept.column(1).to_numpy(), kept.column(2).to_numpy())


def found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys are, and whether they are there at all."""
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return place, sorted_keys[place] == keys


def symbol_bits(tree: list[Level], codes: np.ndarray) -> np.ndarray:
    """Bits of each sequence's last byte after the bytes before it."""
    place, hit = found(tree[ORDER].cells, codes)
    out = tree[ORDER].bits[place].astype(np.float64)
    rest = codes[~hit]
    bits = np.full(len(rest), 8.0)
    for order, level in enumerate(tree):
        cell = rest & np.uint32((1 << 8 * (order + 1)) - 1)
        place, known = found(level.contexts, cell >> np.uint32(8))
        bits += np.where(known, level.escapes[place], 0)
        if order < ORDER:
            place, seen = found(level.cells, cell)
            bits = np.where(seen, level.bits[place], bits)
    out[~hit] = bits
    return out


def code_lengths(trees: list[list[Level]], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every text under every language; a text longer than a block is added up
    block by block. A block's different sequences are looked up once."""
    out = np.zeros((len(offsets) - 1, len(trees)))
    for low in range(0, len(data), BLOCK):
        high = min(len(data), low + BLOCK)
        first = int(np.searchsorted(offsets, low, side="right")) - 1
        last = int(np.searchsorted(offsets, high, side="left"))
        back = max(int(offsets[first]), low - ORDER)
        bounds = np.clip(offsets[first : last + 1], back, high)
        codes, place = np.unique(grams(data[back:high], bounds - back)[low - back :], return_inverse=True)
        starts = np.clip(offsets[first:last], low, high) - low
        filled = np.flatnonzero(np.diff(np.append(starts, high - low)) > 0)
        for k, tree in enumerate(trees):
            out[first + filled, k] += np.add.reduceat(symbol_bits(tree, codes)[place], starts[filled])
    return out


def groups(trees: list[list[Level]]) -> Iterator[list[list[Level]]]:
    """The trees in order, as many together as ``GROUP`` bytes hold."""
    held, size = [], 0
    for tree in trees:
        own = sum(a.nbytes for level in tree for a in vars(level).values())
        if held and size + own > GROUP:
            yield held
            held, size = [], 0
        held, size = [*held, tree], size + own
    if held:
        yield held


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score); the score is the winner's share of the likelihood."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        has_letter(text).alias("letters"),
        F.array().cast("array<double>").alias("bits"),
        text.alias("text"),
    )
    for group in groups(model.trees):
        plain = [[tuple(vars(level).values()) for level in tree] for tree in group]
        sent = docs.sparkSession.sparkContext.broadcast(plain)

        def measure(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trees = [[Level(*level) for level in tree] for tree in sent.value]
            for batch in batches:
                before = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                both = np.hstack([before, code_lengths(trees, *shared.byte_view(batch.column(3)))])
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * both.shape[1]
                bits = pa.ListArray.from_arrays(pa.array(ends), pa.array(both.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], bits, batch.column(3)], names=batch.schema.names)

        rows = rows.mapInArrow(measure, "doc_id long, letters boolean, bits array<double>, text string")
    names = F.array(*[F.lit(lang) for lang in model.languages]).cast("array<string>")
    least = F.array_min("bits")
    weight = F.aggregate("bits", F.lit(0.0), lambda s, b: s + F.pow(F.lit(2.0), least - b))
    told = F.col("letters") & (F.size("bits") > 0)
    return rows.select(
        "doc_id",
        F.when(told, F.get(names, (F.array_position("bits", least) - 1).cast("int"))).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(told, 1 / weight).otherwise(0.0).alias("score"),
    )

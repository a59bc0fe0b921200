"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

A fingerprint's bit is set if it is set in more than half of the hashes of the text's word
shingles. Two fingerprints that differ in at most ``RADIUS`` = 3 bits are linked. Half of
three is no whole number, so one of four 16-bit blocks is left out at a time: of three
differing bits at least one lies in some block, and without it two remain, half of which is
one. Every fingerprint emits, for each block left out, all variants of the other 48 bits
within one bit: 4 * 49 = 196 keys. Linked fingerprints share a key, and all that share one
are verified on all 64 bits. Equal fingerprints are one from the start.

What meets under a key is compared in its task; it leaves at most one edge per row, a
spanning forest of the key's links, never all pairs. A key has at most 49 * 65536 different
fingerprints, which bounds the memory of the largest.

Defined results: a null or empty text, or one of white space, has no words and fingerprint
zero; fewer words than a shingle are hashed together; repeated rows have equal results; a
row without id takes its component's smallest id, if any; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import components, shared

SHINGLE = 3
SEED = 42
RADIUS = 3
BLOCKS = 4
SMALL = 2048


def text_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> list[int]:
    """Hashes of all shingles, repeats included."""
    words = text.lower().split()  # of bytes: A to Z only, ASCII white space only
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [digest(joined, seed)]
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    ends = (starts[shingle:] - 1).tolist()
    return [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends, strict=False)]


def fold(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of texts from all their hashes, uint64, and where each text's begin."""
    sizes = np.diff(np.append(starts, len(hashes)))
    out = np.zeros(len(starts), np.uint64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, starts[filled], axis=0, dtype=np.int32)
        most = 2 * counts > sizes[filled, None]
        out[filled] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def long_fold(text: bytes) -> np.uint64:
    """The fingerprint of one long text, its hashes folded part by part."""
    hashes = np.array(text_hashes(text), np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 18):
        part = hashes[k : k + (1 << 18)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None
) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long. With ``key_col``, a
    column of texts, that is carried along as ``key``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = shared.byte_view(batch.column(1))
            out = np.zeros(len(offsets) - 1, np.uint64)
            for first, last in shared.blocks(offsets, 1 << 20):
                if last == first + 1 and offsets[last] - offsets[first] > 1 << 20:
                    out[first] = long_fold(data[offsets[first] : offsets[last]].tobytes())
                    continue
                hashes: list[int] = []
                starts = []
                for row in range(first, last):
                    starts.append(len(hashes))
                    hashes += text_hashes(data[offsets[row] : offsets[row + 1]].tobytes())
                out[first:last] = fold(np.array(hashes, np.uint64), np.array(starts, np.int64))
            given = [batch.column(0), *batch.columns[2:], pa.array(out.view(np.int64))]
            yield pa.RecordBatch.from_arrays(given, names=names)

    carried = [] if key_col is None else [F.col(key_col)]
    names = ["doc_id", *(["key"] if carried else []), "fp"]
    kinds = {"doc_id": "long", "key": "string", "fp": "long"}
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *carried).mapInArrow(
        sign, ", ".join(f"{name} {kinds[name]}" for name in names)
    )


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variants(fp: Column) -> Column:
    """All keys of a fingerprint; the block that is left out holds its own number instead."""
    width = 64 // BLOCKS
    keys = []
    for block in range(BLOCKS):
        left_out = ((1 << width) - 1) << (block * width)
        kept = fp.bitwiseAND(F.lit(signed(~left_out & (1 << 64) - 1)))
        flips = [0] + [1 << bit for bit in range(64) if not left_out >> bit & 1]
        keys += [kept.bitwiseXOR(F.lit(signed(flip | (block + 1) << (block * width)))) for flip in flips]
    return F.array(*keys)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS  # of signed ones it counts |x|


def forest(members: np.ndarray) -> np.ndarray:
    """For every member the place of the first one of its component, block by block."""
    label = np.arange(len(members))
    while True:
        new = label.copy()
        for low in range(0, len(members), SMALL):
            for other in range(0, len(members), SMALL):
                close = near(members[low : low + SMALL, None], members[None, other : other + SMALL])
                theirs = np.where(close, label[None, other : other + SMALL], len(members)).min(axis=1)
                new[low : low + SMALL] = np.minimum(new[low : low + SMALL], theirs)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def run_edges(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified edges among rows of equal keys; rows come sorted by key."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    if not len(starts):
        return fps[:0], fps[:0]
    first = np.repeat(fps[starts], sizes)
    at = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
    member = fps[at]
    close = near(first, member)
    a, b = [first[close]], [member[close]]
    failed = np.add.reduceat(~close, np.append(0, np.cumsum(sizes)[:-1])) > 0
    for start, size in zip(starts[failed & (sizes > 2)], sizes[failed & (sizes > 2)], strict=True):
        own = fps[start : start + size]
        a.append(own[forest(own)])
        b.append(own)
    a, b = np.concatenate(a), np.concatenate(b)
    return a[a != b], b[a != b]


def edges(prints: DataFrame) -> DataFrame:
    """(a, b): edges between different fingerprints whose components are those of all
    links; from a column fp of different values."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def linked(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = run_edges(k, f)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if not len(keys) or keys[0] == keys[-1]:
                continue
            whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            yield linked(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield linked(keys, fps)

    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.repartition(tasks, "fp")  # few rows, each of which becomes 196
    rows = spread.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(meet, "a long, b long").distinct()


def classes(nodes: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint that links reach; from (fp, ...) of different ones."""
    stars = components.stars(edges(nodes.select("fp")))
    linked = stars.select(F.col("b").alias("fp"), F.col("a").alias("root"))
    linked = linked.unionByName(stars.select(F.col("a").alias("fp"), F.col("a").alias("root")).distinct())
    return nodes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): the smallest id that links reach."""
    prints = shared.stage(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = shared.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    rooted = shared.stage(classes(nodes), "fingerprint-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = shared.stage(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-classes")
    shared.release(nodes, rooted)
    return prints.join(whole, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every component one row, all its columns: that with the smallest id, of rows that
    share it the smallest digest of their text; a row without id only where none has one.
    A row is told by id and text, so rows that share an id but are not alike all stay."""
    mine, told = shared.fresh("id", docs), shared.fresh("text_key", docs)
    key = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    keyed = docs.withColumns({mine: F.col(id_col).cast("long"), told: key})
    prints = fingerprints(keyed, mine, text_col, told)
    one = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))
    nodes = shared.stage(prints.groupBy("fp").agg(one.alias("one")), "fingerprint-nodes")
    first = classes(nodes).groupBy("root").agg(F.min("one").alias("one"))
    chosen = shared.stage(first.select(F.col("one.doc_id").alias(mine), F.col("one.key").alias(told)), "fingerprint-kept")
    shared.release(nodes)
    same = F.col(f"d.{mine}").eqNullSafe(F.col(f"c.{mine}")) & (F.col(f"d.{told}") == F.col(f"c.{told}"))
    kept = keyed.alias("d").join(chosen.alias("c"), same, "left_semi")
    return kept.dropDuplicates([mine, told]).select(*docs.columns)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

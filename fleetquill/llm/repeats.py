"""Removal of repeated passages with suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts anywhere else. Strings
are grouped before they are sorted: each has as its anchor the gram of ``GRAM`` bytes with the
smallest hash in it, the leftmost of equals, so equal strings have equal anchors. Consecutive
starts with one anchor form a run, about 85 starts long. Only anchors that occur twice or
more can hold repeats. Where all of an anchor's runs have the same bytes, all of their
strings repeat and none is sorted, however many copies there are. Of the others each
different run is taken once, cut out of its text, and the anchors' runs are laid end to end
in tasks that build a suffix array over them.

The suffix array is made by two-stage sorting: only suffixes smaller than their successors
are sorted directly, the others are induced by one scan of the buckets. Strings that start
at neighbours in it are equal if their common prefix is ``LENGTH`` bytes or more.

An anchor with more than ``SPLIT`` different runs, as at the edge of a passage that a large
part of all documents share, would be too large for a task: its strings are counted one by
one in an aggregate with partial sums instead.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing; rows that are
equal in id and text are occurrences each and lose the same; an empty table gives an empty
table; other columns are kept, but for columns named like the results, which are replaced.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquill.llm import shared

LENGTH = 200
GRAM = 32
SPLIT = 5000
BLOCK = 1 << 20
PLACE_BITS = 24
SORTED_BYTES = 256 << 10
RUN = "__id long, __h long, key long, seg long, at int, n int"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(values: np.ndarray) -> np.ndarray:
    """Hash of the GRAM values from every place on, by doubling."""
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        values = values[:-width] * np.uint64(factor) + values[width:]
        width, factor = 2 * width, factor * factor % 2**64
    return mixed(values)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima of blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse: hashes of any stretch."""

    def __init__(self, n: int, base: int = 0xD6E8FEB86659FD93):
        self.up = np.cumprod(np.append(np.uint64(1), np.full(n, base, np.uint64)))
        inverse = np.full(n, pow(base, -1, 2**64), np.uint64)
        self.down = np.cumprod(np.append(np.uint64(1), inverse))


def runs(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """(text, at, n, key, seg) of every run of the texts in a block."""
    table = mixed(np.arange(1, 257, dtype=np.uint64))
    values = table[data]
    sizes = np.diff(offsets)
    starts = np.maximum(sizes - LENGTH + 1, 0)
    valid = np.repeat(np.tile([True, False], len(sizes)), np.stack([starts, sizes - starts], axis=1).ravel())
    places = np.flatnonzero(valid)
    if not len(places):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    grams = gram_hashes(values)
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_minimum(packed, LENGTH - GRAM + 1)[places] & low).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1))
    first = np.flatnonzero(new)
    at = places[first]
    n = np.diff(np.append(first, len(places)))
    summed = np.append(np.uint64(0), np.cumsum(values * powers.up[: len(values)]))
    end = at + n + LENGTH - 1
    seg = mixed((summed[end] - summed[at]) * powers.down[at] + n.astype(np.uint64))
    text = np.searchsorted(offsets, at, side="right") - 1
    return text, at - offsets[text], n, grams[anchor[first]], seg


def all_runs(docs: DataFrame) -> DataFrame:
    """The runs of all texts; from (__id, __h, text as binary)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(BLOCK + LENGTH)

        def rows(batch: pa.RecordBatch, first: int, text: np.ndarray, at: np.ndarray, *rest: np.ndarray) -> pa.RecordBatch:
            n, key, seg = rest
            owners = pa.array(first + text)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owners),
                    batch.column(1).take(owners),
                    pa.array(key.view(np.int64)),
                    pa.array(seg.view(np.int64)),
                    pa.array(at.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                ],
                names=["__id", "__h", "key", "seg", "at", "n"],
            )

        for batch in batches:
            data, offsets = shared.byte_view(batch.column(2))
            for first, last in shared.blocks(offsets, BLOCK):
                low, high = int(offsets[first]), int(offsets[last])
                if high - low <= BLOCK:
                    yield rows(batch, first, *runs(data[low:high], offsets[first : last + 1] - low, powers))
                    continue
                for part in range(low, high, BLOCK):  # one long text, its starts part by part
                    own = data[part : min(high, part + BLOCK + LENGTH - 1)]
                    text, at, n, key, seg = runs(own, np.array([0, len(own)]), powers)
                    yield rows(batch, first, text, at + (part - low), n, key, seg)

    return docs.mapInArrow(scan, RUN)


def sorted_suffixes(text: bytes, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes: by their first eight as numbers,
    then each group that these leave equal by the rest."""
    padded = np.frombuffer(text + bytes(8), np.uint8)
    heads = np.zeros(len(suffixes), np.uint64)
    for k in range(min(8, depth)):
        heads |= padded[suffixes + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    order = np.argsort(heads, kind="stable")
    suffixes, heads = suffixes[order], heads[order]
    starts = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
    sizes = np.diff(np.append(starts, len(heads)))
    for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        group = suffixes[start : start + size].tolist()
        group.sort(key=lambda i: text[i : i + depth])
        suffixes[start : start + size] = group
    return suffixes


def suffix_array(text: bytes, depth: int) -> array:
    """Suffixes in the order of their first ``depth`` bytes at least, by two-stage sorting."""
    n = len(text)
    symbols = np.frombuffer(text, np.uint8).astype(np.int16)
    step = np.append(np.sign(np.diff(symbols)), -1)  # the last suffix is larger than the empty one
    decides = np.where(step != 0, np.arange(n), n)
    rising = step[np.minimum.accumulate(decides[::-1])[::-1]] > 0
    counts = np.bincount(symbols, minlength=256)
    head = (np.cumsum(counts) - counts).tolist()
    direct = sorted_suffixes(text, np.flatnonzero(rising), depth)
    order = array("i", [-1]) * n
    # smaller suffixes stand at the end of their bucket: those that are induced come first
    bucket = symbols[direct]
    sizes = np.bincount(bucket, minlength=256)
    place = np.cumsum(counts)[bucket] - np.cumsum(sizes)[bucket] + np.arange(len(direct))
    np.frombuffer(order, np.int32)[place] = direct
    falling = (~rising).tobytes()
    last = text[n - 1]
    order[head[last]] = n - 1
    head[last] += 1
    for k in range(n):
        before = order[k] - 1
        if before >= 0 and falling[before]:
            byte = text[before]
            order[head[byte]] = before
            head[byte] += 1
    return order


def prefixes_agree(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the common prefix of suffixes a and b is LENGTH or more, eight bytes at a time."""
    words = np.lib.stride_tricks.sliding_window_view(symbols, 8)
    same = np.ones(len(a), bool)
    for k in range(0, LENGTH, 8):
        left = np.flatnonzero(same)
        if not len(left):
            break
        same[left] = (words[a[left] + k] == words[b[left] + k]).all(axis=1)
    return same


def repeated_starts(segments: list[bytes]) -> list[np.ndarray]:
    """For every segment, which of its strings' starts have an equal one elsewhere here."""
    text = b"".join(segments)
    ends = np.cumsum([len(s) for s in segments])
    starts = ends - [len(s) for s in segments]
    valid = np.zeros(len(text), bool)
    for low, high in zip(starts.tolist(), ends.tolist(), strict=True):
        valid[low : high - LENGTH + 1] = True
    order = np.array(suffix_array(text, LENGTH), np.int64)
    order = order[valid[order]]
    equal = prefixes_agree(np.frombuffer(text, np.uint8), order[:-1], order[1:])
    repeated = np.zeros(len(text), bool)
    repeated[order[:-1][equal]] = True
    repeated[order[1:][equal]] = True
    return [repeated[low : high - LENGTH + 1] for low, high in zip(starts.tolist(), ends.tolist(), strict=True)]


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def sorted_repeats(segments: DataFrame) -> DataFrame:
    """(key, seg, low, high): stretches of repeated starts, of segments (key, seg, bytes)."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0

        def result() -> pa.RecordBatch:
            out: list[list[int]] = [[], [], [], []]
            for (key, seg, _), mask in zip(held, repeated_starts([h[2] for h in held]), strict=True):
                low, high = stretches(mask)
                for column, values in zip(out, ([key] * len(low), [seg] * len(low), low, high), strict=True):
                    column.extend(values)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["key", "seg", "low", "high"]
            )

        for batch in batches:
            for key, seg, own in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if size > SORTED_BYTES and held[-1][0] != key:
                    yield result()
                    held, size = [], 0
                held.append((key, seg, own))
                size += len(own)
        if held:
            yield result()

    ready = segments.select("key", "seg", "bytes").repartition("key").sortWithinPartitions("key")
    return ready.mapInArrow(sort, "key long, seg long, low int, high int")


def counted_repeats(segments: DataFrame) -> DataFrame:
    """The same for anchors with very many different runs: each string by itself, counted
    with partial sums."""
    places = F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH)
    each = segments.select("key", "seg", F.explode(places).alias("low"), "bytes").select(
        "key", "seg", "low", F.sha2(F.expr(f"substring(bytes, low + 1, {LENGTH})"), 256).alias("string")
    )
    many = each.groupBy("key", "string").count().where("count > 1").select("key", "string")
    return each.join(many, ["key", "string"]).select("key", "seg", "low", (F.col("low") + 1).alias("high"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(__id, __h, spans): byte stretches to remove per text; from (__id, __h, text as binary)."""
    found = shared.stage(all_runs(docs), "repeat-runs")
    counts = found.groupBy("key").agg(F.count("*").alias("c"), F.min("seg").alias("s"), F.max("seg").alias("t"))
    # written, so that in the join a hot anchor's runs are a shuffle that can be split
    keys = shared.stage(
        counts.where("c > 1").select("key", (F.col("s") != F.col("t")).alias("differ")), "repeat-keys"
    )
    twice = shared.stage(found.join(keys, "key"), "repeat-candidates")
    shared.release(found, keys)
    differ = (
        twice.where("differ")
        .groupBy("key", "seg")
        .agg(F.count("*").alias("c"), F.min(F.struct("__id", "__h", "at", "n")).alias("one"))
    )
    kinds = shared.stage(differ.select("key", "seg", "c", "one.*"), "repeat-kinds")
    # written as well: of a written table the join shuffles both sides, and can split them
    hot = kinds.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > SPLIT).select("key", F.lit(True).alias("hot"))
    hot = shared.stage(hot, "repeat-hot")
    cuts = kinds.join(hot, "key", "left").groupBy("__id", "__h").agg(
        F.collect_list(F.struct("key", "seg", "at", "n", "hot")).alias("cuts")
    )
    segments = shared.stage(
        docs.join(cuts, ["__id", "__h"])
        .select("text", F.explode("cuts").alias("c"))
        .select("c.key", "c.seg", "c.hot", F.expr(f"substring(text, c.at + 1, c.n + {LENGTH - 1})").alias("bytes")),
        "repeat-segments",
    )
    once = segments.where("hot IS NULL")
    partial = sorted_repeats(once).unionByName(counted_repeats(segments.where("hot").distinct()))
    partial = shared.stage(partial.distinct(), "repeat-strings")
    shared.release(segments, hot)
    at, n = F.col("at"), F.col("n")
    whole = twice.where(~F.col("differ")).select("__id", "__h", at.alias("low"), (at + n + LENGTH - 1).alias("high"))
    copies = twice.where("differ").join(kinds.where("c > 1").select("key", "seg"), ["key", "seg"], "left_semi")
    copies = copies.select("__id", "__h", at.alias("low"), (at + n + LENGTH - 1).alias("high"))
    parts = (
        twice.where("differ")
        .join(partial, ["key", "seg"])
        .select("__id", "__h", (at + F.col("low")).alias("low"), (at + F.col("high") + LENGTH - 1).alias("high"))
    )
    spans = whole.unionByName(copies).unionByName(parts)
    gathered = spans.groupBy("__id", "__h").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    gathered = shared.stage(gathered, "repeat-spans")
    shared.release(twice, kinds, partial)
    return gathered


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns and kept (binary), n_bytes, n_removed, n_spans."""
    results = ["kept", "n_bytes", "n_removed", "n_spans"]
    names = [c for c in docs.columns if c not in results]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    digest = F.xxhash64(text)
    row, hashed, body, found = (shared.fresh(name, docs) for name in ("id", "h", "body", "spans"))
    keyed = docs.select(
        *names,
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit("null"), text)).alias(row),
        digest.alias(hashed),
        text.alias(body),
    )
    spans = repeated_spans(keyed.select(F.col(row).alias("__id"), F.col(hashed).alias("__h"), F.col(body).alias("text")))
    spans = spans.select(F.col("__id").alias(row), F.col("__h").alias(hashed), F.col("spans").alias(found))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, every = batch.column(len(names)), batch.column(len(names) + 1)
            kept, sizes, counts = [], [], []
            for body, own in zip(bodies, every, strict=True):
                whole = body.as_py()
                if not own.is_valid:
                    kept.append(whole)
                    counts.append(0)
                else:
                    edge = np.zeros(len(whole) + 1, np.int32)
                    np.add.at(edge, own.values.field("low").to_numpy(), 1)
                    np.add.at(edge, own.values.field("high").to_numpy(), -1)
                    mask = np.cumsum(edge)[:-1] > 0
                    kept.append(np.frombuffer(whole, np.uint8)[~mask].tobytes())
                    counts.append(len(stretches(mask)[0]))
                sizes.append(len(whole))
            left = np.array([len(k) for k in kept], np.int64)
            sizes = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(kept, pa.binary()),
                    pa.array(sizes),
                    pa.array(sizes - left),
                    pa.array(counts, pa.int64()),
                ],
                names=[*names, *results],
            )

    joined = keyed.join(spans, [row, hashed], "left").select(*names, body, found)
    kinds = [T.BinaryType(), T.LongType(), T.LongType(), T.LongType()]
    added = [T.StructField(name, kind) for name, kind in zip(results, kinds, strict=True)]
    return joined.mapInArrow(cut, T.StructType(docs.select(*names).schema.fields + added))

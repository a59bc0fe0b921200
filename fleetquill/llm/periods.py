"""Periodic runs of words: stretches that repeat a period three times or more.

A run is a maximal stretch with a smallest period q and a length of at least ``FACTOR`` * q and
``LEAST`` words. The words of a text are sorted as suffixes, and the tree of their common
prefixes (LCP intervals) is walked from the leaves up. An interval of ``n`` common words holds
the starts of one string; its children bring lists of starts, each start with the class of the
word on its left. Two starts of different children and different classes are a maximal pair:
it can be extended neither way. A pair whose distance p is at most n / (FACTOR - 1) spells a
stretch of p + n words with period p that no neighbour extends, so such pairs are the runs,
together with runs read at a multiple of their period: of pairs over one stretch the smallest
distance counts.

Pairs are found without looking at all of them. Starts of one string at most half its length
apart lie in an arithmetic progression, and all but its first have one word on the left. So the
smaller child's starts look into the larger one's list, kept in order of place: the next start
tells whether any after it pairs, and of those before it only the farthest can.

No run needs strings shorter than ``SEED`` words, so first every SEED words are hashed, and
only stretches whose strings occur twice in their text are sorted at all.

Everything happens within a text, so there is no shuffle; a text needs some 200 bytes of
memory a word while it is worked on.

Defined results: a null or empty text, or one of white space, has no words and no runs;
repeated rows are treated each; an empty table gives an empty table; other columns are kept, but
for columns named like the results, which are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetquill.llm import shared

LEAST = 24
FACTOR = 3
SEED = 16  # a run's pair has n >= 2p and p + n >= 24 words
BLOCK = 4 << 20
FEW = 8
RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


def codes_of(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_seeds(codes: np.ndarray, text: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places whose SEED words (by hash) occur twice in their text. ``last`` is the end of the
    text of every place."""
    n = len(codes)
    values = mixed(codes.astype(np.uint64) + np.uint64(1))
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < SEED:
        values = values[:-width] * np.uint64(factor) + values[width:]
        width, factor = 2 * width, factor * factor % 2**64
    places = np.flatnonzero(np.arange(n - SEED + 1) + SEED <= last[: n - SEED + 1])
    keys = mixed(values[places] + mixed(text[places].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(n, bool)
    twice[places[order[1:][same]]] = True
    twice[places[order[:-1][same]]] = True
    return twice


def stretches(twice: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words that strings of marked places cover. In a run no more than
    SEED / 2 places lie between two marked ones, so its strings overlap."""
    marked = np.flatnonzero(twice)
    new = np.append(True, (np.diff(marked) > SEED) | (np.diff(text[marked]) > 0))
    first = np.flatnonzero(new)
    return marked[first], marked[np.append(first[1:], len(marked)) - 1] + SEED


def suffixes(codes: np.ndarray, part: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all parts in order, part by part, and each one's common prefix with the
    one before it; by doubling. ``ends`` is the end of every place's part."""
    n = len(codes)
    at = np.arange(n)
    rank = np.unique(part * (codes.max() + 1) + codes, return_inverse=True)[1]
    small = np.int32 if n < 1 << 31 else np.int64
    levels, width = [rank.astype(small)], 1
    while rank.max() + 1 < n:
        follows = np.zeros(n, np.int64)
        inside = np.flatnonzero(at + width < ends)
        follows[inside] = rank[inside + width] + 1
        rank = np.unique(rank * (n + 1) + follows, return_inverse=True)[1]
        levels.append(rank.astype(small))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = at
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        fits = np.flatnonzero((a < ends[order[:-1]]) & (b < ends[order[1:]]))
        ranks = levels[level]
        equal = fits[ranks[a[fits]] == ranks[b[fits]]]
        a[equal] += step
        b[equal] += step
        common[equal + 1] += step
    return order, common


def join(a: list[int], b: list[int], n: int, left: list[int], found: list[tuple[int, int, int]]) -> list[int]:
    """The starts of two children of an interval of n common words, in order; their maximal
    pairs are added to ``found`` as (first start, distance, n)."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    reach = n // (FACTOR - 1)
    shortest = LEAST - n
    for start in small:
        own = left[start]
        k = bisect_right(large, start)
        if k < len(large) and large[k] <= start + reach and left[large[k]] != own:
            for other in large[k : bisect_right(large, start + reach)]:
                if other - start >= shortest:
                    found.append((start, other - start, n))
        k = bisect_left(large, start - reach)
        if k < len(large) and large[k] < start and left[large[k]] != own and start - large[k] >= shortest:
            found.append((large[k], start - large[k], n))
    if len(small) > FEW:
        return sorted(large + small)
    for start in small:
        insort(large, start)
    return large


def maximal_pairs(order: list[int], common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """The maximal pairs of strings of SEED words or more, by the intervals from below."""
    found: list[tuple[int, int, int]] = []
    open_intervals: list[list] = []
    starts = [order[0]]
    for k in range(1, len(order) + 1):
        n = common[k] if k < len(order) else 0
        while open_intervals and open_intervals[-1][0] > n:
            size, held = open_intervals.pop()
            starts = join(held, starts, size, left, found)
        if n >= SEED:
            if open_intervals and open_intervals[-1][0] == n:
                open_intervals[-1][1] = join(open_intervals[-1][1], starts, n, left, found)
            else:
                open_intervals.append([n, starts])
        if k < len(order):
            starts = [order[k]]
    return found


def runs(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of several texts, places counted over all of them,
    in order of start and period. Text k has the words offsets[k] to offsets[k + 1]."""
    none = (np.zeros(0, np.int64),) * 3
    sizes = np.diff(offsets)
    if len(codes) < LEAST:
        return none
    text = np.repeat(np.arange(len(sizes)), sizes)
    twice = repeated_seeds(codes, text, offsets[text + 1])
    if not twice.any():
        return none
    low, high = stretches(twice, text)
    # the stretches' words end to end
    lengths = high - low
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1]) + np.repeat(low - (ends - lengths), lengths)
    part = np.repeat(np.arange(len(low)), lengths)
    order, common = suffixes(codes[place], part, np.repeat(ends, lengths))
    first = place == offsets[text[place]]
    left = np.where(first, -1, codes[np.maximum(place - 1, 0)])
    # leaves that share too few words with both neighbours are in no interval
    deep = common >= SEED
    kept = deep | np.append(deep[1:], False)
    found = maximal_pairs(order[kept].tolist(), common[kept].tolist(), left.tolist()) if kept.any() else []
    if not found:
        return none
    start, period, n = np.array(found, np.int64).T
    start = place[start]
    by_stretch = np.lexsort((period, n + period, start))
    start, length, period = start[by_stretch], (n + period)[by_stretch], period[by_stretch]
    new = np.append(True, (np.diff(start) > 0) | (np.diff(length) > 0))
    start, length, period = start[new], length[new], period[new]
    ordered = np.lexsort((period, start))
    return start[ordered], length[ordered], period[ordered]


def repeats(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:-1] > 0


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and ``runs`` (start, length, period, in order of start and period; places
    are word numbers) and ``collapsed``, the words that stay when every run is cut back to
    its first period, joined by blanks."""
    results = ["runs", "collapsed"]
    names = [c for c in docs.columns if c not in results]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = shared.byte_view(batch.column(len(names)))
            for first, last in shared.blocks(bounds, BLOCK):
                words: list[bytes] = []
                offsets = [0]
                for row in range(first, last):
                    words += data[bounds[row] : bounds[row + 1]].tobytes().split()  # of bytes: ASCII white space
                    offsets.append(len(words))
                start, length, period = runs(codes_of(words), np.array(offsets))
                own = np.searchsorted(start, offsets)
                gone = repeats(len(words), start, length, period)
                collapsed = []
                for k in range(last - first):
                    low, high = offsets[k], offsets[k + 1]
                    if own[k] == own[k + 1]:
                        collapsed.append(b" ".join(words[low:high]))
                    else:
                        collapsed.append(b" ".join([words[at] for at in low + np.flatnonzero(~gone[low:high])]))
                inside = start - np.repeat(np.array(offsets[:-1]), np.diff(own))
                each = pa.StructArray.from_arrays([pa.array(c) for c in (inside, length, period)], ["start", "length", "period"])
                found = pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), each)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, last - first) for c in batch.columns[: len(names)]), found, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=[*names, *results],
                )

    given = docs.select(*names)
    body = shared.fresh("body", docs)
    schema = T.StructType(given.schema.fields + [T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return docs.select(*names, F.col(text_col).cast("string").alias(body)).mapInArrow(search, schema)

"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a bounded sample of vectors, at most ``SAMPLE`` in the order of a hash
of their ids, by k-means whose distances carry a penalty for full clusters, so that the
lists are balanced. Every vector is indexed: in the list of its nearest centroid and, if it
lies near a boundary, also in those whose centroid is at most ``1 + REPLICATE`` times as far.
Centroids are found by walking a graph of their nearest neighbours in memory. A query reads
the lists whose centroid is at most ``1 + PRUNE`` times as far as its nearest one, and at
least so many that they hold ``LEAST`` vectors; there it is compared with every vector.

A list is dealt out in parts of at most about ``PART`` vectors and its queries in parts of at
most about ``ASKING``; every part of the one meets every part of the other in a group of its
own, so no list, however full or often asked, meets in one task. Number of centroids, and so what is sent
to executors, is bounded by the sample's size.

Defined results: vectors that are null, zero, hold null or non-finite components, or have
another length than most, take no part, neither as queries nor as candidates; rows without
id take none either; rows equal in id and vector count once, an id with different vectors
is a candidate with each; ties go to the smaller id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetquill.llm import shared

SAMPLE = 20_000
LIST = 128
ROUNDS = 8
DEGREE = 16
BEAM = 32
REPLICATE = 0.15
COPIES = 8
PRUNE = 0.25
LEAST = 2_000
PART = 10_000
ASKING = 5_000
FAR = 1e5
HUGE = 2.0**500


@dataclass
class Index:
    centroids: np.ndarray
    graph: np.ndarray  # nearest other centroids of each
    entries: np.ndarray  # where a walk starts
    unit: float  # power of two near the usual largest component


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the rows that take part, as doubles, each once."""
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    widths = finite.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    return finite.where(F.size("v") == (widths[0]["w"] if widths else 0)).distinct()


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0)


def balanced_means(x: np.ndarray, k: int) -> np.ndarray:
    """k-means in which a cluster above its share grows farther away; no more centroids than
    there are different vectors."""
    random = np.random.default_rng(11)
    different = np.unique(x, axis=0, return_index=True)[1]
    k = min(k, len(different))
    centroids = x[random.permutation(np.sort(different))[:k]].copy()
    share = len(x) / k
    load = np.full(k, share)
    for _ in range(ROUNDS):
        owner = np.empty(len(x), np.int64)
        scale = None
        for low in range(0, len(x), 2048):
            d = squared(x[low : low + 2048], centroids)
            scale = scale or float(d.min(axis=1).mean())
            owner[low : low + 2048] = (d + 0.1 * scale * (load / share - 1)[None]).argmin(axis=1)
        load = np.bincount(owner, minlength=k).astype(np.float64)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, x)
        filled = load > 0
        centroids[filled] = sums[filled] / load[filled, None]
        empty = np.flatnonzero(~filled)
        if len(empty):  # start anew inside the fullest clusters
            full = np.argsort(-load)[: min(len(empty), int(filled.sum()))]
            centroids[empty[: len(full)]] = [x[random.choice(np.flatnonzero(owner == c))] for c in full]
    return centroids


def fit(vectors: DataFrame, sample: int = SAMPLE, per_list: int = LIST) -> Index | None:
    n = vectors.count()
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    if not n:
        return None
    x = np.array(rows.column(0).combine_chunks().flatten(), np.float64).reshape(rows.num_rows, -1)
    unit = float(np.exp2(np.floor(np.log2(np.median(np.abs(x).max(axis=1))))))
    x = shape(x, unit)
    centroids = balanced_means(x, int(min(max(1, n // per_list), max(1, len(x) // 8))))
    k = len(centroids)
    degree = min(DEGREE, k)
    graph = np.concatenate(
        [np.argsort(squared(centroids[low : low + 512], centroids), axis=1)[:, :degree] for low in range(0, k, 512)]
    )
    entries = np.random.default_rng(5).permutation(k)[: max(BEAM, int(2 * k**0.5))]
    return Index(centroids, graph, entries, unit)


def shape(x: np.ndarray, unit: float) -> np.ndarray:
    """Vectors as the index sees them: in units of the usual size, and no component farther
    than ``FAR`` units, so that squares neither overflow nor drown the others. Distances
    that are returned come from the vectors themselves."""
    return np.clip(x / unit, -FAR, FAR)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; numbers whose squares would overflow are
    scaled by a power of two, which loses nothing."""
    if max(np.abs(x).max(initial=0), np.abs(q).max(initial=0)) < HUGE:
        return np.sqrt(((x - q[None]) ** 2).sum(axis=1))
    top = np.maximum(np.abs(x).max(axis=1), np.abs(q).max())
    scale = np.where(top < HUGE, 1.0, np.exp2(np.floor(np.log2(np.maximum(top, 1.0))) - 400))[:, None]
    return np.sqrt(((x / scale - q[None] / scale) ** 2).sum(axis=1)) * scale[:, 0]


def walk(index: Index, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroids of every vector, as far as the walk finds them: numbers and
    squared distances, nearest first; a number that repeats has distance infinity."""
    k = len(index.centroids)
    beam = min(BEAM, k)
    d = squared(x, index.centroids[index.entries])
    take = np.argsort(d, axis=1)[:, :beam]
    best = index.entries[take]
    if best.shape[1] < beam:
        best = np.pad(best, ((0, 0), (0, beam - best.shape[1])), mode="edge")
    norms = (index.centroids**2).sum(axis=1)
    xx = (x * x).sum(axis=1)
    for _ in range(12):
        seen = np.sort(np.concatenate([best, index.graph[best[:, : beam // 2]].reshape(len(x), -1)], axis=1), axis=1)
        again = np.concatenate([np.zeros((len(x), 1), bool), seen[:, 1:] == seen[:, :-1]], axis=1)
        dots = np.einsum("qd,qcd->qc", x, index.centroids[seen])
        d = np.where(again, np.inf, np.maximum(xx[:, None] + norms[seen] - 2 * dots, 0))
        order = np.argsort(d, axis=1, kind="stable")[:, :beam]
        new = np.take_along_axis(seen, order, axis=1)
        near = np.take_along_axis(d, order, axis=1)
        if (new == best).all():
            break
        best = new
    return best, near


def assigned(index: Index, x: np.ndarray, reach: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: the nearest lists, as far as ``reach`` times the first's distance."""
    best, near = walk(index, x)
    chosen = near <= (1 + reach) ** 2 * near[:, :1]
    chosen[:, most:] = False
    row, column = np.nonzero(chosen & np.isfinite(near))
    return row, best[row, column]


def parts_of(index: Index) -> tuple:
    """The index as plain arrays, which workers without this module can take."""
    return index.centroids, index.graph, index.entries, index.unit


def vectors_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def postings(vectors: DataFrame, index: Index) -> DataFrame:
    """(list, vec_id, v): every vector in its lists."""
    sent = vectors.sparkSession.sparkContext.broadcast(parts_of(index))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*sent.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                row, where = assigned(own, shape(vectors_of(part.column(1)), own.unit), REPLICATE, COPIES)
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where), part.column(0).take(rows), part.column(1).take(rows)], names=["list", "vec_id", "v"]
                )

    return vectors.mapInArrow(place, "list long, vec_id long, v array<double>")


def probes(queries: DataFrame, index: Index, sizes: dict[int, int]) -> DataFrame:
    """(list, query_id, q): the lists that each query reads."""
    context = queries.sparkSession.sparkContext
    load = np.array([sizes.get(k, 0) for k in range(len(index.centroids))], np.int64)
    sent = context.broadcast((parts_of(index), load))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = sent.value
        own = Index(*parts)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                best, near = walk(own, shape(vectors_of(part.column(1)), own.unit))
                before = np.cumsum(held[best], axis=1) - held[best]
                wanted = (near <= (1 + PRUNE) ** 2 * near[:, :1]) | (before < LEAST)
                row, column = np.nonzero(wanted & np.isfinite(near))
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best[row, column]), part.column(0).take(rows), part.column(1).take(rows)],
                    names=["list", "query_id", "q"],
                )

    return queries.mapInArrow(choose, "list long, query_id long, q array<double>")


def search(
    table: DataFrame, every: int, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, which are the rows
    whose id is divisible by ``every``; score is the Euclidean distance."""
    schema = "query_id long, vec_id long, score double"
    vectors = shared.stage(usable(table, id_col, vector_col), "vectors")
    index = fit(vectors)
    if index is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = postings(vectors, index)
    counted = {r["list"]: r["count"] for r in lists.groupBy("list").count().collect()}  # a row per centroid
    chosen = shared.stage(probes(vectors.where(F.col("vec_id") % every == 0), index, counted), "probes")
    asking = {r["list"]: r["count"] for r in chosen.groupBy("list").count().collect()}
    part_rows = [(c, 1 + n // PART, 1 + asking.get(c, 0) // ASKING) for c, n in counted.items()]
    part_kinds = "list long, parts int, turns int"

    def with_parts(df: DataFrame) -> DataFrame:
        """Joined with the numbers of each list's parts: a row per centroid again."""
        return df.join(F.broadcast(table.sparkSession.createDataFrame(part_rows, part_kinds)), "list")

    def dealt_by(name: str, among: str) -> Column:
        return F.pmod(F.xxhash64(name, "list"), among).cast("int")

    def every_of(among: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(among) - 1))

    dealt = with_parts(lists).select(
        "list", dealt_by("vec_id", "parts").alias("part"), every_of("turns").alias("turn"), "vec_id", "v"
    )
    asked = with_parts(chosen).select(
        "list", every_of("parts").alias("part"), dealt_by("query_id", "turns").alias("turn"), "query_id", "q"
    )

    def nearest(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asking) and len(held):
            x = np.stack(held["v"].to_numpy())
            ids = held["vec_id"].to_numpy()
            for query, q in zip(asking["query_id"].to_numpy(), asking["q"].to_numpy(), strict=True):
                score = distances(x, q)
                others = np.flatnonzero(ids != query)
                if len(others) > 4 * k:
                    others = others[score[others] <= np.partition(score[others], k)[k]]
                top = others[np.lexsort((ids[others], score[others]))][:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[top], "score": score[top]}))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return pd.concat(out)

    found = (
        asked.groupBy("list", "part", "turn")
        .cogroup(dealt.groupBy("list", "part", "turn"))
        .applyInPandas(nearest, schema)
        .distinct()
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

"""Centroid clustering with exact integers, filtered by n-simplex projection.

Vectors are integers, floor(1024 * x) of each component. Distances to a few fixed pivots place
a vector over the simplex that the pivots span: its apex has one coordinate along each edge of
that base and, last, its height above it. Apexes are worked out once and stored with the
vectors. For any two, the Euclidean distance of the apexes is a lower bound of the vectors'
distance, and that to the other's mirror image below the base is an upper bound. A centroid
whose lower bound is above another's upper bound cannot be nearest; those left are compared by
exact integer distances. The bounds are doubles with a margin far above their rounding error,
so they only save comparisons and never decide one.

As many pivots as components, the default, place vectors exactly up to rounding; fewer do for
vectors that lie near a plane of few dimensions.

A round is one pass over the stored vectors: every task assigns its own and adds them up, and
what reaches the driver are sums per cluster and component, a number of rows that does not
depend on the table. Sums are kept in limbs of 30 bits, so they are exact at any size.

Defined results: vectors take part if they have exactly ``width`` components, none null or not
finite; a null id takes part but starts no centroid; rows that repeat count each, and of rows
that tie in the order of starting centroids the smaller vector comes first; with fewer vectors
than centroids there are as many centroids as vectors with an id; ties go to the smaller
number; a distance or sum beyond a long is null (components above about 2^27); an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared

WIDTH = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
PIVOTS = 64
LIMB = 30
SMALL = 1 << 27  # of 64 such components, squared distances fit into a long
FAR = 1 << 33
MARGIN = 4e-6  # relative; apexes are stored with 24 bits
BLOCK = 2048


def usable(table: DataFrame, id_col: str, vector_col: str, width: int) -> DataFrame:
    """(vec_id, v): the vectors that take part."""
    v = F.col("v")
    kind = table.schema[vector_col].dataType.simpleString()
    kind = "array<float>" if kind == "array<float>" else "array<double>"
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    return rows.where((F.size("v") == width) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def integers(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """floor(1024 x) of every component, and the rows for which that is small; the others'
    integers are given by ``large``."""
    small = (np.abs(v) <= SMALL / SCALE).all(axis=1)
    return np.floor(np.where(small[:, None], v, 0.0) * SCALE).astype(np.int64), small


def large(v: np.ndarray) -> list[int]:
    """The same of one vector, as integers without a limit."""
    return [(n * SCALE) // d for n, d in (float(x).as_integer_ratio() for x in v)]


def squared(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def fits(c: list[int]) -> bool:
    return all(abs(x) <= SMALL for x in c)


@dataclass
class Base:
    """The simplex that pivots span: a corner, the others' coordinates in it."""

    pivots: np.ndarray  # [pivot, component], integers
    edges: np.ndarray  # lower triangular: pivot k + 1 in the coordinates of the base


def base_of(candidates: list[list[int]]) -> Base | None:
    """A well-shaped base: a candidate close to the span of those before is left out."""
    held = [c for c in candidates if fits(c)]
    if not held:
        return None
    corner = np.array(held[0], np.float64)
    chosen, axes = [held[0]], np.zeros((0, len(corner)))
    for c in held[1:]:
        way = np.array(c, np.float64) - corner
        rest = way - axes.T @ (axes @ way)
        rest -= axes.T @ (axes @ rest)
        if np.linalg.norm(rest) > 0.05 * np.linalg.norm(way) > 0:
            chosen.append(c)
            axes = np.vstack([axes, rest / np.linalg.norm(rest)])
    pivots = np.array(chosen, np.int64)
    return Base(pivots, (pivots[1:] - pivots[0]).astype(np.float64) @ axes.T)


def apexes(base: Base, x: np.ndarray) -> np.ndarray:
    """Apex coordinates from the distances to the pivots, height last."""
    d = np.stack([((x - p) ** 2).sum(axis=1) for p in base.pivots], axis=1).astype(np.float64)
    lengths = (base.edges**2).sum(axis=1)
    right = (d[:, :1] + lengths[None] - d[:, 1:]) / 2
    along = np.zeros_like(right)
    for k in range(len(base.edges)):  # forward substitution, all vectors at once
        along[:, k] = (right[:, k] - along[:, :k] @ base.edges[k, :k]) / base.edges[k, k]
    height = np.sqrt(np.maximum(d[:, 0] - (along**2).sum(axis=1), 0))
    return np.concatenate([along, height[:, None]], axis=1)


def candidates(apex: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """[vector, centroid]: could the centroid be nearest, by lower and upper bounds."""
    own, theirs = (apex**2).sum(axis=1)[:, None], (centres**2).sum(axis=1)[None]
    along = own + theirs - 2 * apex[:, :-1] @ centres[:, :-1].T
    heights = 2 * apex[:, -1:] * centres[:, -1]
    margin = MARGIN * (own + theirs.max()) + 1
    return along - heights <= (along + heights).min(axis=1, keepdims=True) + margin


def assign(
    centroids: list[list[int]], base: Base | None, v: np.ndarray, apex: np.ndarray
) -> tuple[np.ndarray, list[int | None], np.ndarray, np.ndarray]:
    """Each vector's cluster and squared distance (None beyond a long), its integers, and
    which of them are small."""
    x, small = integers(v)
    plain = [k for k, c in enumerate(centroids) if fits(c)]
    # a centroid with a component beyond FAR is farther from a small vector than any small one
    between = any(not fits(c) and max(map(abs, c)) < FAR for c in centroids)
    if plain and not between:
        c = np.array([centroids[k] for k in plain], np.int64)
        near = np.ones((len(v), len(c)), bool) if base is None else candidates(apex, apexes(base, c))
        row, column = np.nonzero(near)
        d = ((x[row] - c[column]) ** 2).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(v)))  # a vector has one candidate at least
        order = np.lexsort((column, d, row))[first]
        owner, distance = np.array(plain)[column[order]], d[order]
        hard = np.flatnonzero(~small)
    else:
        owner, distance = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        hard = np.arange(len(v))
    out: list[int | None] = distance.tolist()
    for k in hard.tolist():
        own = large(v[k])
        d, owner[k] = min((squared(own, c), number) for number, c in enumerate(centroids))
        out[k] = d if d < 1 << 63 else None
    return owner, out, x, small


def limbs(number: int) -> Iterator[tuple[int, int]]:
    sign, rest, place = (1 if number >= 0 else -1), abs(number), 0
    while rest:
        yield place, sign * (rest & (1 << LIMB) - 1)
        rest, place = rest >> LIMB, place + 1


def sums(owner: np.ndarray, v: np.ndarray, x: np.ndarray, small: np.ndarray, k: int) -> list[tuple[int, int, int, int]]:
    """(cluster, component, limb, sum); component -1 counts the vectors."""
    out = []
    total = np.zeros((k, x.shape[1]), np.int64)
    np.add.at(total, owner[small], x[small])
    for cluster in np.unique(owner).tolist():
        out.append((cluster, -1, 0, int((owner == cluster).sum())))
        out += [(cluster, i, 0, s) for i, s in enumerate(total[cluster].tolist())]
    for row in np.flatnonzero(~small).tolist():
        for i, number in enumerate(large(v[row])):
            out += [(int(owner[row]), i, place, part) for place, part in limbs(number)]
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists of numbers as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), len(values) // max(len(column), 1))


def moved(vectors: DataFrame, centroids: list[list[int]], base: Base | None, width: int) -> list[list[int]]:
    """The centroids after one round."""
    fixed = None if base is None else (base.pivots, base.edges)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if fixed is None else Base(*fixed)
        for batch in batches:
            rows = []
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                v = matrix(part.column(0))
                owner, _, x, small = assign(centroids, own, v, matrix(part.column(1)))
                rows += sums(owner, v, x, small, len(centroids))
            cluster, component, limb, s = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (cluster, component, limb, s)], names=["cluster", "component", "limb", "s"]
            )

    parts = vectors.select("v", "apex").mapInArrow(add, "cluster long, component long, limb long, s long")
    total = parts.groupBy("cluster", "component", "limb").agg(F.sum(F.col("s").cast("decimal(28,0)")).alias("s"))
    sizes, added = {}, {}
    for row in total.collect():  # clusters * components * limbs of a double at most
        if row["component"] < 0:
            sizes[row["cluster"]] = int(row["s"])
        else:
            key = row["cluster"], row["component"]
            added[key] = added.get(key, 0) + (int(row["s"]) << LIMB * row["limb"])
    return [
        [added.get((k, i), 0) // sizes[k] for i in range(width)] if k in sizes else c for k, c in enumerate(centroids)
    ]


def with_apexes(vectors: DataFrame, base: Base | None) -> DataFrame:
    """(vec_id, v, apex): stored once, read in every round."""
    fixed = None if base is None else (base.pivots, base.edges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = integers(matrix(batch.column(1)))
            apex = apexes(Base(*fixed), x) if fixed else np.zeros((len(x), 1))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * apex.shape[1]
            own = pa.ListArray.from_arrays(pa.array(offsets), pa.array(apex.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=["vec_id", "v", "apex"])

    return vectors.mapInArrow(place, f"vec_id long, v {vectors.schema['v'].dataType.simpleString()}, apex array<float>")


def centroid_digest(c: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()


def by_cluster(values: list, kind: str) -> Column:
    return F.get(F.array(*[F.lit(value).cast(kind) for value in values]), F.col("cluster"))


def cluster(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = WIDTH,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = shared.stage(usable(table, id_col, vector_col, width), "cluster-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.where("vec_id IS NOT NULL").orderBy(order, "v").limit(max(k, pivots)).select("v").collect()
    drawn = [large(row["v"]) for row in first]
    centroids = drawn[:k]
    if not centroids:
        return table.sparkSession.createDataFrame([], schema)
    base = base_of(drawn)
    placed = shared.stage(with_apexes(vectors, base), "cluster-apexes")
    shared.release(vectors)
    for _ in range(rounds):
        centroids = moved(placed, centroids, base, width)
    fixed = None if base is None else (base.pivots, base.edges)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if fixed is None else Base(*fixed)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                v = matrix(part.column(1))
                owner, distance, _, _ = assign(centroids, own, v, matrix(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(owner.astype(np.int32)), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    settled = shared.stage(placed.mapInArrow(settle, "vec_id long, cluster int, distance long"), "clusters")
    shared.release(placed)
    # a distance beyond a long makes the sums it belongs to null
    exact = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    added = {row["cluster"]: row["s"] for row in settled.groupBy("cluster").agg(exact.alias("s")).collect()}
    inertia = [int(added[c]) if added.get(c) is not None and added[c] < 1 << 63 else None for c in range(len(centroids))]
    whole = None if any(s is None for s in added.values()) else int(sum(added.values()))
    return settled.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(whole if whole is None or whole < 1 << 63 else None).cast("long").alias("inertia"),
        by_cluster([centroid_digest(c) for c in centroids], "string").alias("centroid_sha256"),
    )

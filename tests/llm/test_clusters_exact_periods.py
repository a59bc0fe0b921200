"""Clusters, exact duplicates and periodic runs against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetquill.llm import clusters, exact, periods, queries, shared

SF = "/root/testdata/sf0.001"


# clusters


def floor_1024(x):
    return Fraction(x) * 1024 // 1


def plain_clusters(table, k=8, rounds=10, seed=3):
    vectors = [(i, [int(floor_1024(x)) for x in v]) for i, v in table]
    named = [p for p in zip(vectors, table, strict=True) if p[0][0] is not None]
    named.sort(key=lambda p: (hashlib.sha256(f"{seed}:{p[0][0]}".encode()).hexdigest(), p[1][1]))
    centres = [p[0][1] for p in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        owner = [nearest(v)[1] for _, v in vectors]
        for n in range(len(centres)):
            mine = [v for (_, v), o in zip(vectors, owner, strict=True) if o == n]
            if mine:
                centres[n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    final = [nearest(v) for _, v in vectors]

    def held(x):
        return x if x < 1 << 63 else None

    out = []
    for (i, _), (d, n) in zip(vectors, final, strict=True):
        inside = [e for e, m in final if m == n]
        big = any(e >= 1 << 63 for e in inside)
        every = any(e >= 1 << 63 for e, _ in final)
        out.append(
            (i, n, held(d), None if big else held(sum(inside)), None if every else held(sum(e for e, _ in final)),
             hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
        )
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))


def vectors_of(draw, n, spread=1.0):
    return [[draw.gauss(0, spread) for _ in range(64)] for _ in range(n)]


def cluster_rows(spark, table):
    return rows(clusters.cluster(spark.createDataFrame(table, "vec_id long, embedding array<double>")))


def test_clusters_equal_plain_ones(spark):
    draw = random.Random(4)
    groups = vectors_of(draw, 5, 3.0)
    table = [(i, [a + draw.gauss(0, 0.5) for a in groups[i % 5]]) for i in range(70)]
    table += [(None, groups[0]), (500, groups[1]), (500, groups[1]), (501, [-1e-9] * 64), (502, [0.0] * 64)]
    assert cluster_rows(spark, table) == plain_clusters(table)


def test_clusters_of_huge_and_of_few_vectors(spark):
    draw = random.Random(5)
    huge = [(i, v) for i, v in enumerate(vectors_of(draw, 20))]
    huge += [(100, [1e300] * 64), (101, [-1e300] + [0.5] * 63), (102, [3e5] * 64), (103, [1.7e308] * 64), (104, [1e7] * 64)]
    assert cluster_rows(spark, huge) == plain_clusters(huge)
    for table in ([(1, [0.25] * 64)], [(i, [1.0] * 64) for i in range(30)], huge[:3]):
        assert cluster_rows(spark, table) == plain_clusters(table)


def test_clusters_leave_out_what_takes_no_part(spark):
    bad = [(1, None), (2, []), (3, [1.0] * 63), (4, [None] + [1.0] * 63), (5, [float("nan")] * 64), (6, [float("inf")] * 64)]
    assert cluster_rows(spark, bad) == []
    assert [r[0] for r in cluster_rows(spark, [*bad, (7, [2.0] * 64)])] == [7]
    clash = spark.createDataFrame([(7, [2.0] * 64, 1, "x")], "vec_id long, embedding array<double>, cluster int, apex string")
    assert clusters.cluster(clash).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_never_rule_out_the_nearest():
    draw = np.random.default_rng(2)
    for shape in range(20):
        x = (draw.normal(size=(200, 64)) * 10 ** draw.uniform(2, 6)).astype(np.int64)
        if shape % 2:
            x[:, 3:] = 0  # a plane holds all of them
        base = clusters.base_of(x[:16].tolist())
        near = clusters.candidates(clusters.apexes(base, x), clusters.apexes(base, x[50:58]))
        d = ((x[:, None] - x[None, 50:58]) ** 2).sum(axis=2)
        assert near[d == d.min(axis=1, keepdims=True)].all()
        if shape % 2:
            assert near.sum() < near.size


# exact duplicates


def plain_exact(table):
    """(doc_id, keep_id, group_size, kept) without regard to which of equal rows is kept."""
    def norm(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    groups = {}
    for i, t in table:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            stays = i == top and not kept
            kept |= stays
            out.append((i, top, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))


TEXTS = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, None), (5, ""), (None, ""), (6, "Äbc"), (7, "äbc"), (8, "x" * 300_000), (9, "X" * 300_000)]
TEXTS += [(10, "same"), (10, "same"), (10, "SAME"), (None, "alone"), (None, "alone"), (11, "İI"), (12, "i̇i")]


def report(df):
    return rows(df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))))


def test_exact_duplicates_equal_plain_ones(spark, folder):
    index = exact.open_index(spark, f"{folder}/index")
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert report(exact.add(index, docs)) == plain_exact(TEXTS)
    assert report(exact.add(index, docs)) == plain_exact(TEXTS), "a batch added again gives the same answer"
    assert index.entries(spark).count() == len({t[4] for t in plain_exact(TEXTS)})
    assert exact.add(index, docs.limit(0)).count() == 0


def test_exact_index_outlives_its_session(spark, folder):
    first = exact.open_index(spark, f"{folder}/index", buckets=3)
    exact.add(first, spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")).count()
    exact.close(spark, first)
    again = exact.open_index(spark, f"{folder}/index")
    assert again == first
    later = spark.createDataFrame([(9, "A"), (10, "c"), (11, "c"), (5, "a")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact.add(again, later).collect()}
    assert got == {9: (5, False), 5: (5, False), 10: (11, False), 11: (11, True)}
    assert {tuple(r) for r in again.entries(spark).select("doc_id").collect()} == {(5,), (6,), (11,)}


def test_exact_anti_join_does_not_shuffle_the_index(spark, folder, capsys):
    index = exact.open_index(spark, f"{folder}/index", buckets=4)
    exact.add(index, spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")).count()
    rows_ = spark.createDataFrame([(7, "a")], "doc_id long, text string").select(exact.digest(F.col("text")).alias("digest"))
    exact.unknown(rows_.groupBy("digest").count(), index).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_exact_unique_keeps_all_columns(spark, folder):
    index = exact.open_index(spark, f"{folder}/index")
    docs = spark.createDataFrame(
        [(1, "a", "x", 1), (2, "A", "y", 2), (2, "A", "y", 2), (3, None, "z", 3)], "doc_id long, text string, digest string, kept int"
    )
    assert rows(exact.unique(index, docs)) == [(2, "A", "y", 2), (3, None, "z", 3)]


# periodic runs


def plain_runs(words):
    """Every (start, length, smallest period) by its definition."""
    n = len(words)
    best = {}
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(24, 3 * q):
                best.setdefault((at, end + q - at), q)
            at = end + 1
    return sorted((s, length, q) for (s, length), q in best.items())


def plain_periods(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    top = min(found, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2])) if found else None
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    shown = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(found), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def repetitive(draw):
    """Words of a small alphabet: powers of words, with slips, one after the other."""
    words = []
    for _ in range(draw.randint(1, 5)):
        base = [draw.choice("abc") for _ in range(draw.randint(1, 9))]
        part = base * draw.randint(1, 14)
        if draw.random() < 0.4:
            part[draw.randrange(len(part))] = draw.choice("abcd")
        words += part[: draw.randint(1, len(part))]
    return words * draw.choice([1, 1, 1, 3, 4])


def test_runs_equal_plain_ones():
    draw = random.Random(8)
    texts = [repetitive(draw) for _ in range(400)]
    texts += [[], ["a"] * 23, ["a"] * 24, ["a", "b"] * 12, list("abcdefgh") * 3, list("abcdefghi") * 3, list("abcdefghi") * 2 + list("abcdefgh")]
    texts += [[draw.choice("ab") for _ in range(300)] for _ in range(40)]
    for size in (1, 7, len(texts)):  # texts of one block do not see each other
        for low in range(0, len(texts), size):
            block = texts[low : low + size]
            offsets = np.cumsum([0] + [len(t) for t in block])
            words = [w.encode() for t in block for w in t]
            start, length, period = periods.runs(periods.codes_of(words), offsets)
            for k, text in enumerate(block):
                own = (start >= offsets[k]) & (start < offsets[k + 1])
                got = list(zip((start[own] - offsets[k]).tolist(), length[own].tolist(), period[own].tolist(), strict=True))
                assert got == plain_runs(text), text


@pytest.mark.parametrize("words", [["a"] * 200_000, list("abcdefg") * 30_000, (["x"] * 500 + ["y"]) * 300])
def test_long_periodic_texts(words):
    start, length, period = periods.runs(periods.codes_of([w.encode() for w in words]), np.array([0, len(words)]))
    assert (0, len(words)) in set(zip(start.tolist(), length.tolist(), strict=True))
    assert len(start) in (1, 301)


def test_op13_equals_plain(spark, folder):
    draw = random.Random(3)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    texts += [(k, " ".join(repetitive(draw))) for k in range(1000, 1400)]
    texts += [(2000, None), (2001, ""), (2002, " \t\n"), (None, "a " * 30), (2003, "a " * 30), (2003, "a " * 30), (2004, "ä b " * 40)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = rows(queries.op13_periods(spark, folder))
    assert got == sorted((plain_periods(*t) for t in texts), key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_periods_keep_other_columns(spark):
    docs = spark.createDataFrame([("a " * 30, "r", 1, "b")], "text string, runs string, body int, BODY2 string")
    got = periods.find(docs)
    assert got.columns == ["text", "body", "BODY2", "runs", "collapsed"]
    assert [(r.body, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()] == [(1, [(0, 30, 1)], "a")]
    assert periods.find(docs.limit(0)).count() == 0


def test_released_tables_are_gone(spark):
    staged = shared.stage(spark.range(3), "gone")
    place = staged.staged_at
    shared.release(staged)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(place)

"""Near duplicates, decontamination and repeats against brute force."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from fleetquill.llm import components, decontamination, queries, repeats, simhash

SF = "/root/testdata/sf0.001"


def texts_of(spark, name="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*(("doc_id", "text") if name == "documents" else ("item_id", "text"))).collect()]


# SimHash


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    f, root = np.array(prints, np.uint64), list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b, key=lambda x: ids[x])] = min(a, b, key=lambda x: ids[x])
    return [ids[find(k)] for k in range(len(ids))]


def check_components(spark, rows):
    prints = [plain_print(t) for _, t in rows]
    want = {i: (f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, plain_components([i for i, _ in rows], prints), strict=True)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df).select("doc_id", simhash.hexadecimal(simhash.F.col("fp")).alias("f"), "component_id")
    assert {r.doc_id: (r.f, r.component_id) for r in got.collect()} == want


def test_simhash_equals_all_pairs(spark):
    odd = [(5000, ""), (5001, None), (4999, " \t\n"), (5002, "one"), (5003, "One"), (5004, "one two"), (5005, "ÉÀ é\x85x　y \x1f z")]
    draw = random.Random(2)
    long_text = " ".join(str(draw.randint(0, 10**6)) for _ in range(20_000))
    near = []
    for k in range(60):  # copies with a few words changed each
        words = long_text.split()[:400]
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(400)] = "changed"
        near.append((6000 + k, " ".join(words)))
    check_components(spark, texts_of(spark) + odd + [(5010, long_text), (5011, long_text + " end")] + near)


def test_query_3_returns_every_row(spark):
    assert queries.op3_simhash(spark, SF).count() == len(texts_of(spark))


def test_every_pair_within_the_radius_shares_a_key_and_is_linked():
    draw = np.random.default_rng(0)
    base = draw.integers(0, 2**63, 150, dtype=np.uint64) * np.uint64(2)
    prints = [base]
    for flips in (1, 2, 3, 3, 4):
        changed = base.copy()
        for _ in range(flips):
            changed ^= np.uint64(1) << draw.integers(0, 64, len(base)).astype(np.uint64)
        prints.append(changed)
    prints = np.unique(np.concatenate(prints)).view(np.int64)
    keys = []
    for block in range(4):
        left_out = 0xFFFF << (16 * block)
        for flip in [0] + [1 << b for b in range(64) if not left_out >> b & 1]:
            other = np.uint64(flip | (block + 1) << (16 * block))
            keys.append((prints.view(np.uint64) & np.uint64(~left_out & 2**64 - 1)) ^ other)
    keys, fps = np.concatenate(keys).view(np.int64), np.tile(prints, len(keys))
    order = np.lexsort((fps, keys))
    a, b = simhash.run_edges(keys[order], fps[order])
    got, want = {}, {}
    pairs = [(int(x), int(y)) for k, x in enumerate(prints) for y in prints[k + 1 :][simhash.near(x, prints[k + 1 :])]]
    for edges, out in ((zip(a.tolist(), b.tolist(), strict=True), got), (pairs, want)):
        out.update({int(p): int(p) for p in prints})
        for x, y in edges:
            while out[x] != x:
                x = out[x]
            while out[y] != y:
                y = out[y]
            out[max(x, y)] = min(x, y)
        for p in sorted(out):
            out[p] = out[out[p]]
    assert got == want


def test_keys_with_many_members_are_compared_whole(monkeypatch):
    draw = np.random.default_rng(3)
    members = np.unique(draw.integers(0, 2**10, 400, dtype=np.int64))
    whole = simhash.forest(members)
    monkeypatch.setattr(simhash, "SMALL", 64)
    assert (simhash.forest(members) == whole).all()


def test_stars_of_chains_and_rings(spark):
    draw = random.Random(1)
    chain = [(k, k + 1) for k in range(0, 60)]
    ring = [(100 + k, 100 + (k + 1) % 9) for k in range(9)]
    hub = [(200, 201 + k) for k in range(50)]
    edges = [(min(e), max(e)) for e in chain + ring + hub] * 2
    draw.shuffle(edges)
    got = components.stars(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {(0, k) for k in range(1, 61)} | {(100, 100 + k) for k in range(1, 9)} | {(200, 201 + k) for k in range(50)}
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)
    assert components.stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark):
    text = "a text with several words that others copy"
    rows = [(5, text, "k"), (3, text, "l"), (3, text, "l"), (9, "another text altogether here", "m"), (None, text, "n"), (7, "", "o"), (8, None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    assert sorted((r.doc_id or -1, r.fp) for r in simhash.keep_one(df).collect()) == [(3, "l"), (7, "o"), (9, "m")]
    assert simhash.keep_one(df.limit(0)).count() == 0


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_hits(docs, items):
    windows, sizes = defaultdict(set), set()
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(13, len(words))
        sizes.add(n)
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add(str(item))
    out = Counter()
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes - {0}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        out[doc, len(words), len(hit), tuple(sorted(found))] += 1
    return out


def annotated(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in decontamination.annotate(df, bench).collect())


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_ROWS, -1])
def test_hits_equal_plain_ones(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    draw = random.Random(8)
    items = texts_of(spark, "benchmark") + [(900, "Die kurze Übung"), (901, "a a a a a a a a a a a a a a a"), (902, None), (903, ""), (904, "word"), (900, "again the same id")]
    docs = texts_of(spark)
    for k in range(120):
        words = []
        for _ in range(draw.randint(1, 4)):
            own = (draw.choice(items)[1] or "").split()
            low = draw.randint(0, len(own))
            words += own[low : low + draw.randint(1, 30)] + ["filler"] * draw.randint(0, 3)
        docs.append((10_000 + k, " ".join(words).upper() if k % 3 else ", ".join(words)))
    docs += [(20_000, None), (20_001, ""), (20_002, "a " * 3000), (20_003, "die KURZE Übung!"), (20_004, "die kurze übung"), (None, "word"), (20_005, "word"), (20_005, "word")]
    assert annotated(spark, docs, items) == plain_hits(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    df = spark.createDataFrame([(1, "some words here", "x", 3)], "doc_id long, text string, place string, n_hit int")
    row = decontamination.annotate(df, bench).first()
    assert (row.place, row.n_hit, row.item_ids) == ("x", 2, ["1"])
    assert decontamination.annotate(df, bench.limit(0)).first().n_hit == 0
    assert decontamination.annotate(df.limit(0), bench).count() == 0


def test_query_6(spark):
    got = queries.op6_decontamination(spark, SF).collect()
    want = plain_hits(texts_of(spark), texts_of(spark, "benchmark"))
    sha = {(d, w, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0 and 20 * h >= w) for d, w, h, i in want}
    assert {tuple(r) for r in got} == sha
    plan = queries.op6_decontamination(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# repeats


def plain_repeats(docs, length=200):
    counts = Counter()
    for _, text in docs:
        body = (text or "").encode()
        counts.update(body[k : k + length] for k in range(len(body) - length + 1))
    out = Counter()
    for doc, text in docs:
        body = (text or "").encode()
        mask = bytearray(len(body))
        for k in range(len(body) - length + 1):
            if counts[body[k : k + length]] > 1:
                mask[k : k + length] = b"\1" * length
        kept = bytes(b for b, m in zip(body, mask, strict=True) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and not (k and mask[k - 1]))
        out[doc, len(body), sum(mask), spans, kept] += 1
    return out


def awkward_texts():
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdeé \n") for _ in range(draw.randint(1, 9)))
    passage = " ".join(word() for _ in range(80))
    docs = [(k, " ".join(word() for _ in range(60)) + passage[k % 7 : len(passage) - k % 11] + " ".join(word() for _ in range(30))) for k in range(40)]
    period = "".join(draw.choice("xyz") for _ in range(37))
    docs += [(100, "a" * 500), (101, "a" * 200), (102, "a" * 199), (103, period * 20), (104, "b" + period * 9), (105, ""), (106, None)]
    docs += [(107, passage), (107, passage), (None, passage), (108, passage[:200]), (109, passage[:199])]
    base = " ".join(word() for _ in range(400))
    for k in range(30):
        at = draw.randrange(len(base))
        docs.append((200 + k, base[:at] + "#" + base[at + 1 :]))
    return docs


@pytest.mark.parametrize(("split", "block"), [(2000, 1 << 20), (1, 700), (5, 1 << 20)])
def test_repeats_equal_plain_ones(spark, monkeypatch, split, block):
    monkeypatch.setattr(repeats, "SPLIT", split)
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "SORTED_BYTES", 4000)
    docs = awkward_texts()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, kept int")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove(df).collect())
    assert got == plain_repeats(docs)


def test_repeats_of_the_table_and_of_none(spark):
    got = {tuple(r) for r in queries.op7_repeats(spark, SF).collect()}
    want = {(d, n, m, s, hashlib.sha256(k).hexdigest()) for d, n, m, s, k in plain_repeats(texts_of(spark))}
    assert got == want
    assert repeats.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_array_orders_by_depth():
    draw = random.Random(6)
    for _ in range(200):
        text = bytes(draw.choice(b"abc\x00\xff") for _ in range(draw.randint(1, 120)))
        depth = draw.randint(1, 60)
        order = repeats.suffix_array(text, depth)
        assert sorted(order) == list(range(len(text)))
        keys = [text[k : k + depth] for k in order]
        assert keys == sorted(keys)

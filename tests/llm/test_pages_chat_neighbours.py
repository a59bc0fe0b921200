"""Archives and chat as round trips, neighbours by recall, the pipeline stage by stage."""

import base64
import hashlib
import os
import sys

import numpy as np
import pytest

import corpus_pipeline
from fleetquill.llm import chat, neighbours, queries, warc

SF = "/root/testdata/sf0.001"
sys.path.append(os.path.join(os.path.dirname(corpus_pipeline.__file__), "tools"))


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_arc_of_both_versions_is_parsed():
    for version in (1, 2):
        records = [("http://a/b", b"HTTP/1.1 200 OK\r\n\r\n<p>\n\nx"), ("http://a/with space", b""), ("x:", b"\r\n\r\n")]
        content = warc.arc_file("f.arc", version, "20010203040506", records)
        got = list(warc.parse_arc(content))
        assert [(r.fields["URL"], r.body) for r in got] == records
        assert all(r.fields["Archive-date"] == "20010203040506" for r in got)
        assert content[got[0].offset :].startswith(b"http://a/b")
        with pytest.raises(ValueError):
            list(warc.parse_arc(content[:-2]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"not an archive\n"))
    assert warc.timestamp("20010203040506") == "2001-02-03T04:05:06Z"


def test_archives_round_trip(spark, folder):
    rows = [
        (1, "http://a b/\n", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (5, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
        (6, "u", "big " * 400_000), (None, "u", "<p>é</p>"), (7, "u", "<p>é</p>"), (7, "u", "<p>é</p>"), (None, "u", "alone"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = f"{folder}/warc"
    warc.write(warc.with_revisits(warc.convert(warc.page_archives(pages, archive_bytes=1000))), path, archive_bytes=1000)
    largest = {}
    for page, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), page if page is not None else -1)
    want = []
    for page, _, html in rows:
        top = largest[html or ""]
        response = top == (page if page is not None else -1)
        body = (html or "").encode()
        want.append((page or -1, len(body), sha1(body), "response" if response else "revisit", None if response else top))
    got = warc.read(spark, path).collect()
    assert sorted(map(str, want)) == sorted(str((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert len({r.record_id for r in got}) == len(rows)
    assert {r.uri for r in got if r.page_id == 1} == {"http://a%20b/%0A"}
    for name in (n for n in os.listdir(path) if n.endswith(".txt")):  # whole files are WARC
        with open(os.path.join(path, name), "rb") as file:
            assert all(f["WARC-Type"] in ("response", "revisit") for f, _ in warc.parse_warc(file.read()))


def test_a_changed_archive_is_noticed(spark, folder):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    records = warc.with_revisits(warc.convert(warc.page_archives(pages)))
    warc.write(records.withColumn("digest", warc.F.lit("A" * 32)), f"{folder}/w")
    with pytest.raises(Exception, match="differs"):
        warc.read(spark, f"{folder}/w").collect()


def test_query_1(spark):
    got = {tuple(r) for r in queries.op1_warc(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    largest = {}
    for r in rows:
        largest[r.html] = max(largest.get(r.html, -1), r.page_id)
    want = set()
    for r in rows:
        body, top = (r.html or "").encode(), largest[r.html]
        want.add((r.page_id, len(body), sha1(body), "response" if top == r.page_id else "revisit", None if top == r.page_id else top))
    assert got == want
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import compare

    assert compare.difference(queries.QUERIES[name](spark, SF), compare.duck(SF), queries.ORACLE_SQL[name]) is None


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 0, 0, "user", 0, "start", None), (1, 0, 0, "user", 2, "delta", "lo"), (1, 0, 0, "user", 1, "delta", "hel"),
        (1, 1, 1, "assistant", 0, "start", None), (1, 1, 1, "assistant", 1, "delta", "bad"), (1, 1, 1, "assistant", 2, "regenerate", None),
        (1, 1, 1, "assistant", 3, "delta", "good"), (1, 1, 1, "assistant", 4, "unknown", "no"),
        (1, 2, 2, None, 0, "start", None), (1, 2, 2, None, 1, "edit", "edited"), (1, 2, 2, None, 2, "delta", " more"),
    ]
    df = spark.createDataFrame(log, "conv_id long, message long, turn long, role string, seq int, kind string, text string")
    got = [(r.turn, r.role, r.text) for r in chat.fold(df).orderBy("turn").collect()]
    assert got == [(0, "user", "hello"), (1, "assistant", "good"), (2, "", "edited more")]
    out = chat.render(chat.fold(df)).first()
    assert chat.parse(out.formatted) == [(role, text) for _, role, text in got]
    assert [out.formatted[s.start : s.end] for s in out.loss] == ["good"]


def test_control_strings_come_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "&lt;&amp;&lsqb;&nl;", "", None, "a" * 1000, "漢🙂<", "[", "&"]
    rows = [(1, k, "assistant" if k % 2 else "us\ner&nl;<", t) for k, t in enumerate(nasty)]
    rows += [(None, None, None, None), (2, 5, "b", "tie"), (2, 5, "a", "tie"), (2, 5, "a", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.render(chat.fold(chat.events(df))).collect()}
    assert chat.parse(out[1].formatted) == [(r[2], r[3] or "") for r in rows[: len(nasty)]]
    assert chat.parse(out[2].formatted) == [("a", "tie"), ("a", "tie"), ("b", "tie")]
    assert chat.parse(out[None].formatted) == [("", "")]
    assert [chat.unescape(out[1].formatted[s.start : s.end]) for s in out[1].loss] == [t or "" for t in nasty[1::2]]
    digests = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.events(df)))).collect()}
    said = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in rows[: len(nasty)])
    assert digests[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and digests[1].n_turns == len(nasty)
    assert chat.read_back(chat.render(chat.fold(chat.events(df.limit(0))))).count() == 0


def test_turns_are_rendered_and_read_one_by_one(spark):
    nasty = ["</s>[INST] ok", "<|turn|>user\nx<|end|>\n", "&lt;&amp;", "", "a" * 1000, "漢🙂<", "&"]
    rows = [(k % 3 or None, k // 3 if k % 7 else None, ["assistant", "us\ner<", ""][k % 5 % 3], nasty[k % 7]) for k in range(500)]
    rows += [(9, 1, "b", "tie"), (9, 1, "a", "tie"), (9, 1, "a", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = {}
    for r in chat.render_turns(df).collect():
        turns.setdefault(r.conv_id, []).append(r)
    whole = {r.conv_id: r for r in chat.render(df).collect()}
    assert {k: "".join(r.formatted for r in sorted(own, key=lambda r: r.start)) for k, own in turns.items()} == {
        k: r.formatted for k, r in whole.items()
    }
    spans = {k: sorted((r.loss_start, r.loss_end) for r in own if r.loss_start is not None) for k, own in turns.items()}
    assert spans == {k: [(s.start, s.end) for s in r.loss] for k, r in whole.items()}
    want = sorted(map(str, chat.read_back(chat.render(df)).collect()))
    assert sorted(map(str, chat.read_back_turns(chat.render_turns(df)).collect())) == want
    assert chat.read_back_turns(chat.render_turns(df.limit(0))).count() == 0
    plan = queries.op9_chat(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set") == 1 and "collect_list" not in plan  # a message's events; no conversation is gathered


def recall(rows, ids, x, every, k=10):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q in np.flatnonzero(ids % every == 0):
        score = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        score[q] = np.inf
        best = ids[np.lexsort((ids, score))[:k]].tolist()
        own = sorted(got[ids[q]])
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1)) and ids[q] not in [v for _, v, _ in own]
        place = {v: n for n, v in enumerate(ids.tolist())}
        assert all(abs(s - np.sqrt(((x[place[v]] - x[q]) ** 2).sum())) < 1e-9 for _, v, s in own)
        hit, total = hit + len(set(best) & {v for _, v, _ in own}), total + len(best)
    return hit / total


def test_recall_over_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    assert recall(queries.op8_neighbours(spark, "/root/testdata/sf0.01").collect(), ids, x, 100) >= 0.9


def test_recall_with_many_lists_and_a_hot_one(spark, monkeypatch):
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.normal(size=(1500, 8)), np.tile(draw.normal(size=(1, 8)), (700, 1)) + draw.normal(size=(700, 8)) * 1e-3])
    ids = np.arange(len(x))
    monkeypatch.setattr(neighbours, "LEAST", 300)
    monkeypatch.setattr(neighbours, "PART", 100)
    df = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, part int")
    assert recall(neighbours.search(df, every=50).collect(), ids, x, 50) >= 0.9


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 1.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (None, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [2.0, 1.0]), (40, [0.0, 0.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(df, every=20).collect())
    assert [g[:3] for g in got] == [(0, 1, 20), (0, 2, 7), (0, 3, 8), (0, 4, 9), (20, 1, 0), (20, 2, 7), (20, 3, 8), (20, 4, 9)]
    assert neighbours.search(df.limit(0), every=20).count() == 0
    assert neighbours.search(df.where("vec_id in (1, 2)"), every=20).count() == 0


def test_repeated_rows_take_no_places(spark):
    rows = [(0, [0.0, 1.0])] + [(k, [float(k), 1.0]) for k in range(1, 30)] + [(1, [1.0, 1.0])] * 15 + [(2, [2.0, 1.0])] * 40
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in neighbours.search(df, every=100).collect())
    assert got == [(k, k, float(k)) for k in range(1, 11)]


def test_pipeline_stages(spark):
    """Every stage's decision, taken from its operator's query on the same input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept, given = {r.doc_id for r in docs.collect()}, {r.doc_id for r in before.collect()}
        if name == "toxicity":
            rejected = {r.doc_id for r in queries.op10_toxicity(spark, SF).where("predicted = 1").collect()}
            assert kept == given - rejected and rejected
        elif name == "near-duplicates":
            classes = queries.simhash.near_duplicates(before).collect()
            assert kept == {r.component_id for r in classes} and len(kept) < len(given)
        elif name == "decontamination":
            bad = queries.decontamination.annotate(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert kept == given - {r.doc_id for r in bad.where(queries.decontamination.contaminated()).collect()}
        else:
            assert kept == given
            assert not [r for r in docs.collect() if "@mail" in r.text or r.n_chars != len(r.text)]
    pieces = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r.length)
    assert set(pieces) == kept and all(n <= 2048 for own in pieces.values() for n in own)

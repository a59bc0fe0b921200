"""Workers without the library, junk texts, equal and huge vectors, clashing columns, redelivery."""

import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from conftest import ROOT, rows
from fleetquill.llm import chat, decontamination, neighbours, queries, repeats, simhash, toxicity

SF = "/root/testdata/sf0.001"

ALONE = """
import sys, tempfile
sys.path.insert(0, {root!r})  # of the driver only
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())

def importable(batches):
    for batch in batches:
        try:
            import fleetquill
        except ImportError:
            continue
        raise AssertionError("the workers can import the library")
    yield from ()

from pyspark.sql import functions as F
spark.range(1).mapInPandas(importable, "id long").count()
import __spark_entry__ as entry
for name in {names!r}:
    assert entry.queries()[name](spark, {sf!r}).count() > 0, name
print("all ran")
"""


def test_workers_need_no_copy_of_the_library(folder):
    names = ["op2_language_id", "op8_neighbours", "op10_toxicity", "op11_clusters", "op13_periods"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = ALONE.format(root=ROOT, names=names, sf=SF)
    done = subprocess.run([sys.executable, "-c", script], cwd=folder, env=env, capture_output=True, text=True, timeout=400)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_long_white_space_packs_like_the_tokenizer(spark):
    own = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    texts = ["a" + " " * 400_000 + "b", "\n" * 400_000, "x \t" * 30_000, " " * 19_999 + "x", "y" + " " * 20_001]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in queries.pieces(df).orderBy("doc_id", "start").collect():
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == {k: own.encode(t, add_special_tokens=False).ids + [1] for k, t in enumerate(texts)}


def exact(table, every, k=10):
    out = []
    for i, q in table:
        if i % every:
            continue
        near = sorted((float(np.sqrt(((np.array(v) - np.array(q)) ** 2).sum())), j) for j, v in table if j != i)
        out += [(i, rank + 1, j) for rank, (_, j) in enumerate(near[:k])]
    return out


def found(spark, table, every):
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    return [(r.query_id, r["rank"], r.vec_id) for r in neighbours.search(df, every).orderBy("query_id", "rank").collect()]


def test_equal_vectors(spark):
    same = [(i, [1.0, 2.0, 3.0]) for i in range(1000)]
    assert found(spark, same, 500) == exact(same, 500)
    draw = np.random.default_rng(1)
    two = [(i, [float(i % 2), 1.0]) for i in range(1000)]
    assert found(spark, two, 500) == exact(two, 500)
    most = [(i, [1.0] * 8 if i % 10 < 7 else draw.normal(size=8).tolist()) for i in range(20_000)]
    got = found(spark, most, 5000)
    assert got == exact(most, 5000)


def test_huge_vectors_are_found(spark):
    draw = np.random.default_rng(3)
    table = [(i, draw.normal(size=4).tolist()) for i in range(50)]
    table += [(50, [1e200, 0.0, 0.0, 0.0]), (51, [1e200, 1e190, 0.0, 0.0]), (100, [1.1e200, 0.0, 0.0, 0.0]), (200, [-1.7e308] * 4)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df, 100, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[100][:2] == [50, 51] and len(got[100]) == 3
    assert len(got[200]) == 3 and len(got[0]) == 3
    score = neighbours.search(df, 100, k=3).where("query_id = 100 AND vec_id = 50").first().score
    assert abs(score / 1e199 - 1) < 1e-9


def test_queries_of_a_hot_list_are_dealt(spark, monkeypatch):
    draw = np.random.default_rng(4)
    table = [(i, draw.normal(size=4).tolist()) for i in range(400)]
    whole = found(spark, table, 2)
    monkeypatch.setattr(neighbours, "ASKING", 7)
    monkeypatch.setattr(neighbours, "PART", 50)
    assert found(spark, table, 2) == whole == exact(table, 2)


def test_keep_one_loses_no_text(spark):
    alpha, beta = " ".join(f"alpha{k}" for k in range(30)), " ".join(f"beta{k}" for k in range(30))
    docs = spark.createDataFrame(
        [(1, alpha, "a"), (1, beta, "b"), (2, alpha, "c"), (None, beta, "d"), (None, "gamma one two", "e"), (None, "gamma one two", "f"), (3, None, "g"), (4, "", "h")],
        "doc_id long, text string, id string",
    )
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows(kept.select("doc_id", "text")) == [(None, "gamma one two"), (1, alpha), (1, beta), (3, None)]


def test_operators_keep_columns_with_their_own_names(spark):
    odd = "spans string, __id int, __h int, __body int, __places string, __text string, __r string, __rated int, found int, pii string"
    extra = ("s", 1, 2, 3, "p", "t", "r", 4, 5, "q")
    docs = spark.createDataFrame([(1, "one two " * 60, *extra), (2, "one two " * 60, *extra)], f"doc_id long, text string, {odd}")
    docs = docs.withColumn("nested", F.struct(F.lit(1).alias("a b"), F.lit(2).alias("c`d")))
    bench = spark.createDataFrame([("i", "one two one two one two one two one two one two one")], "item_id string, text string")
    for got in (repeats.remove(docs), decontamination.annotate(docs, bench), toxicity.score(docs, None)):
        assert [c for c in docs.columns if c not in got.columns] == []
        assert rows(got.select(*docs.columns).drop("nested")) == rows(docs.drop("nested"))
        assert rows(got.select("nested.*")) == [(1, 2), (1, 2)]


def test_events_delivered_again_and_out_of_order(spark):
    log = [
        (1, 10, 0, "user", 0, "start", None),
        (1, 10, None, None, 1, "delta", "hi "),
        (1, 10, 0, "user", 2, "delta", "you"),
        (1, 11, 1, "assistant", 0, "start", None),
        (1, 11, None, None, 1, "delta", "draft"),
        (1, 11, None, None, 2, "regenerate", None),
        (1, 11, 7, "wrong", 3, "delta", "hi "),
        (1, 11, None, None, 4, "delta", "hi"),
        (1, 12, 2, "user", 3, "delta", "tail"),
    ]
    draw = random.Random(9)
    shuffled = log * 3
    draw.shuffle(shuffled)
    schema = "conv_id long, message long, turn long, role string, seq int, kind string, text string"
    want = [(1, 0, "user", "hi you"), (1, 1, "assistant", "hi hi"), (1, 2, "user", "tail")]
    for events in (log, shuffled):
        assert rows(chat.fold(spark.createDataFrame(events, schema))) == want


def test_labels_without_a_text_take_no_place(spark):
    docs = spark.createDataFrame([(k, "some words here" if k >= 50 else "") for k in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    texts, toxic, _ = toxicity.sample(docs, labels, 10, 1000)
    assert len(texts) == 20 and toxic.sum() == 10

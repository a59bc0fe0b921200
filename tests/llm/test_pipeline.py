"""The pipeline against its five stages written in plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_duplicates import plain_components, plain_hits, plain_print
from test_pii import plain as plain_spans
from tokenizers import Tokenizer

from fleetquill.llm import toxicity

INSULTS = ["zumwack", "kweebuff", "jexxo"]
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "toxicity string, n_words int, n_hit string, item_ids array<int>, pii string, spans int, __id string, fp binary"
)
OWN = ("kept", 7, "hit", [1, 2], "own", None, "x", b"\x01")
BENCHMARK = "item_id long, text string"
LABELS = "doc_id long, toxic int"


def sentence(draw, n):
    return " ".join("".join(draw.choices("aeiorstnld", k=draw.randint(2, 8))) for _ in range(n))


def table():
    """(documents, benchmark, labels): what each stage has to decide, and odd rows."""
    draw = random.Random(4)
    texts = []
    for k in range(700):
        words = sentence(draw, draw.randint(8, 40)).split()
        if k % 4 == 0:
            words[draw.randrange(len(words))] = draw.choice(INSULTS)
        texts.append((k, " ".join(words)))
    labels = [(k, int(k % 4 == 0)) for k, _ in texts] + [(None, 1), (9_999, 1), (3, None)]
    items = [(k, sentence(draw, 30)) for k in range(5)] + [(5, "Kurze Übung hier"), (6, None), (7, ""), (5, sentence(draw, 14))]
    long = sentence(draw, 400)
    edited = long.split()
    edited[200] = "changed"
    passage = " ".join(items[1][1].split()[4:20])
    texts += [
        (800, long), (801, long.upper()), (802, long.replace(" ", "\n ")), (803, " ".join(edited)),
        (810, f"{sentence(draw, 60)} {passage} {sentence(draw, 60)}"),
        (811, f"{sentence(draw, 300)} {passage} {sentence(draw, 300)}"),  # less than a twentieth
        (812, "die kurze, ÜBUNG hier"), (813, "die KURZE Übung; hier"),
        (820, "write to a.b@c-d.example.org or call +41 (0)44 123 45 67 today"),
        (821, "hosts 10.0.0.1 and 300.1.1.1, card 4111-1111-1111-1111, wrong 4111 1111 1111 1112 end"),
        (822, "+491701234567@mail.example.com, 🙂é x@y.z"),
        (830, None), (831, ""), (832, " \t\n"), (833, ""),
        (840, "tiny words " * 15_000), (841, "x" + " " * 30_000 + "y <|endoftext|> as text"),
        (850, "twice the same row"), (850, "twice the same row"), (850, "but one id for another text"),
        (None, "a text without an id"), (None, "a text without an id"), (None, long), (None, f"nameless {INSULTS[0]} text of some words here"),
    ]
    docs = [(i, t, "en", "web", None if t is None else len(t), *OWN) for i, t in texts]
    draw.shuffle(docs)
    return docs, items, labels


def plain_toxicity(spark, docs, labels):
    """The machine as fitted on the labels that are not held out, asked text by text."""
    learn = [r for r in labels if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    model = toxicity.fit(spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(learn, LABELS))

    def rejected(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return model.margins(data, np.array([0, len(data)]))[0] >= 0

    kept = [r for r in docs if not rejected(r[1])]
    toxic = {r[1] for r in docs if any(word in (r[1] or "") for word in INSULTS)}
    assert not toxic & {r[1] for r in kept} and len(kept) > 0.99 * sum(r[1] not in toxic for r in docs)
    return kept


def plain_near_duplicates(docs, _):
    """One row of each component: the smallest id, then the smallest digest; no id comes last."""
    order = sorted({(r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest(), r[1] or "") for r in docs})
    roots = plain_components(list(range(len(order))), [plain_print(key[3]) for key in order])
    chosen = {order[root][:3] for root in roots}
    kept = {}
    for r in docs:
        key = (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
        if key in chosen:
            kept.setdefault(key, r)
    return list(kept.values())


def plain_decontamination(docs, items):
    hits = plain_hits([(r[1], r[1]) for r in docs], items)
    bad = {text for text, n, h, _ in hits if h and 20 * h >= n}
    return [r for r in docs if r[1] not in bad]


def plain_personal_data(docs, _):
    out = []
    for r in docs:
        text, at, parts = r[1] or "", 0, []
        for kind, start, end in re.findall(r"(\w+):(\d+):(\d+)", plain_spans(text)):
            start, end = int(start), int(end)
            if start >= at:  # a span that overlaps the one before lengthens it
                parts += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        masked = None if r[1] is None else "".join(parts) + text[at:]
        out.append((r[0], masked, *r[2:4], None if masked is None else len(masked), *r[5:]))
    return out


def plain_pieces(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for r in docs:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        sizes, start = [2048] * (len(ids) // 2048) + [1 << b for b in range(10, -1, -1) if len(ids) % 2048 >> b & 1], 0
        for n in sizes:
            out[r[0], start, n, np.array(ids[start : start + n], "<u4").tobytes(), len(ids)] += 1
            start += n
    return out


def counted(rows):
    return Counter(str(tuple(r)) for r in rows)


def write(spark, folder, docs, items, labels):
    for name, rows, schema in (("documents", docs, DOCUMENTS), ("benchmark", items, BENCHMARK), ("labels", labels, LABELS)):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def tables():
    return table()


def test_run_equals_plain_stages(spark, folder, tables):
    docs, items, labels = tables
    write(spark, folder, *tables)
    def first(docs, _):
        return plain_toxicity(spark, docs, labels)

    plain = [first, plain_near_duplicates, plain_decontamination, plain_personal_data]
    for (name, stage), check in zip(corpus_pipeline.STAGES, plain, strict=False):
        got = stage(spark, spark.createDataFrame(docs, DOCUMENTS), folder)
        after = check(docs, items)
        assert got.schema.names == [c.split()[0] for c in DOCUMENTS.split(", ")], name
        assert counted(got.collect()) == counted(after), name
        assert after != docs, name  # each stage has something to do
        docs = after
    got = Counter(
        (r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in corpus_pipeline.run(spark, folder).collect()
    )
    assert got == plain_pieces(docs)


def test_run_of_empty_tables(spark, folder, tables):
    docs, items, labels = tables
    write(spark, f"{folder}/none", [], [], [])
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
    few = [r for r in docs if r[0] in (0, 1, 831, 850)]
    write(spark, f"{folder}/few", few, [], [])  # nothing learned, no benchmark: copies go, the rest stays
    got = corpus_pipeline.run(spark, f"{folder}/few")
    want = plain_pieces(plain_near_duplicates(few, []))
    assert Counter((r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in got.collect()) == want

"""Packing against the reference tokenizer; language and toxicity on held-out documents."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import rows
from fleetquill.llm import language, packing, queries, toxicity

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "Ünï çødé 漢字 🙂", "x" * 5000, "word " * 30_000, "<|endoftext|> as text", "\x00\x01", "same", "same"]


def packed(df):
    return packing.pack(df, public_tokenizers.path(queries.TOKENIZER), public_tokenizers.PATTERN)


def test_pieces_are_the_tokens_of_whole_texts(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for row in packing.sequences(packed(df)).collect():
        got.setdefault(row.doc_id, []).append(row)
    want = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for k, encoded in enumerate(want):
        own = sorted(got[k], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist()
        assert ids == [*encoded.ids, packing.END_ID]
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
        assert all(r.length & (r.length - 1) == 0 and r.length <= 2048 and r.bucket == r.length.bit_length() - 1 for r in own)
        assert all(r.length * 4 == len(r.ids) and r.doc_tokens == len(ids) and r.offset == 0 for r in own)
    numbers = [r.sequence_id for rows in got.values() for r in rows]
    assert len(set(numbers)) == len(numbers)


def test_special_tokens_are_those_of_the_tokenizer_as_loaded(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [*ODD, f"a{end} as text", end, end * 3, f"two  {end}  \n{end}\n x", f"<|endof{end}text|>", f"é{end}漢", "<|EndOfText|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for row in queries.pieces(df).collect():
        got.setdefault(row.doc_id, []).append(row)
    for k, encoded in enumerate(tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        own = sorted(got[k], key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == [*encoded.ids, packing.END_ID]
        assert {r.doc_tokens for r in own} == {len(encoded.ids) + 1}


def test_packing_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "x", 7)], "doc_id long, text string, ids string, start int")
    assert packed(df).columns == ["doc_id", "start", "length", "bucket", "ids", "doc_tokens"]
    assert packing.sequences(packed(df.limit(0))).count() == 0
    assert packed(df.select(F.lit(None).cast("long").alias("doc_id"), "text")).first().doc_id is None


def test_op4_digest(spark):
    rows = queries.op4_packing(spark, SF)
    first = packing.sequences(packed(spark.read.parquet(f"{SF}/documents.parquet")))
    want = {(r.doc_id, r.start): zlib.crc32(r.ids) for r in first.collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in rows.collect()} == want


def tree_of(data, offsets):
    codes, n = np.unique(language.grams(data, offsets), return_counts=True)
    return language.build(np.array(["en"] * len(codes), dtype=object), codes.astype(np.int64), n).trees[0]


def plain_bits(learned, texts):
    """Code lengths by the definition, from counts of plain dictionaries."""
    counts = {}
    for text in learned:
        padded = bytes(language.ORDER) + text
        for i in range(language.ORDER, len(padded)):
            for order in range(language.ORDER + 1):
                own = counts.setdefault(padded[i - order : i], {})
                own[padded[i]] = own.get(padded[i], 0) + 1

    def distribution(context):
        shorter = distribution(context[1:]) if context else [1 / 256] * 256
        seen = counts.get(context)
        if not seen:
            return shorter
        total = sum(seen.values()) + len(seen)
        left = sum(p for b, p in enumerate(shorter) if b not in seen)
        return [seen[b] / total if b in seen else len(seen) / total * p / left for b, p in enumerate(shorter)]

    out = []
    for text in texts:
        padded = bytes(language.ORDER) + text
        out.append(-sum(np.log2(distribution(padded[i - language.ORDER : i])[padded[i]]) for i in range(language.ORDER, len(padded))))
    return out


def test_code_lengths_follow_the_definition():
    learned = [b"", "the cat sat on the mat, the rat ate the cheese; ".encode() * 3, "Käse und 漢字".encode(), b"t"]
    data = np.frombuffer(b"".join(learned), np.uint8)
    tree = tree_of(data, np.cumsum([0] + [len(t) for t in learned]))
    for context in (b"\0\0\0", b"the", b" ca", b"xyz"):  # every distribution sums to one
        after = (int.from_bytes(context, "big") << 8 | np.arange(256)).astype(np.uint32)
        assert abs(np.exp2(-language.symbol_bits(tree, after)).sum() - 1) < 1e-5
    texts = [b"the cat ate", b"", b"zebra \x01", "漢 Käse".encode(), learned[1]]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    got = language.code_lengths([tree], np.frombuffer(b"".join(texts), np.uint8), offsets)[:, 0]
    assert np.allclose(got, plain_bits(learned, texts), rtol=1e-5)


def test_long_texts_are_scored_block_by_block(monkeypatch):
    text = "some words and then some more of them ".encode() * 50
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 7, 7, 900, len(text)])
    tree = tree_of(data, offsets)
    whole = language.code_lengths([tree], data, offsets)
    monkeypatch.setattr(language, "BLOCK", 64)
    assert np.allclose(whole, language.code_lengths([tree], data, offsets))


def test_trees_grow_with_the_corpus_and_are_sent_in_groups(spark, monkeypatch):
    random = np.random.default_rng(6)
    often = 0.7 ** np.arange(16)

    def docs(n):
        letters = {"x": list("abcdefghijklmnop"), "y": list("ponmlkjihgfedcba")}
        texts = [("".join(random.choice(letters[lang], 2000, p=often / often.sum())), lang) for lang in letters for _ in range(n)]
        return spark.createDataFrame([(k, *t) for k, t in enumerate(texts)], "doc_id long, text string, lang string")

    few, many = (language.fit(docs(n), detail=20) for n in (20, 200))
    sizes = [[len(tree[-1].cells) for tree in model.trees] for model in (few, many)]
    assert all(50 < a < b <= 20 * (200 * 2000) ** (1 / 3) for a, b in zip(*sizes, strict=True))
    assert [len(t[-1].cells) for t in language.fit(docs(2), detail=1e-9).trees] == [1, 1]
    table = docs(20)
    model = language.fit(table)  # so small a corpus is kept whole
    whole = language.gram_counts(table, "text", "lang").groupBy("lang").count().orderBy("lang").collect()
    assert [len(t[-1].cells) for t in model.trees] == [r["count"] for r in whole]
    together = rows(language.predict(table, model))
    monkeypatch.setattr(language, "GROUP", 1)
    assert len(list(language.groups(model.trees))) == 2 and rows(language.predict(table, model)) == together
    assert {r[1] for r in together} == {"x", "y"}


def test_language_of_held_out_documents(spark):
    got = queries.op2_language_id(spark, SF).withColumnRenamed("doc_id", "id")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.join(got, docs.doc_id == got.id).where("held_out").collect()
    assert len(rows) > 20
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    learn = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)], "text string, lang string"
    )
    model = language.fit(learn)
    odd = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (3, "12 34 !", 5), (4, "the dog and the cat", 5), (5, "die katze und der hund", 5), (6, "漢字", 5)],
        "doc_id long, text string, lang_pred int",
    )
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[5][0] == "de" and got[6][0] in ("en", "de")
    nothing = language.fit(learn.limit(0))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(odd.limit(0), model).count() == 0


def brute_units(symbols, weight):
    """Unit scores by the definition, subsequence by subsequence."""
    out = []
    for i in range(len(symbols)):
        total = 0.0
        for start in range(i, min(i + toxicity.STARTS, len(symbols))):
            for middle, last in toxicity.PATTERNS:
                if start + last < len(symbols):
                    a, b, c = symbols[start], symbols[start + middle], symbols[start + last]
                    total += toxicity.DECAY ** (last + 1) * weight[(a * 64 + b) * 64 + c]
        out.append(total)
    return np.array(out)


def test_unit_scores_follow_the_definition(monkeypatch):
    random = np.random.default_rng(1)
    texts = [b"", b"a", b"you i.d.i.o.t here", bytes(random.integers(97, 123, 300).astype(np.uint8)), b"end"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    weight = random.normal(size=64**3).astype(np.float32)
    scores = toxicity.unit_scores(toxicity.SYMBOL[data], offsets, weight)
    want = np.concatenate([brute_units(toxicity.SYMBOL[np.frombuffer(t, np.uint8)], weight) for t in texts])
    assert np.allclose(scores, want, atol=1e-3)
    features = toxicity.text_features(data, offsets, weight, 0.1)
    monkeypatch.setattr(toxicity, "BLOCK", 37)
    assert np.allclose(features, toxicity.text_features(data, offsets, weight, 0.1), atol=1e-3)
    assert features[0, 0] == toxicity.EMPTY


def made_up(n, seed):
    """Sentences of random words; toxic ones hold a word from a short list, some with
    characters put in."""
    random = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        words = ["".join(random.choice(list("aeiorstnld"), random.integers(2, 8))) for _ in range(random.integers(5, 40))]
        toxic = k % 4 == 0
        if toxic:
            word = str(random.choice(["zumwack", "kweebuff", "jexxo"]))
            at = int(random.integers(1, len(word)))
            words[int(random.integers(0, len(words)))] = word if random.random() < 0.7 else word[:at] + "-" + word[at:]
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_toxicity_of_held_out_sentences(spark):
    rows = made_up(800, 3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert np.mean([(got[r[0]] >= 0.5) == bool(r[2]) for r in held]) > 0.95


def test_toxicity_of_odd_rows(spark):
    rows = made_up(200, 4)
    labels = spark.createDataFrame(
        [(r[0], r[2]) for r in rows] + [(None, 1), (1, None), (2, 7)], "doc_id long, toxic int"
    )
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    odd = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (3, "zumwack " * 20_000, None), (3, "zumwack " * 20_000, None), (None, "ok", "")],
        "doc_id long, text string, toxicity string",
    )
    model = toxicity.fit(docs, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == 5 and all(0 <= r.toxicity <= 1 for r in got)
    assert all(r.toxicity < 0.5 for r in got if not r.text)
    assert all(r.toxicity >= 0.5 for r in got if r.doc_id == 3)
    assert toxicity.score(odd.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert none is None and {r.toxicity for r in toxicity.score(odd, none).collect()} == {0.0}


def test_seeds_and_landmarks_follow_the_toxic_texts():
    """Two hundred insults need more seeds than a fixed number; each is learned."""
    random = np.random.default_rng(9)

    def word(letters, n):
        return "".join(random.choice(list(letters), n))

    stems = [word("bcfgjkmpquvwxyz", 7) for _ in range(200)]

    def text(stem=None):
        words = [word("aeiorstnld", random.integers(2, 8)) for _ in range(20)]
        return " ".join([*words[:9], *([stem] if stem else []), *words[9:]]).encode()

    toxic = np.arange(2400) % 2 == 0
    texts = [text(stems[k // 2 % 200] if y else None) for k, y in enumerate(toxic)]
    seeds = toxicity.seeds([toxicity.SYMBOL[np.frombuffer(t, np.uint8)] for t in texts], toxic)
    told = [
        any(np.isin(toxicity.gram_codes(toxicity.SYMBOL[np.frombuffer(s.encode(), np.uint8)], k)[0], seeds).any() for k in toxicity.GRAMS)
        for s in stems
    ]
    assert all(told)
    order = random.permutation(2400)
    model = toxicity.train([texts[k] for k in order], toxic[order], 0.5)
    fresh = [text(s) for s in stems] + [text() for _ in stems]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in fresh])])
    said = model.margins(np.frombuffer(b"".join(fresh), np.uint8), offsets) >= 0
    assert said[:200].mean() > 0.95 and said[200:].mean() < 0.05

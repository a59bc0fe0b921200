"""Base spans against Python's regular expressions; the added kinds and redaction."""

import random
import re
import time

from pyspark.sql import functions as F

from fleetquill.llm import pii, queries

SF = "/root/testdata/sf0.001"


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        value = int(c)
        total += value if k % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def plain(text):
    """The base kinds as they are defined, retries left out."""
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        number = re.sub("[^0-9]", "", m[0])
        if 12 <= len(number) <= 19 and luhn(number):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out))


def base(df):
    return df.select("doc_id", pii.listed(pii.base_only(F.col("pii"))).alias("s"))


def test_base_spans_equal_plain_ones(spark):
    draw = random.Random(5)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for letters, longest in (("a.@-+ 0123456789()%_é\n4%🙂", 90), ("@.ab1-+", 40), ("0123456789 - .", 50), ("+123 ().-", 60)):
        texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, longest))) for _ in range(1500)]
    texts += ["4111 1111-1111 1111", "a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "0256.1.1.1 255.0000.1.2", "+1 (538) 555-4734x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in base(pii.find(df)).collect()}
    assert [k for k, t in enumerate(texts) if got[k] != plain(t)] == []


def test_long_texts_take_linear_time(spark):
    texts = ["a" * 200_000, "1" * 200_000, "1 " * 100_000, "a." * 100_000, "a@" + "a." * 100_000, "+1" + "(" * 200_000, "1-" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in base(pii.find(df)).collect()}
    assert got == {**{k: "" for k in range(7)}, 4: "email:0:200001"}


def test_added_kinds_need_checksum_or_words(spark):
    rows = [
        (1, "IBAN DE89370400440532013000 or GB82 WEST 1234 5698 7654 32"),
        (2, "IBAN DE88370400440532013000"),
        (3, "my ssn is 123-45-6789"),
        (4, "order 123-45-6789 of today"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.find(df).select("doc_id", pii.listed(F.col("pii")).alias("s")).collect()}
    assert got == {1: "iban:5:27,iban:31:58", 2: "", 3: "ssn:10:21", 4: ""}
    scores = pii.find(df.where("doc_id = 1")).first().pii
    assert scores[0].score == 1.0 and all(s.score >= pii.KEEP for s in scores)


def test_account_numbers_end_before_the_next_word(spark):
    de, gb = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    spaced = "DE89 3704 0044 0532 0130 00"
    rows = [
        (1, f"{de} Please pay", [(0, 22)]),
        (2, f"{spaced} BIC COBADEFF", [(0, 27)]),
        (3, f"{de} 2024", [(0, 22)]),
        (4, f"{de} {gb} {spaced} A B C", [(0, 22), (23, 50), (51, 78)]),
        (5, f"\U0001f642é {gb} X", [(3, 30)]),
        (6, f"{de}Please, x{de}, {de}1", []),
        (7, "AB12 " * 500 + de, [(2_500, 2_522)]),
        (8, f"XX99 {de}, NO9386011117947.", [(5, 27), (29, 44)]),
        (9, "DE88370400440532013000 Please", []),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = pii.find(df)
    got = {r.doc_id: [(s.start, s.end) for s in r.pii if s.kind == "iban"] for r in found.collect()}
    assert got == {r[0]: r[2] for r in rows}
    masked = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert masked[1] == "[IBAN] Please pay" and masked[2] == "[IBAN] BIC COBADEFF"


def test_redaction_masks_the_union_once(spark):
    rows = [
        (1, "mail a.b@c.de, ip 10.0.0.1.", 9),
        (2, "+4111 1111 1111 1111 x", 9),  # a phone's plus before a card: too long for a phone
        (3, "+491701234567@mail.example.com end", 9),
        (4, None, 9),
        (5, "", 9),
        (6, "+41 4111 1111 1111 1 and 4111111111111111", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii int")
    found = pii.find(df)
    assert found.columns == ["doc_id", "text", "pii"]
    got = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert got[1] == "mail [EMAIL], ip [IP]."
    assert got[2] == "+[CARD] x"
    assert got[3] == "[EMAIL] end"
    assert got[4] is None and got[5] == ""
    assert "1111" not in got[6]


def test_query_has_a_row_for_every_row(spark):
    rows = queries.op5_pii(spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.redact(pii.find(empty)).count() == 0


def test_plan_has_no_python(spark):
    plan = queries.op5_pii(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_many_matches_take_linear_time(spark):
    """Fifty thousand addresses in one text, and the time of ten times fewer for each tenth."""
    def text(n):
        return " ".join(f"mail user{k}@example{k % 7}.org," for k in range(n))

    took = {}
    for n in (5_000, 50_000):
        df = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
        start = time.perf_counter()
        row = pii.find(df).select("pii").first()
        assert len(row.pii) == n and row.pii[-1].end == len(text(n)) - 1
        clean = pii.redact(pii.find(df)).first().text
        took[n] = time.perf_counter() - start
        assert clean == " ".join(["mail [EMAIL],"] * n)
    assert took[50_000] < 20 * max(took[5_000], 1), took


def test_places_beyond_the_first_chunk(spark):
    texts = ["é" * k + " ssn 123-45-6789 a@b.cd " + "x" * 3000 + " DE89370400440532013000 end" for k in (0, 1, 990, 1010, 1023, 1024, 5000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.redact(pii.find(df)).collect():
        want = texts[r.doc_id].replace("123-45-6789", "[SSN]").replace("a@b.cd", "[EMAIL]").replace("DE89370400440532013000", "[IBAN]")
        assert r.text == want


def test_other_columns_are_kept(spark):
    df = spark.createDataFrame([("at a@b.cd", 1, 2, 3)], "text string, chunks int, AT_email int, pieces int")
    got = pii.redact(pii.find(df))
    assert got.columns == df.columns
    assert tuple(got.first()) == ("at [EMAIL]", 1, 2, 3)

"""Each operator as a named query over its whole table, with its SQL where SQL has one.

The operators give texts, spans and files; the digest columns are worked out here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.llm import (
    chat,
    clusters,
    decontamination,
    exact,
    language,
    neighbours,
    packing,
    periods,
    pii,
    repeats,
    shared,
    simhash,
    toxicity,
    warc,
)

TOKENIZER = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(row_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id falls into remainder -1."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % by, F.lit(-1))


def pieces(docs: DataFrame) -> DataFrame:
    vocabulary = public_tokenizers.path(VOCABULARY)
    special = packing.special_tokens(vocabulary)
    return packing.pack(
        docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, special=special, vocabulary_path=vocabulary
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return language.predict(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "lang_pred",
        "score",
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(pieces(table(spark, sf_dir, "documents"))).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii")
    return found.select(
        "doc_id",
        *[pii.count(spans, kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(pii.base_only(spans)), 256).alias("base_sha256"),
        pii.listed(spans).alias("spans"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    checked = decontamination.annotate(docs, table(spark, sf_dir, "benchmark"))
    return checked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their toxicity, learned from the labels that are not held out."""
    learn = labels.where(remainder(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, toxicity.fit(docs, learn))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), every=100)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(["user", "assistant"])]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    return chat.read_back_turns(chat.render_turns(chat.fold(chat.events(rows))))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rated(docs, table(spark, sf_dir, "labels")).select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact.open_index(spark, shared.scratch(spark, "digest-index"))
    added = exact.add(index, table(spark, sf_dir, "documents"))
    return added.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of a tenth of the documents the words repeat from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
        own = F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(own, " ")).otherwise("")

    changed = pii.bound(words, repeated)
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find(with_planted_period(table(spark, sf_dir, "documents").select("doc_id", "text")))
    runs = F.col("runs")
    kind = found.schema["runs"].dataType.elementType

    def higher(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.col("best")
    return found.withColumn("best", F.aggregate(runs, F.lit(None).cast(kind), higher)).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(runs, line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_pii": op5_pii,
    "op6_decontamination": op6_decontamination,
    "op7_repeats": op7_repeats,
    "op8_neighbours": op8_neighbours,
    "op9_chat": op9_chat,
    "op10_toxicity": op10_toxicity,
    "op11_clusters": op11_clusters,
    "op12_exact": op12_exact,
    "op13_periods": op13_periods,
}

ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')"

WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

def clusters_sql(k: int = clusters.CLUSTERS, rounds: int = clusters.ROUNDS, width: int = clusters.WIDTH) -> str:
    """k-means over integers, a pair of subqueries a round."""
    steps = [
        f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor({clusters.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
),
flat AS MATERIALIZED (SELECT r, unnest(range(1, {width + 1})) AS i, unnest(v) AS x FROM kept),
first AS (
    SELECT row_number() OVER (ORDER BY sha256('{clusters.SEED}:' || vec_id), v) - 1 AS k, v
    FROM kept WHERE vec_id IS NOT NULL QUALIFY k < {k}
),
c0 AS MATERIALIZED (SELECT k, unnest(range(1, {width + 1})) AS i, unnest(v) AS x FROM first)"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""
a{n} AS MATERIALIZED (
    SELECT r, min(d) AS d, arg_min(k, d * {k} + k) AS k
    FROM (SELECT r, k, CAST(sum((f.x - c.x) * (f.x - c.x)) AS BIGINT) AS d
          FROM flat AS f JOIN c{n} AS c USING (i) GROUP BY r, k)
    GROUP BY r
)"""
        )
        if n < rounds:
            steps.append(
                f"""
c{n + 1} AS MATERIALIZED (
    SELECT k, i, coalesce(m.x, c.x) AS x
    FROM c{n} AS c LEFT JOIN (
        SELECT k, i, CAST((s - (s % n + n) % n) // n AS BIGINT) AS x
        FROM (SELECT k, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM flat JOIN a{n} USING (r) GROUP BY k, i)
    ) AS m USING (k, i)
)"""
            )
    return f"""
WITH {",".join(steps)},
shapes AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN shapes USING (k)
"""


ORACLE_SQL: dict[str, str] = {
    "op11_clusters": clusters_sql(),
    "op12_exact": """
WITH own AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM own WINDOW w AS (PARTITION BY text_sha256)
""",
    # base 32 from hexadecimal: five digits make four letters
    "op1_warc": """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
    FROM pages
)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
           FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM hashed
""",
    "op6_decontamination": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, n, w[k : k + n - 1] AS words
    FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k
          FROM items WHERE len(w) > 0)
),
places AS (
    SELECT r, n, k, w[k : k + n - 1] AS words
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k
          FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
found AS (SELECT r, item, k, n FROM places JOIN windows USING (n, words)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit
        FROM (SELECT r, unnest(range(k, k + n)) AS place FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""",
    "op9_chat": f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), whole AS (
    SELECT conv_id,
           count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
           coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
           CAST(sum(length('<|turn|>') + length(replace({ESCAPED.format("role")}, chr(10), '&nl;')) + 1
                    + length({ESCAPED.format("text")}) + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
    FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM whole
""",
}

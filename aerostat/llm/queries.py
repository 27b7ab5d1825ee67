"""The operators as queries over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat.llm import (
    class_lm,
    collocations,
    decontamination,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    quality,
    sentencepiece,
    sharding,
    spelling,
)
from aerostat.llm.common import remainder, short_batches, whole

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    model = sentencepiece.load(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.withColumn("coded", sentencepiece.round_trip(F.col("text"), model))
    coded = coded.select("doc_id", "text", "coded.ids", "coded.decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("ids")).cast("long").alias("n_distinct"),
        (F.col("decoded") == whole(F.col("text"))).alias("round_trip"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("found.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        decontamination.contaminated(F.col("found")).alias("contaminated"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.withColumn("digest", F.lower(F.hex("digest"))).withColumnRenamed("digest", "text_sha256")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = quality.learn_quality(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.quality(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 7) == 2
    model = class_lm.learn(docs.filter(~held_out))
    return class_lm.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    trees = html_extraction.learn_trees(pages)
    return pages.select("page_id", "url", html_extraction.main_text(F.col("html"), trees).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 5) == 0
    profiles = language_id.learn_profiles(docs.filter(~held_out))
    told = docs.select("doc_id", held_out.alias("held_out"), language_id.language(F.col("text"), profiles).alias("told"))
    return told.select("doc_id", "held_out", "told.lang_pred", "told.score")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = whole(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(rows, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"), into="scan")
    base, places = F.col("scan.base"), F.col("scan.places")
    return found.select(
        "doc_id",
        F.col("scan.n_words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first"]).cast("long").alias("first_word"),
        F.array_max(base["first"]).cast("long").alias("last_word"),
        license_scan.labels_of(base).alias("base_labels"),
        license_scan.labels_of(places).alias("labels"),
        license_scan.confidence(places).alias("score"),
    )


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_decontamination": op2_decontamination,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_class_lm": op6_class_lm,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_sharding": op10_sharding,
    "op11_spelling": op11_spelling,
    "op12_collocations": op12_collocations,
    "op13_licenses": op13_licenses,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op2_decontamination": f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
item AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(13, len(ws)) AS m FROM item WHERE len(ws) > 0),
phrase AS (
    SELECT DISTINCT item_id, m, array_to_string(ws[k:k + m - 1], ' ') AS p
    FROM (SELECT item_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS k FROM sized)
),
place AS (
    SELECT doc_id, k, m, array_to_string(ws[k:k + m - 1], ' ') AS p
    FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS k FROM doc, (SELECT DISTINCT m FROM sized) WHERE len(ws) >= m)
),
found AS (SELECT doc_id, k, m, item_id FROM place JOIN phrase USING (m, p)),
hit AS (
    SELECT doc_id, count(DISTINCT i) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + m)) AS i FROM found) GROUP BY doc_id
),
which AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN which USING (doc_id)""",
    "op3_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""",
    "op12_collocations": r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
p AS (SELECT lang, [w FOR w IN string_split_regex(piece, '[\x20\x09]+') IF w <> ''] AS ws FROM piece),
f AS (
    SELECT lang, m, array_to_string(ws[k:k + m - 1], ' ') AS phrase, count(*) AS n
    FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS k FROM p, (VALUES (1), (2), (3), (4), (5)) AS v(m) WHERE len(ws) >= m)
    GROUP BY ALL HAVING count(*) >= 100
),
total AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
cand AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, n AS a FROM f WHERE m > 1),
kept AS (
    SELECT * FROM cand AS c WHERE NOT EXISTS (
        SELECT 1 FROM cand AS o WHERE o.lang = c.lang AND o.m > c.m AND 100 * o.a >= 100 * c.a
            AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
),
cut AS (
    SELECT lang, phrase, a, k, array_to_string(ws[:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
    FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
),
scored AS (
    SELECT cut.lang, cut.phrase, a, k, fx.n AS l, fy.n AS r, total.n AS n,
        (1000::HUGEINT * a * total.n) // (fx.n::HUGEINT * fy.n) AS score
    FROM cut JOIN f AS fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f AS fy ON fy.lang = cut.lang AND fy.phrase = y
        JOIN total ON total.lang = cut.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000""",
    "op13_licenses": license_scan.oracle(),
}

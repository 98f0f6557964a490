"""Registered queries of this package, one per operator, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import block_naming, hard_negatives, jaccard_join, line_dedup, packing, ppm, prefix_tokens, quality, sentencepiece_fst, simhash, toxicity, warc_index, whitening
from plumbline.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5
), h AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS gram FROM g
), r AS (
  SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), s AS (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS c FROM r
), u AS (
  SELECT doc_id, sum(c) AS n_repeat_words FROM s GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '\p{Lu}'))::BIGINT AS n_upper,
         len(regexp_extract_all(text, '\p{L}'))::BIGINT AS n_letters,
         len(regexp_extract_all(text, '!'))::BIGINT AS n_exclamations,
         len(list_distinct(w))::BIGINT AS n_distinct_words
  FROM d LEFT JOIN u USING (doc_id)
), k AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines FROM m
), b AS (
  SELECT *, (RULE_BITS)::BIGINT AS fail_bits FROM k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
""".replace("RULE_BITS", " + ".join(
    f"CASE WHEN {test} THEN {1 << i} ELSE 0 END" for i, test in enumerate(quality.RULES.values())))


@query("op6_quality_rules", QUALITY_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ledger of ``documents`` under the latest policy."""
    rows = quality.apply_policy(quality.ledger(read(spark, sf_dir, "documents")), "v2")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits", "base_failed", "kept")


@query("op8_exact_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are exact copies, and which stays."""
    return block_naming.exact_duplicates(read(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents exceed a context of 4,096 tokens, and how much of them fits."""
    return prefix_tokens.budgets(read(spark, sf_dir, "documents"), 4096)


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return sentencepiece_fst.round_trips(read(spark, sf_dir, "documents"))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens."""
    return packing.best_fit(packing.pieces(read(spark, sf_dir, "documents"), "word_bpe_49k.json"))


@query("op4_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are near copies of each other."""
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of each document an earlier line makes redundant."""
    rows = line_dedup.deduplicated(read(spark, sf_dir, "documents"), min_words=1)
    return rows.select(
        "doc_id", "removed_lines", F.size("removed_lines").alias("n_removed"), F.octet_length("text").alias("kept_bytes"),
        F.sha2("text", 256).alias("kept_sha256"))


@query("op2_ppm_scores")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document under a byte model of the others."""
    return ppm.scored(read(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels that aren't held out."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, read(spark, sf_dir, "labels")))


@query("op1_warc_index", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS response FROM p GROUP BY html),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, response FROM p JOIN g USING (html)),
b AS (SELECT *, list_aggregate(list_transform(range(0, 40), lambda i:
        lpad(bin(('0x' || substr(hex, i + 1, 1))::INT), 4, '0')), 'string_agg', '') AS bits FROM h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
         + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to FROM b
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, indexed, looked up by URL and read back."""
    pages = read(spark, sf_dir, "pages")
    index = warc_index.build_index(warc_index.write_archives(pages))
    return warc_index.read_records(warc_index.look_up(index, pages)).drop("payload")


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the eight leading directions, each of unit variance."""
    return whitening.whitened_rows(read(spark, sf_dir, "embeddings"))


@query("op12_simhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents' fingerprints lie within three bits of each other."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op13_hard_negatives", """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the five nearest positives of every hundredth embedding."""
    rows = hard_negatives.shifted_labels(read(spark, sf_dir, "embeddings"))
    return hard_negatives.mined(hard_negatives.integer_vectors(rows))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning pipeline."""
    return corpus_pipeline.run(spark, sf_dir)

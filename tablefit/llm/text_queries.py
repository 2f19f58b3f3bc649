"""Queries of the operators that scan whole documents in Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm import decontaminate, quality, sentencepiece_codec, simhash, suffix_dedup, token_counts, toxicity
from tablefit.llm.common import table

#: The vocabulary file of the queries that encode or count tokens.
PIECE_MODEL = "piece_bpe_32k.model"

#: Fixed value of the toxicity contract.
TOXIC_FROM = 0.3
#: Fixed values of the SimHash contract.
SHINGLE_WORDS = 4
MAX_BITS = 4


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode_documents(docs, piece_model(), carry=["doc_id"], results=("n_tokens", "ids_sha256", "decoded_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs, SHINGLE_WORDS, MAX_BITS)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, piece_model(), carry=["doc_id"])


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i : i + least(len(w), 13) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
pos AS (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d),
firsts AS (SELECT DISTINCT win[1] AS f FROM bw),
dw AS (SELECT k, i, n, w[i : i + n - 1] AS win FROM pos JOIN firsts ON w[i] = f CROSS JOIN lens WHERE i + n - 1 <= len(w)),
hits AS (SELECT k, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
covered AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT k, i, n FROM hits)) GROUP BY k),
owners AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM hits) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (k) LEFT JOIN owners USING (k)
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs, carry=["doc_id"]).select("doc_id", *quality.STATS, "base_failed", "kept", "quality")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("kept")


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup, "op1_toxicity": op1_toxicity, "op2_sentencepiece": op2_sentencepiece, "op5_token_counts": op5_token_counts,
           "op3_simhash": op3_simhash, "op6_decontaminate": op6_decontaminate, "op7_quality_rules": op7_quality_rules}
ORACLES = {"op6_decontaminate": OP6_SQL}

"""Queries of the operators that rank: hard negatives, lexical search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm import hard_negatives, lexical_search
from tablefit.llm.common import table


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
sizes AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, sum(len(w))::HUGEINT AS n_terms FROM d),
lens AS (SELECT k, doc_id, 100 - 90 + (90::HUGEINT * len(w) * n_docs) // n_terms AS m FROM d, sizes WHERE len(w) > 0),
tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY k, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sizes GROUP BY term),
points AS (SELECT k, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS p FROM tf JOIN weights USING (term) JOIN lens USING (k)),
scores AS (SELECT item_id, k, doc_id, sum(p)::BIGINT AS score FROM q JOIN points USING (term) GROUP BY item_id, k, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, k)::INT AS rank, doc_id, score FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, k) <= 10
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_, label = F.col("vec_id"), F.col("label")
    given = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mine_hard_negatives(given)


OP12_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank, other_id AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
"""


QUERIES = {"op11_lexical_search": op11_lexical_search, "op12_hard_negatives": op12_hard_negatives}
ORACLES = {"op11_lexical_search": OP11_SQL, "op12_hard_negatives": OP12_SQL}

"""A training corpus from ``documents``: five stages, each over all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs.  All but the last return the columns of docs.  Docs columns with any other name are carried along unread, also where they are
called like a result of a stage.  Every stage reads texts of any length whole and gives no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm import decontaminate, pii, quality, sentencepiece_codec, simhash
from tablefit.llm.common import quoted, table
from tablefit.llm.text_queries import MAX_BITS, SHINGLE_WORDS, piece_model
from tablefit.session import scratch_path

#: No SQL: the label model of the quality rules is fitted by iteration.
ORACLE_SQL = None
ENCODED = ("n_tokens", "ids", "decoded_sha256")


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Docs with columns that no stage reads renamed out of the way of results, and the names to give back."""
    names = {c: c if c in ("doc_id", "text") else f"__doc{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[quoted(c).alias(n) for c, n in names.items()]), {n: c for c, n in names.items()}


def _back(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(n).alias(c) for n, c in names.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  Null, empty and very short texts go; repeated rows are judged alike, and stay or go together."""
    given, names = _aside(docs)
    return _back(quality.quality_rules(given).where("kept"), names)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Repeated rows and texts without words are copies of each other; null ids come last, and of several rows with one id and fingerprint the one first by a hash
    of its columns stays.
    """
    given, names = _aside(docs)
    return _back(simhash.drop_near_copies(given, SHINGLE_WORDS, MAX_BITS), names)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule does not hit.  Null and empty texts have no words and stay; repeated rows are judged alike."""
    given, names = _aside(docs)
    return _back(decontaminate.find_contamination(given, table(spark, sf_dir, "benchmark")).where("not contaminated"), names)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows a changed text.  Null texts stay null, empty ones empty; repeated rows stay repeated."""
    given, names = _aside(docs)
    masked = _back(pii.mask_pii(given.withColumn("__plain", F.col("text"))), {**names, "__plain": "__plain"})
    changed = ~F.col("__plain").eqNullSafe(F.col("text"))
    chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return masked.select(*[chars.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else quoted(c) for c in docs.columns])


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The other columns of each document, with the ids of its text, their number, and a digest of the text decoded from them.

    Null texts are encoded as empty ones; repeated rows stay repeated; other columns called like these results give way to them.
    """
    carry = [c for c in docs.columns if c != "text" and c not in ENCODED]
    return sentencepiece_codec.encode_documents(docs, piece_model(), carry=carry, results=ENCODED)


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("PII", pii_stage),
    ("SentencePiece encoding and decoding", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns goes to the shared folder, and the last one's result is returned."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "corpus")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

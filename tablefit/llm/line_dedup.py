"""Removal of lines that several documents share.

1. Every text is cut into lines; a line's key is the line without white space at its ends, A-Z in lower case, and goes on as a
   128-bit hash with its document and position.  Short keys take no part.
2. Distinct documents are counted for each hash, (hash, document) pairs first, so that a very common line is summed up before it moves.
3. Hashes over the threshold come back to their lines by a join; where one hash holds very many lines, adaptive execution
   splits it, as the other side has one row for each hash.
4. A document's dropped positions are taken from its lines; the rest is put together in its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import ascii_lower, quoted
from tablefit.session import cut_lineage

#: ASCII white space, as stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Fixed values of the query contract: a key's least code points, and the documents from which on a line is repeated.
MIN_CHARS = 10
MIN_DOCS = 2
LAST = (1 << 63) - 1  # stands for a null id


def _lower(text: Column) -> Column:
    """A-Z in lower case; ``lower`` is faster and the same where all characters are ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(ascii_lower(text))


def _wide_hash(*cols: Column) -> list[Column]:
    """128 bits in two numbers."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id column, ``n_lines``, ``n_dropped``, ``kept``: the remaining lines joined) of each row of ``docs``.

    Lines whose key has ``min_chars`` code points or more and occurs in ``min_docs`` documents or more go, except from the document with the
    smallest id that holds it (all of its copies stay).  A document is its id: rows with one id are one document, whatever their
    texts, and each gives a row of its own; rows without id are one document behind all others.  Null and empty texts
    are one empty line; a text that loses all lines becomes empty.  Texts of any length are read whole.  Other columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    given = docs.select(quoted(id_col).alias("own_id"), F.coalesce(quoted(id_col).cast("long"), F.lit(LAST)).alias("id"),
                        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("body"))
    given = given.withColumns(dict(zip(("tag1", "tag2"), _wide_hash(F.col("body")), strict=True)))  # tells apart texts of one id
    row = ["id", "tag1", "tag2"]

    key = F.btrim("line", F.lit(BLANKS))
    lines = (
        given.select(*row, F.posexplode(F.split(_lower(F.col("body")), "\n", -1)).alias("pos", "line"))
        .where(F.length(key) >= min_chars)
        .select(*row, "pos", *[h.alias(n) for n, h in zip(("h1", "h2"), _wide_hash(key), strict=True)])
    )
    # written: so both sides of the join below come from a shuffle of their own, and adaptive execution can split a very common line
    repeated = cut_lineage(
        lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n_docs"), F.min("id").alias("first_id"))
        .where(F.col("n_docs") >= min_docs).drop("n_docs")
    )
    dropped = (
        lines.join(repeated, ["h1", "h2"]).where(F.col("id") != F.col("first_id"))
        .groupBy(*row).agg(F.collect_set("pos").alias("dropped"))  # positions of one text; those of repeated rows are the same
    )
    parts = F.split("body", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("dropped"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("parts"), i)), "\n")
    return (
        given.join(dropped, row, "left").withColumn("parts", parts)
        .select(
            F.col("own_id").alias(id_col),
            F.size("parts").cast("long").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("dropped").isNull(), F.col("body")).otherwise(kept).alias("kept"),
        )
    )

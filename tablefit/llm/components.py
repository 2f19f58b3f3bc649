"""Connected components of a graph given by links, by alternating star contraction."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.session import cut_lineage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (two long columns ``a``, ``b``); the root is the smallest node reached.

    Each round joins every node's larger neighbours, then its smaller ones, to the smallest neighbour; the number
    of rounds grows with the logarithm of the longest path.  A minimum is pre-aggregated before its shuffle, and
    a node with very many neighbours is a skewed key of a join, which adaptive execution splits.  The links of each round are
    written to the shared checkpoint folder.  Null ends and self-links are ignored.
    """
    edges = _state(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _mark(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        edges = _state(small)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    # stars: every node but the roots is a larger end once
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges)


def _mark(edges: DataFrame) -> tuple[int, Decimal | None]:
    """Tells two sets of links apart by their number and a sum of hashes; the sum is a decimal(38, 0), which no number of links overflows."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(28,0)")).alias("h")).first()
    return row["n"], row["h"]

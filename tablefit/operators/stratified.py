"""Splits of an exact size for each label.

The rows of a label are ordered by the hash of their key, as in ``operators.split``, and the first round(fraction * n) of them are the training rows.  No label is
sorted: its cut is found by counts of rows by label and twelve bits of the hash, three times, each within the range that the last count left; only
the rows whose hash is the cut itself are numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.functions.expr import hex_hash
from tablefit.operators.split import _key

#: Bits of the 32-bit hash that each count looks at, high ones first.
STEPS = (12, 12, 8)
#: Labels up to which the cuts are broadcast; beyond, they are joined like any table.
MAX_BROADCAST = 100_000


def label_cuts(df: DataFrame, key: str, label: str, fraction: float, tag: str | None = None) -> DataFrame:
    """(label, cut, within): the training rows of a label have a hash below ``cut``, or are the first ``within`` of those at it."""
    hashed = df.select(F.col(label).alias("label"), hex_hash(_key(key), tag).alias("h"))
    cuts = hashed.groupBy("label").agg(F.round(F.count(F.lit(1)) * F.lit(fraction)).cast("long").alias("within")).withColumn("cut", F.lit(0).cast("long"))
    rest = 32
    for bits in STEPS:
        rest -= bits
        mine = F.shiftright("h", rest + bits) == F.shiftright("cut", rest + bits)  # in the range found so far
        counts = (
            hashed.withColumnRenamed("label", "of").join(cuts, F.col("of").eqNullSafe(F.col("label"))).where(mine)
            .groupBy("label", "within", F.shiftright("h", rest).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        )  # 2^bits rows for each label
        order = Window.partitionBy("label").orderBy("part")
        below = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
        placed = counts.withColumn("below", below).where(F.col("below") <= F.col("within"))
        cuts = placed.groupBy("label").agg(F.max(F.struct("part", (F.col("within") - F.col("below")).alias("within"))).alias("last")).select(
            "label", "last.within", F.shiftleft("last.part", rest).alias("cut"))
    return cuts


def stratified_split(df: DataFrame, key: str, label: str, fraction: float = 0.8, col: str = "split", tag: str | None = None) -> DataFrame:
    """Adds ``col`` = 'train' / 'test', with exactly round(fraction * n) training rows among the n rows of each label (half up).

    A row's side depends on its key and label alone while keys differ; rows at the cut with the same hash go by key, then by a hash of all their columns.
    A null label is a label; null keys hash like the empty string.  A label of no more than half a row in training has none.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    cuts = label_cuts(df, key, label, fraction, tag).select(F.col("label").alias("__label"), F.col("within").alias("__within"), F.col("cut").alias("__cut"))
    if cuts.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        cuts = F.broadcast(cuts)
    marked = df.withColumn("__h", hex_hash(_key(key), tag)).join(cuts, F.col(label).eqNullSafe(F.col("__label")), "left")
    at_cut = F.col("__h") == F.col("__cut")
    order = Window.partitionBy("__label").orderBy(_key(key), F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]))
    edge = marked.where(at_cut).withColumn("__train", F.row_number().over(order) <= F.col("__within"))
    rest = marked.where(~at_cut).withColumn("__train", F.col("__h") < F.col("__cut"))
    both = edge.unionByName(rest).withColumn(col, _side(F.col("__train")))
    return both.select(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != col], col)


def _side(train: Column) -> Column:
    return F.when(train, F.lit("train")).otherwise(F.lit("test"))

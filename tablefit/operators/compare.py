"""Paired comparison of two models' areas under ROC on the same rows (DeLong's variance).

A positive row's placement under a model is the share of negatives scored below it, ties one half; a negative's is the share of positives
above it.  The area is the mean placement, and the variance of the difference of two areas comes from the differences of the rows' two
placements.  Placements are exact: negatives and positives below each distinct score are running sums within ranges of the scores, on top of
sums over one row for each range, as in ``evaluate.auc``.  Rows are counted by (label, score, score) before they meet the placements.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.functions.expr import as_col
from tablefit.operators.evaluate import DEFAULT_ROWS_PER_BUCKET, _score_boundaries

#: Two-sided 95 % of the normal distribution.
Z_95 = 1.959963984540054


def placements(scored: DataFrame, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """(s, of_pos, of_neg) of rows (s double, y boolean, c bigint: how many such rows): the placement of a positive and of a negative at each score."""
    g = scored.groupBy("s").agg(F.sum(F.when(F.col("y"), F.col("c")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y"), 0).otherwise(F.col("c"))).alias("neg"))
    bounds = _score_boundaries(g, None, None, rows_per_bucket)
    if bounds:
        g = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="s", outputCol="b").transform(g)
    else:
        g = g.withColumn("b", F.lit(0.0))
    kinds = ("pos", "neg")
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    ranges = g.groupBy("b").agg(*[F.sum(k).alias(f"{k}_in") for k in kinds])
    offsets = ranges.select("b", *[F.coalesce(F.sum(f"{k}_in").over(before), F.lit(0)).alias(f"{k}_before") for k in kinds])
    total = ranges.agg(*[F.sum(f"{k}_in").alias(f"n_{k}") for k in kinds])
    within = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = g.join(F.broadcast(offsets), "b").join(F.broadcast(total))

    def below(kind: str) -> Column:
        return F.col(f"{kind}_before") + F.coalesce(F.sum(kind).over(within), F.lit(0))

    return ranked.select(
        "s", F.try_divide(below("neg") + F.col("neg") / 2, F.col("n_neg")).alias("of_pos"),
        F.try_divide(F.col("n_pos") - below("pos") - F.col("pos") / 2, F.col("n_pos")).alias("of_neg"))


def compare_auc(df: DataFrame, score_a: str | Column, score_b: str | Column, label: str = "label", positive: float = 1.0, z: float = Z_95,
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """One row: n_pos, n_neg, n_dropped, auc_a, auc_b, se_a, se_b, difference (a - b), se, z, low, high (of the difference).

    Only rows with a label and both scores count (``n_dropped``: the others).  Standard errors are null with fewer than two rows of a class;
    ``z`` is null where the difference does not vary.
    """
    a, b = (as_col(s).cast("double") for s in (score_a, score_b))
    rows = df.select((F.col(label).cast("double") == F.lit(positive)).alias("y"), a.alias("a"), b.alias("b"))
    usable = F.col("y").isNotNull() & F.col("a").isNotNull() & ~F.isnan("a") & F.col("b").isNotNull() & ~F.isnan("b")
    counted = rows.where(usable).groupBy("y", "a", "b").agg(F.count(F.lit(1)).alias("c"))
    both = counted
    for s in ("a", "b"):
        of = placements(counted.select(F.col(s).alias("s"), "y", "c"), rows_per_bucket)
        both = both.join(of.select(F.col("s").alias(s), F.col("of_pos").alias(f"{s}_pos"), F.col("of_neg").alias(f"{s}_neg")), s)
    # about one half, so that squares lose nothing
    values = both.select("y", "c", *[(F.when(F.col("y"), F.col(f"{s}_pos")).otherwise(F.col(f"{s}_neg")) - 0.5).alias(f"v{s}") for s in ("a", "b")])
    values = values.withColumn("vd", F.col("va") - F.col("vb"))
    names = ("va", "vb", "vd")
    sums = [e for v in names for k, y in (("pos", F.col("y")), ("neg", ~F.col("y"))) for e in (
        F.sum(F.when(y, F.col("c") * F.col(v))).alias(f"{v}_{k}_1"), F.sum(F.when(y, F.col("c") * F.col(v) * F.col(v))).alias(f"{v}_{k}_2"))]
    sums += [F.coalesce(F.sum(F.when(y, F.col("c"))), F.lit(0)).alias(f"n_{k}") for k, y in (("pos", F.col("y")), ("neg", ~F.col("y")))]

    def variance(v: str) -> Column:
        parts = []
        for k in ("pos", "neg"):
            n, one, two = F.col(f"n_{k}"), F.col(f"{v}_{k}_1"), F.col(f"{v}_{k}_2")
            parts.append(F.try_divide(F.try_divide(F.greatest(two - F.try_divide(one * one, n), F.lit(0.0)), n - 1), n))
        return parts[0] + parts[1]

    def area(v: str) -> Column:
        return F.try_divide(F.col(f"{v}_pos_1"), F.col("n_pos")) + 0.5

    done = values.agg(*sums).join(df.select(F.lit(1)).agg(F.count(F.lit(1)).alias("n_all")))  # one row each
    se, difference = F.sqrt(variance("vd")), area("va") - area("vb")
    return done.select(
        "n_pos", "n_neg", (F.col("n_all") - F.col("n_pos") - F.col("n_neg")).alias("n_dropped"), area("va").alias("auc_a"), area("vb").alias("auc_b"),
        F.sqrt(variance("va")).alias("se_a"), F.sqrt(variance("vb")).alias("se_b"), difference.alias("difference"), se.alias("se"),
        F.try_divide(difference, se).alias("z"), (difference - F.lit(z) * se).alias("low"), (difference + F.lit(z) * se).alias("high"))

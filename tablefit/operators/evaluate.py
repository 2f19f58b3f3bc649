"""Model metrics as DataFrame aggregations.

Every metric bundle is ONE aggregation (conditional counts / moments with
partial aggregation), instead of one job per metric over a row-deserialised
RDD.  Results are one-row (or one-row-per-group) frames, so models can be
compared by a plain union + order by.

``auc`` is the exact, threshold-swept area under ROC (Mann-Whitney with ties
counted one half) -- what ``BinaryClassificationEvaluator`` computes with
``numBins=0`` -- without a global sort or a window over the whole table:

1. group by score: one row per distinct score with (pos, neg) counts
   (partial aggregation: a score repeated by a third of all rows is one row);
2. cut the distinct scores into ranges at approximate quantiles, at most about
   ``rows_per_bucket`` distinct scores each (the boundaries, one double for
   each range, are the only thing on the driver);
3. per-bucket negative totals (<= ``buckets`` rows) give each bucket its
   offset by a running sum on that small frame, broadcast back (bounded);
4. within a bucket, a running sum over the ordered scores (a window
   partitioned by bucket, each a bounded slice of the distinct scores).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.functions.expr import as_col

DEFAULT_ROWS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 64


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       group_by: Sequence[str] = ()) -> DataFrame:
    """n, rmse, mse, mae, r2 (= 1 - mse / population variance of the label), all over
    the rows with a label and a prediction, and ``n_dropped``, the others."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    y = F.when(err.isNotNull(), F.col(label).cast("double"))
    aggs = [
        F.count(err).alias("n"),
        F.count_if(err.isNull()).alias("n_dropped"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop(y).alias("_var"),
    ]
    g = df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
    return g.select(
        *group_by, "n", "n_dropped",
        F.sqrt("mse").alias("rmse"), "mse", "mae",
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              group_by: Sequence[str] = ()) -> DataFrame:
    """Long-form confusion matrix ``(label, prediction, count)``: rows are the
    actual class, columns the predicted one."""
    return (df.groupBy(*group_by, F.col(label).cast("double").alias("label"),
                       F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   group_by: Sequence[str] = (), positive: float = 1.0) -> DataFrame:
    """TP/FP/FN/TN and everything derived from them, in one aggregation.

    ``balanced_accuracy`` = (TPR + TNR) / 2 is the area under the ROC curve
    of *hard* 0/1 predictions (one threshold), which is what an AUC fed with
    predictions instead of scores reports.  ``f1`` is the F-measure of the
    positive class (not the label-weighted F1).
    """
    y = F.col(label).cast("double") == F.lit(positive)
    p = F.col(prediction).cast("double") == F.lit(positive)
    aggs = [
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    ]
    g = df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    tpr, tnr = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return g.select(
        *group_by, "tp", "fp", "fn", "tn", n.alias("n"),
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        tpr.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ((tpr + tnr) / F.lit(2.0)).alias("balanced_accuracy"),
    )


def auc(df: DataFrame, label: str = "label", score: str | Column = "score",
        buckets: int | None = None, accuracy: int | None = None, positive: float = 1.0,
        group_by: Sequence[str] = (), rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Exact area under ROC of a score, one row per group: ``(*group_by, auc, n_dropped)``.

    ``n_dropped`` counts the rows left out: null or NaN score, or null label.

    See the module doc; with ``group_by`` (e.g. a ``model`` column of stacked
    predictions) every group is ranked separately in the same jobs.  By
    default the number of score ranges follows the number of distinct scores
    (about ``rows_per_bucket`` each, ``LEAST_BUCKETS`` at least), so the ordered
    slice one window task holds stays bounded as the data grows; ``buckets``
    fixes it instead.
    """
    keys = list(group_by)
    s = as_col(score).cast("double")
    base = df.select(*keys, s.alias("s"), (F.col(label).cast("double") == F.lit(positive)).alias("y"))
    # rows without a score or label are counted in one more group, whose score is null
    usable = F.col("s").isNotNull() & ~F.isnan("s") & F.col("y").isNotNull()
    counted = base.groupBy(*keys, F.when(usable, F.col("s")).alias("s")).agg(
        F.count_if(F.col("y")).cast("double").alias("pos"),
        F.count_if(~F.col("y")).cast("double").alias("neg"),
        F.count(F.lit(1)).alias("rows"),
    )
    g = counted.where(F.col("s").isNotNull())
    bounds = _score_boundaries(g, buckets, accuracy, rows_per_bucket)
    if bounds:
        splits = [float("-inf")] + bounds + [float("inf")]
        gb = Bucketizer(splits=splits, inputCol="s", outputCol="b").transform(g)
    else:
        gb = g.withColumn("b", F.lit(0.0))
    totals = gb.groupBy(*keys, "b").agg(F.sum("neg").alias("bneg"))  # <= groups x buckets rows
    before = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "b", F.coalesce(F.sum("bneg").over(before), F.lit(0.0)).alias("neg_before"))
    if not keys:
        offsets = F.broadcast(offsets)  # at most `buckets` rows
    within = Window.partitionBy(*keys, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = gb.join(offsets, [*keys, "b"]).withColumn(
        "below", F.col("neg_before") + F.coalesce(F.sum("neg").over(within), F.lit(0.0)))
    agg = F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.lit(0.5) * F.col("neg"))),
                       F.sum("pos") * F.sum("neg")).alias("auc")
    dropped = F.sum(F.when(F.col("s").isNull(), F.col("rows")).otherwise(0)).alias("n_dropped")
    if not keys:
        return ranked.agg(agg).join(counted.agg(F.coalesce(dropped, F.lit(0)).alias("n_dropped")))  # one row each
    return counted.groupBy(*keys).agg(dropped).join(ranked.groupBy(*keys).agg(agg), keys, "left").select(*keys, "auc", "n_dropped")


def _quantile_grid(g: DataFrame, grid: int, accuracy: int | None, with_count: bool = False):
    probs = [i / grid for i in range(1, grid)] or [0.5]
    acc = accuracy or max(10_000, 4 * grid)
    aggs = [F.percentile_approx("s", probs, acc).alias("q")]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("n"))
    row = g.agg(*aggs).head()
    bounds = sorted(set(row["q"] or [])) if grid > 1 else []
    return bounds, (row["n"] if with_count else None)


def _score_boundaries(g: DataFrame, buckets: int | None, accuracy: int | None,
                      rows_per_bucket: int) -> list[float]:
    """Range boundaries over the distinct scores.  One pass gives their count
    and a grid of ``LEAST_BUCKETS`` ranges; a finer grid costs a second pass."""
    if buckets is not None:
        return _quantile_grid(g, buckets, accuracy)[0]
    bounds, n = _quantile_grid(g, LEAST_BUCKETS, accuracy, with_count=True)
    wanted = -(-n // rows_per_bucket)
    return _quantile_grid(g, wanted, accuracy)[0] if wanted > LEAST_BUCKETS else bounds


def stack_predictions(df: DataFrame, models: dict, label: str = "label",
                      score_index: int = 1) -> DataFrame:
    """Score ``df`` with several fitted classifiers in ONE pass and stack the
    results as ``(model, label, prediction, score)``.

    Each model writes its own output columns, so the input is scanned once
    for all of them; the score is the positive-class probability.
    """
    out = df
    for name, model in models.items():
        m = model.copy()
        m = m.setPredictionCol(f"{name}__prediction")
        if m.hasParam("probabilityCol"):
            m = m.setProbabilityCol(f"{name}__probability").setRawPredictionCol(f"{name}__raw")
        out = m.transform(out)
    from pyspark.ml.functions import vector_to_array

    values = {
        name: F.struct(F.col(f"{name}__prediction").alias("prediction"),
                       vector_to_array(F.col(f"{name}__probability")).getItem(score_index).alias("score"))
        for name in models
    }
    wide = out.select(F.col(label).cast("double").alias("label"), *[v.alias(n) for n, v in values.items()])
    long = wide.unpivot(ids=["label"], values=list(models), variableColumnName="model", valueColumnName="v")
    return long.select("model", "label", "v.prediction", "v.score")


def model_metrics(stacked: DataFrame) -> DataFrame:
    """Metric bundle + exact swept AUC per model of stacked predictions."""
    bundle = binary_metrics(stacked, group_by=["model"])
    swept = auc(stacked, score="score", group_by=["model"])
    return bundle.join(swept, "model")  # one row per model on each side


def leaderboard(bundles: Sequence[DataFrame], metric: str = "balanced_accuracy",
                larger_is_better: bool = True) -> DataFrame:
    """Union of one-row-per-model metric frames, best first, with its ``rank``;
    ties (to ten digits) go by the model name."""
    out = bundles[0]
    for b in bundles[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    value = F.round(F.col(metric), 10)
    order = [value.desc_nulls_last() if larger_is_better else value.asc_nulls_last(), F.asc("model")]
    ranked = out.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # one row per model
    return ranked.withColumn("ranked_by", F.lit(metric)).orderBy("rank")


def stack_regressions(df: DataFrame, models: dict, label: str = "label") -> DataFrame:
    """Score ``df`` with several fitted regressors in ONE pass and stack the
    results as ``(model, label, prediction)``."""
    out = df
    for name, model in models.items():
        out = model.copy().setPredictionCol(f"{name}__prediction").transform(out)
    wide = out.select(F.col(label).cast("double").alias("label"),
                      *[F.col(f"{n}__prediction").alias(n) for n in models])
    return wide.unpivot(ids=["label"], values=list(models), variableColumnName="model",
                        valueColumnName="prediction")

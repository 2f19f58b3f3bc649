"""Searches from sums over all folds: against Spark ML's own cross-validation."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tablefit.operators import models, split, tune
from tablefit.operators.gram import fold_gram, search_linear, solve
from tablefit.operators.logistic_grid import search_logistic
from tablefit.operators.partials import collected, sum_by_key

COLS = ["a", "b", "c", "d", "k"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    n = 3000
    x = np.column_stack([rng.normal(1000, 3, n), rng.exponential(2, n), rng.integers(0, 2, n), rng.normal(0, 0.01, n), np.full(n, 7.0)])
    margin = 0.4 * (x[:, 0] - 1000) - 0.8 * x[:, 1] + 1.5 * x[:, 2] + 40 * x[:, 3] + 0.3
    label = (rng.random(n) < 1 / (1 + np.exp(-margin))).astype(float)
    value = 5e4 + 30 * margin + rng.normal(0, 20, n)
    rows = [(i, *map(float, r), float(y), float(v)) for i, (r, y, v) in enumerate(zip(x, label, value))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, k double, label double, value double").repartition(5)
    df = split.with_folds(df, "id", 4)
    return VectorAssembler(inputCols=COLS, outputCol="features").transform(df).cache()


def test_sums_by_key_add_up(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").cast("double").alias("x"))

    def step(batch):
        x = batch.column(0).to_numpy()
        return {int(k): np.array([x[x % 3 == k].sum(), (x % 3 == k).sum()]) for k in range(3)}

    got = collected(sum_by_key(df, step, ways=2), 3)
    assert {k: v.tolist() for k, v in got.items()} == {k: [float(sum(range(k, 1000, 3))), len(range(k, 1000, 3))] for k in range(3)}
    with pytest.raises(ValueError):
        collected(sum_by_key(df, step), 2)
    assert collected(sum_by_key(df.where("x < 0"), lambda b: {}), 1) == {}


def test_linear_search_equals_spark(frame):
    grid = {"regParam": [0.0, 20.0], "elasticNetParam": [0.0, 0.3]}
    got = search_linear(frame.withColumn("label", F.col("value")), grid, 4)
    cv = tune.cross_validate(LinearRegression(labelCol="value", maxIter=500, tol=1e-12), grid, frame, RegressionEvaluator(labelCol="value", metricName="rmse"), num_folds=4)
    assert [p for p in got.points] == [{q.name: v for q, v in m.items()} for m in cv.getEstimatorParamMaps()]
    assert got.metrics.mean(axis=1) == pytest.approx(cv.avgMetrics, rel=1e-6)
    assert got.metrics.std(axis=1) == pytest.approx(cv.stdMetrics, rel=1e-4)
    assert got.points[got.best] == {q.name: v for q, v in cv.getEstimatorParamMaps()[tune.best_point(cv.avgMetrics, False)].items()}
    assert got.best_fit.coefficients == pytest.approx(cv.bestModel.coefficients.toArray(), rel=1e-5, abs=1e-8)
    assert got.best_fit.intercept == pytest.approx(cv.bestModel.intercept, rel=1e-6)


def test_logistic_search_equals_spark(frame):
    grid = models.GRIDS["logistic_regression"]
    got, by_fold = search_logistic(frame, grid, 4)
    cv = tune.cross_validate(LogisticRegression(maxIter=500, tol=1e-12), grid, frame, tune.auc_evaluator(num_bins=0), num_folds=4, parallelism=8)
    assert got.metrics.mean(axis=1) == pytest.approx(cv.avgMetrics, abs=1e-6)
    assert got.metrics.std(axis=1) == pytest.approx(cv.stdMetrics, abs=1e-6)
    best = cv.bestModel
    assert got.points[got.best] == {q.name: v for q, v in cv.getEstimatorParamMaps()[tune.best_point(cv.avgMetrics, True)].items()}
    assert got.best_fit.coefficients == pytest.approx(best.coefficients.toArray(), rel=1e-5, abs=1e-6)
    assert got.best_fit.intercept == pytest.approx(best.intercept, rel=1e-5)
    one = LogisticRegression(maxIter=500, tol=1e-12, regParam=0.1, elasticNetParam=0.2).fit(frame.where("fold <> 2"))
    at = got.points.index({"regParam": 0.1, "elasticNetParam": 0.2})
    assert by_fold[2][at].coefficients == pytest.approx(one.coefficients.toArray(), rel=1e-5, abs=1e-6)


def test_search_results_as_frames(spark, frame):
    got = search_linear(frame.withColumn("label", F.col("value")), {"regParam": [0.0, 1.0]}, 4)
    rows = got.results(spark).collect()
    assert [r["params"] for r in rows] == ['{"regParam": 0.0}', '{"regParam": 1.0}'] and sum(r["is_best"] for r in rows) == 1
    assert got.by_fold(spark).count() == 8
    with pytest.raises(ValueError):
        search_linear(frame, {"maxIter": [1]}, 4)


def test_rows_without_values_are_left_out(spark):
    rows = [(0, [1.0, 2.0], 1.0), (0, None, 1.0), (1, [2.0, float("nan")], 1.0), (1, [3.0, 1.0], None), (None, [1.0, 1.0], 1.0), (1, [2.0, 5.0], 3.0), (0, [4.0, 4.0], 2.0), (1, [0.0, 1.0], 0.5)]
    df = spark.createDataFrame(rows, "fold int, features array<double>, label double")
    gram = fold_gram(df, 2)
    assert [gram.sums[f][0, 0] for f in (0, 1)] == [2, 2]
    fit = solve(gram.total, gram.shift)
    x, y = np.array([[1, 1, 2], [1, 2, 5], [1, 4, 4], [1, 0, 1]], dtype=float), np.array([1, 3, 2, 0.5])
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert [fit.intercept, *fit.coefficients] == pytest.approx(want.tolist())
    with pytest.raises(ValueError):
        search_logistic(df.where("fold = 0"), {"regParam": [0.1]}, 1)

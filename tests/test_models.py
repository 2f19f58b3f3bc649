import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import evaluate, features, models, split, tune
from tablefit.operators.quantile import exact_quantiles
from tablefit.sources import blocks, spread


def test_linear_regression_residual_invariants(spark, sf_small):
    df = blocks(spark, sf_small).where("lines IS NOT NULL")
    cols = ["balance", "total_qty", "lines", "ext_price"]
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    m = models.estimator("linear_regression", labelCol="total_value").fit(data)
    scored = m.transform(data).withColumn("resid", F.col("total_value") - F.col("prediction"))
    stats = scored.agg(F.avg("resid").alias("mean"), *[F.corr("resid", c).alias(c) for c in cols]).head()
    assert abs(stats["mean"]) < 1e-6 * 1e5
    for c in cols:
        assert abs(stats[c]) < 1e-6
    coefs = models.coefficients_frame(spark, m, data)
    assert [r.feature for r in coefs.collect()] == cols + ["intercept"]
    summary = models.training_summary_frame(spark, m).head()
    direct = evaluate.regression_metrics(scored, "total_value", "prediction").head()
    assert summary.rmse == pytest.approx(direct.rmse, rel=1e-9)


def test_one_feature_slope_matches_regr_slope(spark, sf_small):
    df = blocks(spark, sf_small).where("ext_price IS NOT NULL")
    data = VectorAssembler(inputCols=["ext_price"], outputCol="features").transform(df)
    m = models.estimator("linear_regression", labelCol="total_value").fit(data)
    r = df.agg(F.regr_slope("total_value", "ext_price").alias("b"),
               F.regr_intercept("total_value", "ext_price").alias("a")).head()
    assert m.coefficients[0] == pytest.approx(r.b, rel=1e-8)
    assert m.intercept == pytest.approx(r.a, rel=1e-6, abs=1e-3)


def test_cv_best_is_argmax_and_folds_deterministic(spark, sf_small):
    from tablefit.plans.feature_queries import client_features

    df, pipe = client_features(spark, sf_small)
    fitted = features.fit_features(pipe, df, train=df.where("split = 'train'"))
    train = split.with_folds(features.modelling_frame(fitted, df.where("split = 'train'"), "id"), "id", 3)
    cvm = tune.cross_validate(models.estimator("logistic_regression"),
                              {"regParam": [0.3, 0.0]}, train, num_folds=3)
    res = tune.cv_results(spark, cvm).collect()
    best = max(res, key=lambda r: r.mean_metric)
    assert best.is_best and sum(r.is_best for r in res) == 1
    chosen = {r.param: r.value for r in tune.best_params(spark, cvm, ["regParam"]).collect()}
    assert float(chosen["regParam"]) == json.loads(best.params)["regParam"]
    again = tune.cross_validate(models.estimator("logistic_regression"),
                                {"regParam": [0.3, 0.0]}, train, num_folds=3)
    assert again.avgMetrics == pytest.approx(cvm.avgMetrics, abs=1e-12)
    assert tune.best_point(again.avgMetrics, True) == tune.best_point(cvm.avgMetrics, True)


def test_registry_grids_build(spark):
    for name, grid in models.GRIDS.items():
        maps = tune.param_grid(models.estimator(name), grid)
        n = 1
        for v in grid.values():
            n *= len(v)
        assert len(maps) == n


def test_spread_is_noop_when_wide_enough(spark):
    wide = spark.range(0, 100, numPartitions=16)
    assert wide.rdd.getNumPartitions() == 16
    assert spread(wide, "id", min_partitions=8) is wide
    assert spread(spark.range(0, 100, numPartitions=1), "id", min_partitions=8).rdd.getNumPartitions() == 8


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float),
                                 st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60),
       p=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    valid = sorted(v for v in values if v is not None)
    want = valid[max(1, math.ceil(p * len(valid))) - 1] if valid else None
    got = exact_quantiles(df, ["x"], p, accuracy=4, final_limit=3)["x"]
    assert got == want


def test_leak_free_search_fits_features_on_the_other_folds(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    rows = [(float(i), float(3 * i % 11), i % 3) for i in range(60)] + [(1e6, 1.0, 0)]
    train = spark.createDataFrame(rows, "x double, label double, fold int")
    prep = features.numeric_stage(["x"], output_col="features", with_mean=True)
    est = models.estimator("linear_regression")
    cvm = tune.cross_validate_pipeline(prep, est, {"regParam": [0.0, 5.0]}, train, RegressionEvaluator(metricName="rmse"),
                                       num_folds=3, parallelism=2)
    assert len(cvm.avgMetrics) == len(cvm.stdMetrics) == 2
    assert cvm.bestModel.transform(train).count() == 61
    fold = []
    for k in range(3):
        fitted = prep.fit(train.where(f"fold <> {k}"))
        model = est.copy({est.regParam: 5.0}).fit(fitted.transform(train.where(f"fold <> {k}")))
        fold.append(RegressionEvaluator(metricName="rmse").evaluate(model.transform(fitted.transform(train.where(f"fold = {k}")))))
    assert cvm.avgMetrics[1] == pytest.approx(sum(fold) / 3, rel=1e-9)
    assert sum(r.is_best for r in tune.cv_results(spark, cvm).collect()) == 1

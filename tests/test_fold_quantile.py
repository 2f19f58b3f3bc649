"""Medians of fold complements: against sorted lists, and in the leak-free search."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tablefit.operators import features, tune
from tablefit.operators.fold_quantile import complement_quantiles


def brute(rows, k, p):
    out = {}
    for f in range(k):
        out[f] = {}
        for name, at in (("a", 1), ("b", 2)):
            values = sorted(r[at] for r in rows if r[0] is not None and r[0] != f and r[at] is not None and not math.isnan(r[at]))
            out[f][name] = values[max(1, math.ceil(p * len(values))) - 1] if values else None
    return out


def made(spark, rows):
    return spark.createDataFrame(rows, "fold int, a double, b double").repartition(6)


@pytest.mark.parametrize("limit,accuracy", [(100_000, 10_000), (200, 50)])
def test_against_sorted_lists(spark, limit, accuracy):
    rnd = random.Random(4)
    rows = [(rnd.choice([0, 1, 2, 3, 3, 3, None]), rnd.choice([None, float("nan"), rnd.gauss(0, 1)]), float(rnd.choice([1, 1, 1, 2, 5, rnd.randint(0, 900)]))) for _ in range(4000)]
    for p in (0.5, 0.03):
        assert complement_quantiles(made(spark, rows), ["a", "b"], 4, p=p, final_limit=limit, accuracy=accuracy) == brute(rows, 4, p)


def test_folds_of_other_ranges_empty_folds_and_columns(spark):
    rows = [(f, 1000.0 * f + i, None if f else float(i)) for f in range(3) for i in range(50 + 10 * f)]
    got = complement_quantiles(made(spark, rows), ["a", "b"], 4)
    assert got == brute(rows, 4, 0.5)
    assert got[0]["b"] is None and got[3]["b"] == 24.0
    assert complement_quantiles(made(spark, rows).where("a < 0"), ["a"], 2) == {0: {"a": None}, 1: {"a": None}}


def test_leak_free_search_uses_them(spark, monkeypatch):
    rnd = random.Random(9)
    rows = []
    for i in range(600):
        x = rnd.gauss(0, 1)
        rows.append((i % 3, None if rnd.random() < 0.2 else x, rnd.choice([None, 1.0, 7.0]), float(rnd.random() < 1 / (1 + math.exp(-2 * x)))))
    df = spark.createDataFrame(rows, "fold int, a double, b double, label double")
    prep = features.feature_pipeline(numeric=["a", "b"])
    grid = {"regParam": [0.0, 0.5]}
    seen = []
    real = tune.complement_quantiles
    monkeypatch.setattr(tune, "complement_quantiles", lambda *a: seen.append(a[1]) or real(*a))
    got = tune.cross_validate_pipeline(prep, LogisticRegression(), grid, df)
    assert seen == [["a", "b"]]
    # each fold by itself
    for i, point in enumerate(tune.param_grid(LogisticRegression(), grid)):
        metrics = []
        for f in range(3):
            model = Pipeline(stages=[prep, LogisticRegression(regParam=grid["regParam"][i])]).fit(df.where(F.col("fold") != f))
            metrics.append(tune.auc_evaluator().evaluate(model.transform(df.where(F.col("fold") == f))))
        assert got.avgMetrics[i] == pytest.approx(sum(metrics) / 3, abs=1e-9)

"""Forests grown over the cluster are Spark's."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import forest_fit, search_log, tree_depths
from tablefit.session import scratch_path


def made(spark, n):
    """Labels that no small tree explains, two numbers (one with zeros), two codes as 0/1 slots between them; some rows come twice."""
    df = spark.range(0, n, 1, 3).select((F.col("id") - F.col("id") % 10 % 2).alias("id")).select("id", (F.col("id") % 3).cast("int").alias("fold"), *[
        ((F.col("id") * k) % m).cast("double").alias(c) for c, k, m in (("a", 37, 1013), ("b", 53, 89), ("c", 17, 7), ("d", 29, 5))])
    value = F.col("a") / 10 - F.col("b") + 20 * F.col("c") + (F.col("id") * 71) % 43
    df = df.withColumn("b", F.greatest(F.col("b") - 30, F.lit(0.0))).withColumn("label", (value > 60).cast("double"))
    pipe = Pipeline(stages=[OneHotEncoder(inputCols=["c", "d"], outputCols=["co", "do"]), VectorAssembler(inputCols=["co", "a", "do", "b"], outputCol="features")])
    return pipe.fit(df).transform(df).select("id", "fold", "features", "label")


@pytest.fixture(scope="module")
def frame(spark):
    return made(spark, 4000).cache()


@pytest.fixture
def spark_fits(monkeypatch):
    """Rows of the frames that Spark's learner got."""
    seen, real = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: seen.append(df.count()) or real(self, df))
    return seen


def told(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("rows_at_node", [10**9, 700, 40])
@pytest.mark.parametrize("params", [{"maxDepth": 12}, {"maxDepth": 9, "minInstancesPerNode": 7, "minInfoGain": 0.002, "maxBins": 16}])
def test_it_grows_the_trees_of_spark(frame, monkeypatch, spark_fits, rows_at_node, params):
    est = RandomForestClassifier(numTrees=2, bootstrap=False, featureSubsetStrategy="all", seed=5, **params)
    want = est.fit(frame)
    spark_fits.clear()
    monkeypatch.setattr(forest_fit, "SPARK_ROWS", 0)
    monkeypatch.setattr(forest_fit, "ROWS_AT_NODE", rows_at_node)
    got = forest_fit.forest_classifier(est).fit(frame)
    assert spark_fits == [2]  # the frame of a saved model
    assert told(got) == told(want) and got.getNumTrees == 2 and got.numClasses == 2 and got.numFeatures == want.numFeatures
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), rel=1e-12)
    a, b = ([r["rawPrediction"].toArray().tolist() for r in m.transform(frame).orderBy("id").select("rawPrediction").collect()] for m in (got, want))
    assert a == b


def test_drawn_forests_are_like_those_of_spark(frame, monkeypatch):
    est = RandomForestClassifier(numTrees=20, maxDepth=8, featureSubsetStrategy="sqrt", seed=5)
    want = est.fit(frame)
    monkeypatch.setattr(forest_fit, "SPARK_ROWS", 0)
    monkeypatch.setattr(forest_fit, "ROWS_AT_NODE", 500)
    got, again, other = (forest_fit.forest_classifier(est.copy({est.seed: s})).fit(frame) for s in (5, 5, 6))
    assert told(got) == told(again) != told(other)
    assert len(set(told(got))) == 20
    score = BinaryClassificationEvaluator()
    assert score.evaluate(got.transform(frame)) == pytest.approx(score.evaluate(want.transform(frame)), abs=0.01)
    assert sum(t.numNodes for t in got.trees) == pytest.approx(sum(t.numNodes for t in want.trees), rel=0.15)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=0.08)
    # each root has a sample with replacement of all rows
    sizes = [t._call_java("rootNode").impurityStats().count() for t in got.trees]
    assert len(set(sizes)) > 5 and np.mean(sizes) == pytest.approx(4000, rel=0.02)


def test_each_node_draws_its_features():
    plan = forest_fit.Plan((0, 5), (1, 2, 3, 4, 6, 7), (np.arange(3.0), np.arange(3.0)), 2, 5, 3, True, 5, 1.0, 0.0)
    some = forest_fit._subset(1, np.arange(1, 4001), plan)
    assert (some.sum(axis=1) == 3).all() and some.mean(axis=0) == pytest.approx(np.full(8, 3 / 8), abs=0.03)
    assert (some == forest_fit._subset(1, np.arange(1, 4001), plan)).all() and (some != forest_fit._subset(0, np.arange(1, 4001), plan)).any()


def test_spark_fits_few_rows_and_what_is_not_handled(frame, monkeypatch, spark_fits):
    est = forest_fit.forest_classifier(RandomForestClassifier(numTrees=2, maxDepth=3, seed=5))
    assert told(est.fit(frame)) == told(RandomForestClassifier(numTrees=2, maxDepth=3, seed=5).fit(frame))
    monkeypatch.setattr(forest_fit, "SPARK_ROWS", 0)
    spark_fits.clear()
    weighted = frame.withColumn("w", F.lit(2.0))
    for params, df in (({est.impurity: "entropy"}, frame), ({est.weightCol: "w"}, weighted), ({est.subsamplingRate: 0.5}, frame), ({est.maxDepth: 0}, frame),
                       ({}, frame.withColumn("label", F.col("label") + F.col("fold")))):
        est.fit(df, params)
    assert spark_fits == [4000] * 5


def test_missing_and_infinite_features_are_refused(spark, frame, monkeypatch):
    monkeypatch.setattr(forest_fit, "SPARK_ROWS", 0)
    est = forest_fit.forest_classifier(RandomForestClassifier(numTrees=2, maxDepth=3, seed=5))
    for bad in ("NaN", "Infinity"):
        df = VectorAssembler(inputCols=["x", "y"], outputCol="features", handleInvalid="keep").transform(
            spark.range(300).select((F.col("id") % 2).cast("double").alias("label"), F.col("id").cast("double").alias("x"),
                                    F.when(F.col("id") == 7, F.lit(float(bad))).otherwise(1.0).alias("y")))
        with pytest.raises(Exception, match="NaN"):
            est.fit(df)


def test_a_search_scores_grown_forests_from_their_folders(spark, frame, monkeypatch, spark_fits):
    monkeypatch.setattr(forest_fit, "SPARK_ROWS", 0)
    monkeypatch.setattr(search_log, "FOREST_ROWS", 100)
    saves, loads, real = [], [], tree_depths.cut_saved
    monkeypatch.setattr(forest_fit.RandomForestClassificationModel, "save", lambda self, path: saves.append(path) or self.write().save(path))
    monkeypatch.setattr(tree_depths, "cut_saved", lambda *a: loads.append(a[1]) or real(*a))
    grid = {"maxDepth": [3, 6], "numTrees": [2, 4]}
    est = forest_fit.forest_classifier(RandomForestClassifier(bootstrap=False, featureSubsetStrategy="all", seed=5))
    got = search_log.search(est, grid, frame, search_log.SearchLog(spark, "grown", scratch_path(spark, "log")), parallelism=8)
    assert got.fitted == 12 and spark_fits == [2] * 3 and len(saves) == 3 and len(loads) == 9
    plain = RandomForestClassifier(bootstrap=False, featureSubsetStrategy="all", seed=5)
    want = search_log.search(plain, grid, frame, search_log.SearchLog(spark, "plain", scratch_path(spark, "log")), parallelism=8)
    assert got.means == pytest.approx(want.means, abs=1e-12) and got.best == want.best
    assert told(got.best_model()) == told(want.best_model())

"""Trees cut from deeper ones are those of a fit of their own."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tablefit.operators import search_log, tree_depths, tune
from tablefit.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(0, 900, 1, 3).select("id", (F.col("id") % 3).cast("int").alias("fold"), *[
        ((F.col("id") * k) % m).cast("double").alias(c) for c, k, m in (("a", 37, 101), ("b", 53, 89), ("c", 17, 2))])
    value = F.col("a") - F.col("b") + 20 * F.col("c") + (F.col("id") * 71) % 43
    df = df.withColumn("value", value.cast("double")).withColumn("label", (value > 20).cast("double"))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.mark.parametrize("learner, params", [
    (DecisionTreeClassifier, {}), (DecisionTreeRegressor, {"labelCol": "value"}), (RandomForestClassifier, {"numTrees": 4, "featureSubsetStrategy": "all", "seed": 5}),
    (RandomForestClassifier, {"numTrees": 4, "featureSubsetStrategy": "sqrt", "seed": 5}), (RandomForestRegressor, {"labelCol": "value", "numTrees": 3, "seed": 5})])
def test_cut_trees_are_fitted_trees(frame, learner, params):
    est = learner(**params)
    deep = est.fit(frame, {est.maxDepth: 8})
    for depth in (0, 3, 8):
        got, want = tree_depths.cut(deep, depth), est.fit(frame, {est.maxDepth: depth})
        assert got.getOrDefault("maxDepth") == depth
        if hasattr(want, "trees"):
            assert [t.numNodes for t in got.trees] == [t.numNodes for t in want.trees] and got.getNumTrees == want.getNumTrees
        else:
            assert (got.numNodes, got.depth) == (want.numNodes, want.depth)
        out = "rawPrediction" if want.getLabelCol() == "label" else "prediction"
        a, b = ({r["id"]: r[out] for r in m.transform(frame).collect()} for m in (got, want))
        values = (lambda v: v.toArray()) if out == "rawPrediction" else (lambda v: v)
        assert all(values(a[i]) == pytest.approx(values(b[i]), rel=1e-12) for i in b)


def test_a_search_over_depths_fits_once_a_fold(spark, frame, monkeypatch):
    fits, real = [], DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, df, params=None: fits.append(params) or real(self, df, params))
    grid = {"maxDepth": [2, 5, 3], "minInstancesPerNode": [1, 30]}
    got = search_log.search(DecisionTreeClassifier(), grid, frame, search_log.SearchLog(spark, "depths", scratch_path(spark, "log")), parallelism=2)
    assert len(fits) == 3 * 2 and got.fitted == 3 * 6
    want = tune.cross_validate(DecisionTreeClassifier(), grid, frame)
    assert got.means == pytest.approx(want.avgMetrics, abs=1e-12)


def test_a_forest_cut_to_its_first_trees(frame):
    est = RandomForestClassifier(numTrees=6, maxDepth=7, featureSubsetStrategy="sqrt", seed=5)
    large = est.fit(frame)
    got = tree_depths.cut(large, 7, 4)
    assert got.getNumTrees == got.getOrDefault("numTrees") == 4
    assert [t.toDebugString.split("\n", 1)[1] for t in got.trees] == [t.toDebugString.split("\n", 1)[1] for t in large.trees[:4]]
    assert [t.numNodes for t in tree_depths.cut(large, 3, 2).trees] == [t.numNodes for t in tree_depths.cut(large, 3).trees][:2]
    with pytest.raises(ValueError):
        tree_depths.cut(large, 7, 8)


def test_a_search_over_forest_sizes_fits_once_a_fold(spark, frame, monkeypatch):
    fits, parts, real = [], [], RandomForestClassifier.fit

    def fit(self, df, params=None):
        fits.append((params[self.maxDepth], params[self.numTrees]))
        parts.append(df.rdd.getNumPartitions())
        return real(self, df, params)

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    grid = {"maxDepth": [2, 6], "numTrees": [1, 3, 5]}
    est = RandomForestClassifier(bootstrap=False, featureSubsetStrategy="all", seed=5)
    log = search_log.SearchLog(spark, "sizes", scratch_path(spark, "log"))
    log.add(0, 5, 0.25)  # the deepest and largest point of a fold is there
    got = search_log.search(est, grid, frame, log, parallelism=8)
    assert sorted(fits) == sorted([(6, 1), (6, 5)] * 3) and set(parts) <= {1, 2} and got.fitted == 3 * 6 - 1
    # a forest of equal trees: each point's metrics are those of a fit of its own
    want = tune.cross_validate(est, {"maxDepth": [2, 6], "numTrees": [1, 3]}, frame)
    at = [i for i, m in enumerate(got.maps) if m[est.numTrees] != 5]
    assert [got.means[i] for i in at] == pytest.approx(want.avgMetrics, abs=1e-12)
    assert got.metrics[5][0] == 0.25


def test_only_independent_trees_are_cut(frame):
    est = GBTRegressor(labelCol="value", maxIter=2)
    maps = tune.param_grid(est, {"maxDepth": [2, 3]})
    assert tree_depths.by_depth(est, maps, [0, 1]) == [[0], [1]]
    logistic = LogisticRegression()
    assert tree_depths.by_depth(logistic, tune.param_grid(logistic, {"regParam": [0.0, 1.0]}), [0, 1]) == [[0], [1]]
    with pytest.raises(TypeError):
        tree_depths.cut(est.fit(frame), 1)

"""Searches that go on where they stopped."""

import json
import time

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import tune
from tablefit.operators.search_log import SearchLog, input_version, search, search_key
from tablefit.session import scratch_path

GRID = {"regParam": [0.0, 0.5, 5.0]}


def made(spark, sign=1):
    df = spark.range(0, 600).select(F.col("id"), (F.col("id") % 3).cast("int").alias("fold"), ((F.col("id") * 37) % 101).cast("double").alias("a"),
                                    ((F.col("id") * 53) % 89).cast("double").alias("b"))
    return df.withColumn("label", (sign * (F.col("a") - F.col("b")) + ((F.col("id") * 17) % 41) - 20 > 0).cast("double"))


def frame(df):
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


class Stop(Exception):
    pass


def test_a_second_run_fits_only_the_rest(spark, monkeypatch):
    df, est = frame(made(spark)), LogisticRegression()
    log = SearchLog(spark, "one", scratch_path(spark, "log"))
    assert log.finished() == {}
    real, added = SearchLog.add, []

    def add(self, fold, point, metric):
        if len(added) == 4:
            raise Stop
        added.append((fold, point))
        real(self, fold, point, metric)

    monkeypatch.setattr(SearchLog, "add", add)
    with pytest.raises(Stop):
        search(est, GRID, df, log)
    monkeypatch.setattr(SearchLog, "add", real)
    assert set(log.finished()) == set(added) and len(added) == 4
    got = search(est, GRID, df, SearchLog(spark, "one", log.path.rsplit("/", 1)[0]), parallelism=3)
    assert got.fitted == 9 - 4
    assert search(est, GRID, df, log).fitted == 0
    want = tune.cross_validate(est, GRID, df)
    assert got.means == pytest.approx(want.avgMetrics, abs=1e-12)
    rows = got.results(spark).collect()
    assert [r["std_metric"] for r in rows] == pytest.approx(want.stdMetrics, abs=1e-9)
    assert [json.loads(r["params"])["regParam"] for r in rows if r["is_best"]] == [float(got.best_params(spark, ["regParam"]).head()["value"])]
    assert got.best_model().coefficients.toArray() == pytest.approx(want.bestModel.coefficients.toArray(), rel=1e-6)


def test_a_rewritten_table_is_searched_anew(spark):
    path, root = scratch_path(spark, "table"), scratch_path(spark, "log")
    est = LogisticRegression()

    def run():
        df = frame(spark.read.parquet(path))
        key = search_key(input_version(spark, [path]), est, GRID, tune.auc_evaluator(), 3)
        return search(est, GRID, df, SearchLog(spark, key, root))

    made(spark).write.parquet(path)
    first = run()
    assert first.fitted == 9 and run().fitted == 0
    before = first.best_model().coefficients[0]
    made(spark, sign=-1).write.mode("overwrite").parquet(path)
    second = run()
    assert second.fitted == 9
    assert before > 0 > second.best_model().coefficients[0]


def test_the_key_follows_estimator_grid_and_folds(spark):
    est, ev = LogisticRegression(), tune.auc_evaluator()
    keys = {search_key([("f", 1, "t")], e, g, ev, k, a) for e, g, k, a in (
        (est, GRID, 3, ""), (LogisticRegression(maxIter=7), GRID, 3, ""), (est, {"regParam": [0.0]}, 3, ""), (est, GRID, 4, ""), (est, GRID, 3, "other"))}
    assert len(keys) == 5 and search_key([("f", 1, "t")], LogisticRegression(), GRID, tune.auc_evaluator(), 3) in keys
    assert search_key([("f", 2, "t")], est, GRID, ev, 3) not in keys


def test_a_failed_search_leaves_nothing_running(spark, monkeypatch):
    log, late = SearchLog(spark, "failed", scratch_path(spark, "log")), []

    def add(self, fold, point, metric):
        if not late:
            late.append("first")
            raise Stop
        time.sleep(1)
        late.append("other")

    monkeypatch.setattr(SearchLog, "add", add)
    with pytest.raises(Stop):
        search(LogisticRegression(), GRID, frame(made(spark)), log, parallelism=3)
    seen = len(late)
    time.sleep(3)
    assert len(late) == seen

"""Ordinary inputs that the oracle data does not contain: null keys, nulls in a
correlation, integers above 2^53, reordered headers, dotted and quoted names."""

import math

import pytest
from pyspark.sql import functions as F

from tablefit import session
from tablefit.operators import evaluate, features, impute, models, profile, quantile, split, tune
from tablefit.sources import read_table, rename_strict


def test_split_keeps_null_keys_and_small_fractions(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 7 > 0 THEN id END AS k")
    for fraction in (0.0, 0.004, 0.5, 0.995, 1.0):
        train, test = split.hash_split(df, "k", fraction)
        assert train.count() + test.count() == 5000
        keyed = train.where("k IS NOT NULL").count() / df.where("k IS NOT NULL").count()
        assert abs(keyed - fraction) < 0.03 and (fraction in (0.0, 1.0) or 0 < keyed < 1)
    assert split.with_split(df, "k").where("k IS NULL").select("split").distinct().count() == 1
    assert split.with_folds(df, "k", 3).where("fold IS NULL").count() == 0
    with pytest.raises(ValueError):
        split.hash_split(df, "k", 1.5)


def test_auc_reports_dropped_rows(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, float("nan")), (None, 0.5)], "label int, score double")
    row = evaluate.auc(df).first()
    assert row["auc"] == 1.0 and row["n_dropped"] == 3
    by = evaluate.auc(df.withColumn("model", F.lit("m")), group_by=["model"]).first()
    assert (by["model"], by["auc"], by["n_dropped"]) == ("m", 1.0, 3)


def test_regression_metrics_use_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (9.0, None), (None, 1.0)], "label double, prediction double")
    row = evaluate.regression_metrics(df).first()
    assert (row["n"], row["n_dropped"]) == (2, 2)
    assert row["r2"] == pytest.approx(1 - 0.125 / 0.25)


def test_correlation_of_complete_pairs(spark):
    rows = [(1.0, 1.1), (2.0, 1.9), (3.0, 3.2), (4.0, None), (None, 90.0), (5.0, 4.8)]
    got = {(r["x"], r["y"]): r["corr"] for r in profile.correlation_long(
        spark.createDataFrame([(a, b, None, 1.0) for a, b in rows], "a double, `b.c` double, n double, k double"),
        ["a", "b.c", "n", "k"], via="agg").collect()}
    pairs = [(a, b) for a, b in rows if a is not None and b is not None]
    ma, mb = (sum(v) / len(v) for v in zip(*pairs))
    want = sum((a - ma) * (b - mb) for a, b in pairs) / math.sqrt(sum((a - ma) ** 2 for a, _ in pairs) * sum((b - mb) ** 2 for _, b in pairs))
    assert got["a", "b.c"] == got["b.c", "a"] == pytest.approx(want)
    assert got["a", "a"] == 1.0 and math.isnan(got["n", "n"]) and math.isnan(got["a", "k"])


def test_imputer_leaves_large_integers_alone(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big,), (big + 2,), (None,)], "v long")
    model = impute.MissingValueImputer(inputCols=["v"], outputCols=["v"], strategy="median").fit(df)
    assert {r["v"] for r in model.transform(df).collect()} >= {big, big + 2}
    assert model.transform(df).schema["v"].dataType.simpleString() == "bigint"


def test_quantiles_by_all_rounds(spark):
    values = [(i * 37 % 1000) / 7 for i in range(1000)] + [5.0] * 600
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "a double, b double").repartition(5)
    for p in (0.0, 0.1, 0.5, 0.77, 1.0):
        k = max(1, math.ceil(p * len(values)))
        want = {"a": sorted(values)[k - 1], "b": float(k - 1)}
        assert quantile.exact_quantiles(df, ["a", "b"], p, accuracy=50, final_limit=40) == want
        assert quantile.exact_quantiles(df, ["a", "b"], p) == want


def test_csv_columns_go_by_header_name(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    with open(path, "w") as f:
        f.write("b,a\n1,2\n3,4\n")
    got = read_table(spark, path, fmt="csv", schema="a int, b int")
    assert [tuple(r) for r in got.orderBy("a").collect()] == [(2, 1), (4, 3)] and got.columns == ["a", "b"]
    with open(path, "a") as f:
        f.write("foo,5\n")
    with pytest.raises(Exception, match="foo"):
        read_table(spark, path, fmt="csv", schema="a int, b int").collect()
    with pytest.raises(KeyError):
        read_table(spark, path, fmt="csv", schema="a int, c int")


def test_rename_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "pay_0 int, pay_1 int")
    with pytest.raises(ValueError):
        rename_strict(df, {"pay_0": "pay_1"})
    assert rename_strict(df, {"pay_0": "pay_1", "pay_1": "pay_2"}).columns == ["pay_1", "pay_2"]


def test_profiles_take_any_column_name_and_strings(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "2.5")], "`default.payment.next.month` double, `it's` string")
    cols = df.columns
    assert {tuple(r) for r in profile.missing(df).collect()} == {(cols[0], 1, 0), (cols[1], 0, 0)}
    assert {tuple(r) for r in profile.distinct_counts(df, cols).collect()} == {(cols[0], 1), (cols[1], 2)}
    got = {r["column_name"]: tuple(r)[1:] for r in profile.summary(df, cols).collect()}
    assert got[cols[0]] == (1, 1.0, None, 1.0, 1.0) and got[cols[1]] == (2, 2.5, None, 2.5, 2.5)


def test_fit_features_needs_training_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    with pytest.raises(ValueError):
        features.fit_features(features.numeric_stage(["v"]), df)


def test_callers_cache_stays(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double").cache()
    with models.persisted(df):
        pass
    features.fit_features(features.numeric_stage(["v"]), df, fit_on="all")
    assert df.storageLevel.useMemory
    df.unpersist()


def test_best_point_is_the_first_of_a_tie():
    assert tune.best_point([0.5, 0.7 + 1e-13, 0.7, 0.7 + 2e-13], True) == 1
    assert tune.best_point([float("nan"), 3.0, 2.0 + 1e-13, 2.0], False) == 2
    assert tune.best_point([float("nan"), 1.0], True) == 1


def test_leaderboard_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5 + 1e-13), ("c", 0.9)], "model string, m double")
    assert [(r["model"], r["rank"]) for r in evaluate.leaderboard([df], "m").collect()] == [("c", 1), ("a", 2), ("b", 3)]


def test_no_local_scratch_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())

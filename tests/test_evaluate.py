import itertools
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tablefit.operators import evaluate

# The three published confusion matrices (TN FP / FN TP) and
# their published balanced accuracy ("AUC" on hard labels), accuracy, F1.
PUBLISHED = {
    "logistic_regression": ((4518, 187, 908, 370), 0.6248849574005612, 0.8169814474343975, 0.40326975476839244),
    "decision_tree": ((4410, 295, 804, 474), 0.6540963813344111, 0.8163128865117834, 0.4631167562286273),
    "random_forest": ((4448, 257, 817, 461), 0.6530485665201505, 0.8204913922781213, 0.4619238476953907),
}


def _weighted_rows(tn, fp, fn, tp):
    cells = {(0.0, 0.0): tn, (0.0, 1.0): fp, (1.0, 0.0): fn, (1.0, 1.0): tp}
    return [(y, p) for (y, p), n in cells.items() for _ in range(n)]


@pytest.mark.parametrize("name", list(PUBLISHED))
def test_published_metrics(spark, name):
    (tn, fp, fn, tp), bal, acc, f1 = PUBLISHED[name]
    df = spark.createDataFrame(_weighted_rows(tn, fp, fn, tp), "label double, prediction double")
    r = evaluate.binary_metrics(df).head()
    assert (r.tn, r.fp, r.fn, r.tp, r.n) == (tn, fp, fn, tp, 5983)
    assert abs(r.balanced_accuracy - bal) < 1e-15
    assert abs(r.accuracy - acc) < 1e-15
    assert abs(r.f1 - f1) < 1e-15
    # the swept AUC of hard 0/1 predictions is the balanced accuracy
    swept = evaluate.auc(df, score="prediction").head().auc
    assert abs(swept - bal) < 1e-12
    conf = {(c.label, c.prediction): c["count"] for c in evaluate.confusion(df).collect()}
    assert conf == {(0.0, 0.0): tn, (0.0, 1.0): fp, (1.0, 0.0): fn, (1.0, 1.0): tp}


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_matches_brute_force_and_spark(spark):
    rng = random.Random(3)
    rows = [(float(rng.randint(0, 40)) if i % 2 else rng.random(), int(rng.random() < 0.4)) for i in range(1500)]
    df = spark.createDataFrame(rows, "score double, label int").repartition(5)
    got = evaluate.auc(df, buckets=16, accuracy=100).head().auc
    assert abs(got - _brute_auc(rows)) < 1e-12
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert abs(got - spark_auc) < 1e-12


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "label double, prediction double")
    r = evaluate.regression_metrics(df).head()
    assert abs(r.mse - 5.0 / 3) < 1e-12 and abs(r.mae - 1.0) < 1e-12
    assert abs(r.r2 - (1 - (5.0 / 3) / (2.0 / 3))) < 1e-12


@pytest.mark.parametrize("rows_per_bucket", [5, 50, 10_000])
def test_auc_adaptive_ranges(spark, rows_per_bucket):
    rng = random.Random(11)
    rows = [(round(rng.random(), 3), int(rng.random() < 0.3)) for _ in range(1200)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = evaluate.auc(df, rows_per_bucket=rows_per_bucket).head().auc
    assert abs(got - _brute_auc(rows)) < 1e-12


def test_auc_grouped(spark):
    rows = [("a", 0.1, 0), ("a", 0.9, 1), ("a", 0.5, 0), ("b", 0.2, 1), ("b", 0.8, 0), ("b", 0.8, 1)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    got = {r.model: r.auc for r in evaluate.auc(df, group_by=["model"]).collect()}
    assert got["a"] == 1.0 and got["b"] == pytest.approx(_brute_auc([(0.2, 1), (0.8, 0), (0.8, 1)]))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 12).map(lambda v: v / 4.0), st.integers(0, 1)),
                     min_size=2, max_size=80).filter(lambda r: len({y for _, y in r}) == 2),
       rows_per_bucket=st.sampled_from([1, 3, 1000]))
def test_auc_property(spark, rows, rows_per_bucket):
    df = spark.createDataFrame(rows, "score double, label int")
    got = evaluate.auc(df, rows_per_bucket=rows_per_bucket).head().auc
    assert abs(got - _brute_auc(rows)) < 1e-12

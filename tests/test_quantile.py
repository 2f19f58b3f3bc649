import math
import random

import pytest

from tablefit.operators.quantile import approx_quantiles, exact_quantiles


def brute(values, p):
    vals = sorted(v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v)))
    if not vals:
        return None
    return vals[max(1, math.ceil(p * len(vals))) - 1]


def test_median_even_fixture(spark):
    # x = 1, 2, 3, 4, NaN, null -> lower middle 2
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (float("nan"),), (None,)], "x double")
    assert exact_quantiles(df, ["x"])["x"] == 2.0


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_refinement_rounds_match_brute_force(spark, p):
    rng = random.Random(7)
    # heavy duplicates + a long tail, forced through sketch/verify/refine rounds
    xs = [float(rng.choice([5, 5, 5, 7])) if i % 3 == 0 else rng.lognormvariate(0, 3) for i in range(20000)]
    ys = [float(i % 97) for i in range(20000)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double").repartition(7)
    got = exact_quantiles(df, ["x", "y"], p, accuracy=50, final_limit=300)
    assert got["x"] == brute(xs, p)
    assert got["y"] == brute(ys, p)


def test_hot_value_collapses_bracket(spark):
    xs = [3.0] * 12000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert exact_quantiles(df, ["x"], 0.5, accuracy=100, final_limit=100)["x"] == brute(xs, 0.5)


def test_integer_column_and_empty(spark):
    df = spark.createDataFrame([(i, None) for i in [9, 1, 4, 4, 2]], "k int, e double")
    got = exact_quantiles(df, ["k", "e"])
    assert got == {"k": 4.0, "e": None}


def test_approx_close(spark):
    df = spark.range(0, 10001).selectExpr("cast(id as double) as x")
    assert abs(approx_quantiles(df, ["x"], 0.5, 0.001)["x"] - 5000) <= 20

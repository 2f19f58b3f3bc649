"""Dictionaries of many labels, and correlations of many columns."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tablefit.operators.label_index import label_dictionary, with_index, with_label
from tablefit.operators.wide_correlation import correlation_wide


def labels(spark, n=4000, kinds=300):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["hot", f"k{int(rnd.expovariate(0.02)) % kinds}", f"Ä{rnd.randint(0, 40)}", ""])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, s string").repartition(5)


def test_dictionary_equals_string_indexer(spark):
    df = labels(spark)
    want = StringIndexer(inputCol="s", outputCol="i").fit(df).labels
    got = label_dictionary(df.union(spark.createDataFrame([(9, None)], df.schema)), "s").orderBy("idx").collect()
    assert [r["label"] for r in got] == want and [r["idx"] for r in got] == list(range(len(want)))
    assert sum(r["n"] for r in got) == 4000
    assert label_dictionary(df.where("id < 0"), "s").collect() == []


@pytest.mark.parametrize("hot", [1000, 3, 0])
def test_index_and_back(spark, hot):
    df = labels(spark)
    dictionary = label_dictionary(df, "s")
    want = StringIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    got = with_index(df, "s", dictionary, "i", hot=hot)
    assert got.columns == ["id", "s", "i"]
    assert sorted(map(tuple, got.collect())) == sorted((r["id"], r["s"], int(r["i"])) for r in want.collect())
    back = with_label(got.drop("s"), "i", dictionary, "s", hot=hot).select("id", "s")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("hot", [1000, 1])
def test_labels_without_an_index(spark, hot):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, s string")
    dictionary = label_dictionary(df, "s")
    more = df.union(spark.createDataFrame([(4, "new"), (5, None)], df.schema))
    assert {r["id"]: r["i"] for r in with_index(more, "s", dictionary, "i", "keep", hot).collect()} == {1: 0, 2: 0, 3: 1, 4: 2, 5: 2}
    assert {r["id"]: r["i"] for r in with_index(more, "s", dictionary, "i", "skip", hot).collect()} == {1: 0, 2: 0, 3: 1}
    for bad in ("s = 'new'", "s is null"):
        with pytest.raises(Exception, match="without an index"):
            with_index(more.where(f"id = 1 or {bad}"), "s", dictionary, "i", hot=hot).collect()
    with pytest.raises(ValueError):
        with_index(df, "s", dictionary, "i", "other")
    assert [r["s"] for r in with_label(spark.createDataFrame([(7,), (None,)], "i long"), "i", dictionary, "s", hot).collect()] == [None, None]


def test_hot_labels_are_not_shuffled(spark):
    df = labels(spark)
    dictionary = label_dictionary(df, "s")
    dictionary = spark.createDataFrame(dictionary.collect(), dictionary.schema)
    plan = with_index(df, "s", dictionary, "i")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def frame(spark, n, d, seed=1, holes=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e6, 1, (n, 3)) @ rng.normal(0, 1, (3, d)) + rng.normal(0, 1, (n, d))
    x[rng.random((n, d)) < holes] = np.nan
    return x, spark.createDataFrame([[None if math.isnan(v) and k % 2 else float(v) for k, v in enumerate(r)] for r in x],
                                    ", ".join(f"`c.{i}` double" for i in range(d))).repartition(4)


@pytest.mark.parametrize("block", [2, 5, 256])
def test_correlation_over_rows_with_both(spark, block):
    x, df = frame(spark, 200, 5)
    df = df.withColumn("flat", F.lit(3.5)).withColumn("none", F.lit(None).cast("double"))
    got = {(r["x"], r["y"]): (r["corr"], r["n"]) for r in correlation_wide(df, df.columns, block).collect()}
    assert len(got) == 7 * 8 // 2
    for i in range(5):
        for j in range(i, 5):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            corr, n = got[f"c.{i}", f"c.{j}"]
            assert n == both.sum() and corr == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert got["c.0", "flat"][0] is None and got["flat", "flat"][0] is None and got["c.1", "none"] == (None, 0)


def test_more_than_a_thousand_columns(spark):
    n, d = 60, 1030
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (n, d))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").select(*[F.get("v", F.lit(i)).alias(f"c{i}") for i in range(d)]).coalesce(2)
    got = correlation_wide(df, df.columns, block=350).where("x IN ('c0', 'c599', 'c600') AND y IN ('c600', 'c1029', 'c1')").collect()
    want = np.corrcoef(x.T)
    assert {(r["x"], r["y"]) for r in got} == {("c0", "c600"), ("c0", "c1029"), ("c0", "c1"), ("c599", "c600"), ("c599", "c1029"), ("c600", "c600"), ("c600", "c1029")}
    for r in got:
        assert r["corr"] == pytest.approx(want[int(r["x"][1:]), int(r["y"][1:])], abs=1e-9)

import math

import pytest
from pyspark.sql import functions as F

from tablefit.operators import derive, profile, split
from tablefit.sources import column_roles, numeric_columns, rename_strict, schema_frame


def test_rename_strict_absent_column_raises(spark):
    df = spark.createDataFrame([(1, 0)], "ID int, DEFAULT int")
    assert rename_strict(df, {"label": ["DEFAULT", "default.payment.next.month"]}).columns == ["ID", "label"]
    with pytest.raises(KeyError):
        rename_strict(df, {"PAY_0": "PAY_1"})
    assert rename_strict(df, {"PAY_0": "PAY_1"}, missing_ok=True).columns == ["ID", "DEFAULT"]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 0)], "id int, x double, s string, label int")
    assert numeric_columns(df.schema, exclude=["id", "label"]) == ["x"]
    roles = column_roles(df, "label", categorical=["s"], ids=["id"])
    assert roles["numeric"] == ["x"] and roles["other"] == []
    assert [r.column for r in schema_frame(spark, df).orderBy("position").collect()] == ["id", "x", "s", "label"]


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    out = [r.r for r in derive.ratios(df, {"r": ("a", "b")}).collect()]
    assert out == [None, None, 2.0]


def test_recodes_keep_null(spark):
    df = spark.createDataFrame([(5, 0, -2), (3, 1, None), (None, None, 4)], "edu int, mar int, pay int")
    df = derive.recode_above_threshold(df, "edu", 3, 0)
    df = derive.recode_values(df, "mar", {0: 3})
    df = derive.clamp_columns(df, ["pay"], 0)
    assert [tuple(r) for r in df.collect()] == [(0, 3, 0), (3, 1, None), (None, None, 4)]


def test_age_class_bounds(spark):
    df = spark.createDataFrame([(a,) for a in (18, 20, 24, 25, 44, 45, 55, 70)], "age int")
    assert [r.age_class for r in derive.age_class(df).collect()] == [None, 0, 0, 1, 2, 3, 4, 4]


def test_relative_change_direction_and_sentinel(spark):
    df = spark.createDataFrame([(100, 150, 0, 10)], "b1 int, b2 int, b3 int, b4 int")
    r = derive.relative_change(df, ["b1", "b2", "b3", "b4"], "d").head()
    assert (r.d1, r.d2, r.d3) == (0.5, -1.0, -2.0)
    r = derive.relative_change(df, ["b1", "b2", "b3", "b4"], "d", newest_first=False).head()
    assert (r.d1, r.d2, r.d3) == (pytest.approx(-1 / 3), -2.0, -1.0)


def test_row_mean_null(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "a int, b int, c int")
    assert [r.m for r in derive.row_mean(df, ["a", "b", "c"], "m").collect()] == [2.0, None]


def test_hash_split_independent_of_partitioning(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = split.with_split(df, "k").where("split = 'train'").select("k")
    b = split.with_split(df.repartition(7), "k").where("split = 'train'").select("k")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert 3800 < a.count() < 4200
    folds = split.with_folds(df, "k", 4)
    assert {r.fold for r in folds.select("fold").distinct().collect()} == {0, 1, 2, 3}


def test_missing_counts_nan_separately(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r.column_name: (r.n_null, r.n_nan) for r in profile.missing(df).collect()}
    assert got == {"x": (1, 1), "s": (1, 0)}


def test_summary_numbers_and_constant(spark):
    df = spark.createDataFrame([(5, 1.0), (5, 2.0), (5, 3.0)], "k int, x double")
    got = {r.column_name: r for r in profile.summary(df, ["k", "x"]).collect()}
    assert got["k"].stddev == 0.0 and got["k"].mean == 5.0
    assert got["x"].stddev == 1.0 and got["x"]["count"] == 3


def test_correlation_routes_agree_and_constant_nan(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7), 5.0) for i in range(50)], "a double, b double, k double")
    m = {(r.x, r.y): r.corr for r in profile.correlation_long(df, ["a", "b", "k"], via="matrix").collect()}
    g = {(r.x, r.y): r.corr for r in profile.correlation_long(df, ["a", "b", "k"], via="agg").collect()}
    assert m[("a", "b")] == pytest.approx(g[("a", "b")], abs=1e-12)
    assert m[("k", "k")] == 1.0 and g[("k", "k")] == 1.0
    assert math.isnan(m[("a", "k")]) and math.isnan(g[("a", "k")])


def test_group_mean_sql_equals_dataframe(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0)], "k string, v double")
    a = profile.group_mean(df, "k", "v", "m")
    b = profile.group_mean_sql(spark, df, "k", "v", "m")
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_contingency_one_job_shape(spark):
    df = spark.createDataFrame([(0, 1, 2), (1, 1, 3), (0, 2, 2)], "label int, sex int, mar int")
    got = {(r.label, r.attribute, r.value): r["count"] for r in profile.contingency(df, "label", ["sex", "mar"]).collect()}
    assert got == {(0, "sex", 1): 1, (0, "sex", 2): 1, (1, "sex", 1): 1, (0, "mar", 2): 2, (1, "mar", 3): 1}


def test_filtered_counts_one_pass(spark):
    df = spark.range(10)
    r = profile.filtered_counts(df, {"big": "id > 6", "even": F.col("id") % 2 == 0}).head()
    assert (r.n_total, r.big, r.even) == (10, 3, 5)

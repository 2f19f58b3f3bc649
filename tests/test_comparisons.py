"""DeLong's test, run tables, exact stratified splits, mergeable distinct counts."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tablefit.operators.compare import compare_auc
from tablefit.operators.distinct_state import distinct_states, error_bound, load_states, merged_distinct, save_states
from tablefit.operators.run_table import Runs, leaderboard_with_speed, speeds
from tablefit.operators.stratified import stratified_split
from tablefit.session import scratch_path


def brute_delong(rows):
    rows = [r for r in rows if None not in r and not any(math.isnan(x) for x in r)]
    pos, neg = [r[1:] for r in rows if r[0] == 1], [r[1:] for r in rows if r[0] == 0]
    at = [np.array([[np.mean([(p[m] > n[m]) + 0.5 * (p[m] == n[m]) for n in neg]) for p in pos]]).ravel() for m in (0, 1)]
    of = [np.array([np.mean([(p[m] > n[m]) + 0.5 * (p[m] == n[m]) for p in pos]) for n in neg]) for m in (0, 1)]

    def error(a, b):
        return math.sqrt(a.var(ddof=1) / len(a) + b.var(ddof=1) / len(b))

    return {"n_pos": len(pos), "n_neg": len(neg), "auc_a": at[0].mean(), "auc_b": at[1].mean(), "se_a": error(at[0], of[0]), "se_b": error(at[1], of[1]),
            "difference": at[0].mean() - at[1].mean(), "se": error(at[0] - at[1], of[0] - of[1])}


@pytest.mark.parametrize("rows_per_bucket", [2_000_000, 2])
def test_delong_against_brute_force(spark, rows_per_bucket):
    rnd = random.Random(1)
    rows = []
    for _ in range(150):
        y = float(rnd.random() < 0.4)
        rows.append((y, float(round(rnd.gauss(y, 1), 1)), float(rnd.randint(0, 4) + y)))
    rows += [(None, 1.0, 1.0), (1.0, None, 1.0), (0.0, 1.0, float("nan"))]
    got = compare_auc(spark.createDataFrame(rows, "label double, p double, q double").repartition(4), "p", "q", rows_per_bucket=rows_per_bucket).head().asDict()
    want = brute_delong(rows)
    assert got["n_dropped"] == 3
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-9), k
    assert got["low"] < got["difference"] < got["high"] and got["z"] == pytest.approx(want["difference"] / want["se"])


def test_delong_of_equal_models_and_of_one_class(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.5), (1.0, 0.2), (0.0, 0.1)], "label double, s double")
    same = compare_auc(df, "s", "s").head()
    assert same["difference"] == 0 and same["se"] == 0 and same["z"] is None
    assert compare_auc(df.where("label = 1"), "s", "s").head()["auc_a"] is None
    none = compare_auc(df.where("label = 7"), "s", "s").head()
    assert none["n_pos"] == none["n_neg"] == none["n_dropped"] == 0


def test_stratified_split_is_exact(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", "a", "a", "b", None]), 1.0) for i in range(3000)] + [(9000 + i, f"rare{i}", 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, label string, x double")
    for fraction in (0.8, 0.5, 0.0, 1.0):
        got = stratified_split(df, "id", "label", fraction)
        counts = {(r["label"], r["split"]): r["count"] for r in got.groupBy("label", "split").count().collect()}
        for label in {r[1] for r in rows}:
            n = sum(r[1] == label for r in rows)
            assert counts.get((label, "train"), 0) == math.floor(fraction * n + 0.5), (label, fraction)
        assert got.count() == len(rows) and got.columns == ["id", "label", "x", "split"]
    again = {r["id"] for r in stratified_split(df.repartition(7), "id", "label").where("split = 'train'").collect()}
    assert again == {r["id"] for r in stratified_split(df, "id", "label").where("split = 'train'").collect()}


def test_stratified_split_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a", float(i)) for i in range(30)] + [(None, "a", 1.0)] * 11, "id long, label string, x double")
    got = stratified_split(df, "id", "label", 0.5).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 21, "test": 20}
    assert stratified_split(df.where("x < 0"), "id", "label").count() == 0


def test_distinct_states_merge_and_touch_one_part(spark):
    path = scratch_path(spark, "states")
    local = path.removeprefix("file:")
    df = spark.range(0, 30_000).select("id", (F.col("id") % 3).alias("day"), F.concat(F.lit("u"), F.col("id") % 700).alias("user"), (F.col("id") / 7).alias("x"),
                                       F.lit(None).cast("int").alias("none"))
    cols = ["id", "user", "x", "none"]
    save_states(distinct_states(df.where("day < 2"), "day", cols), path)
    before = {f: os.stat(f"{local}/part=0/{f}").st_mtime_ns for f in os.listdir(f"{local}/part=0")}
    save_states(distinct_states(df.where("day = 2"), "day", cols), path)
    save_states(distinct_states(df.where("day = 1"), "day", cols), path)  # again: takes the place of what was there
    assert before == {f: os.stat(f"{local}/part=0/{f}").st_mtime_ns for f in os.listdir(f"{local}/part=0")}
    got = {r["column_name"]: r["n_distinct"] for r in merged_distinct(load_states(spark, path)).collect()}
    for c, n in (("id", 30_000), ("user", 700), ("x", 30_000), ("none", 0)):
        assert abs(got[c] - n) <= error_bound() * n
    assert load_states(spark, path).count() == 12


def test_runs_are_measured_and_break_ties(spark):
    df = spark.createDataFrame([([float(i % 5)], float(i % 2)) for i in range(60)], "f array<double>, label double")
    from pyspark.ml.functions import array_to_vector

    df = df.select(array_to_vector("f").alias("features"), "label")
    runs = Runs(spark, "one")
    path = scratch_path(spark, "runs")
    fitted = runs.fit("lr", LogisticRegression(), df)
    runs.score("lr", fitted, df.limit(10))
    table = runs.write(path)
    assert sorted((r["model"], r["step"], r["n_rows"], r["seconds"] > 0) for r in table.collect()) == [("lr", "fit", 60, True), ("lr", "score", 10, True)]
    runs.rows = [("two", "lr", "fit", 60, 1e9), ("two", "fast", "fit", 60, 0.001)]
    table = runs.write(path)
    assert table.count() == 4 and speeds(table).count() == 2
    board = spark.createDataFrame([("lr", 0.9), ("fast", 0.9 + 1e-13), ("best", 0.95)], "model string, auc double")
    assert [r["model"] for r in leaderboard_with_speed(board, table, "auc").collect()] == ["best", "fast", "lr"]

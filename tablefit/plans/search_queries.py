"""Catalogue: searches from sums over all folds, medians of fold complements, dictionaries of many labels, wide correlations,
paired model comparison, run tables, exact splits, mergeable distinct counts."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import models, profile, split
from tablefit.operators.compare import compare_auc
from tablefit.operators.distinct_state import distinct_states, error_bound, load_states, merged_distinct, save_states
from tablefit.operators.fold_quantile import complement_quantiles
from tablefit.operators.gram import search_linear
from tablefit.operators.label_index import label_dictionary, with_index, with_label
from tablefit.operators.logistic_grid import search_logistic
from tablefit.operators.run_table import Runs
from tablefit.operators.stratified import stratified_split
from tablefit.operators.wide_correlation import correlation_wide
from tablefit.plans.feature_queries import IMPUTE_COLS
from tablefit.plans.oracle import hx
from tablefit.plans.profile_queries import prepared_clients
from tablefit.plans.registry import query
from tablefit.session import cut_lineage, scratch_path
from tablefit.sources import blocks
from tablefit.sources.tables import load

FOLDS = 4


def _fold(key: str, k: int = FOLDS) -> str:
    return f"CAST({hx('fold', key)} % {k} AS INTEGER)"


# -------------------------------------------- logistic regression, all models together (T2, M7)

EDUCATION = (0, 1, 2, 3)

_RATES = (
    f"WITH t AS (SELECT education, label, {_fold('id')} AS fold FROM clients_prep), f AS (SELECT DISTINCT fold FROM t), "
    "r AS (SELECT f.fold, education, avg(label) AS p FROM f JOIN t ON t.fold <> f.fold GROUP BY ALL), "
    "g AS (SELECT t.fold, p, sum(label) AS pos, count(*) - sum(label) AS neg FROM t JOIN r USING (fold, education) GROUP BY ALL), "
    "b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g), "
    "a AS (SELECT fold, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM b GROUP BY fold) "
)


@query("grid_logistic_factor", "T1,T2,T3,T6,M7",
       _RATES + "SELECT fold, education, round(p, 6) AS probability, round(auc, 9) AS auc FROM r JOIN a USING (fold)")
def q_grid_logistic_factor(spark, base):
    """All folds of an unregularised one-factor model at once: the rates of each fold's training rows, and the area on its own rows."""
    df = split.with_folds(prepared_clients(spark, base), "id", FOLDS)
    x = F.array(*[(F.col("education") == k).cast("double") for k in EDUCATION[:-1]])
    found, fits = search_logistic(df.select("fold", "label", x.alias("features")), {"regParam": [0.0]}, FOLDS)
    rows = []
    for fold in range(FOLDS):
        for i, k in enumerate(EDUCATION):
            fit = fits[fold][0]
            margin = fit.intercept + (fit.coefficients[i] if i < len(fit.coefficients) else 0.0)
            rows.append((fold, k, float(1 / (1 + np.exp(-margin))), float(found.metrics[0, fold])))
    out = spark.createDataFrame(rows, "fold int, education int, probability double, auc double")
    return profile.with_rounded(out, {"probability": 6, "auc": 9})


@query("grid_logistic", "T1,T2,T3,T4,T6,M7")
def q_grid_logistic(spark, base):
    """The surveyed 3 x 3 grid over 4 folds: one scan a step for all 45 models, fitted until they settle."""
    from tablefit.plans.model_queries import client_frames

    train, _ = client_frames(spark, base)
    name = "logistic_regression"
    found, _ = search_logistic(split.with_folds(train, "id", models.FOLDS[name]), models.GRIDS[name], models.FOLDS[name])
    return found.results(spark)


# ---------------------------------------------------- linear regression from sums by fold (M1, T2)

RIDGE = (0.0, 0.5, 50.0)
_PRIORITY = "CAST(substr(priority, 1, 1) AS DOUBLE)"

_GRAM_SQL = (
    f"WITH t AS (SELECT total_value AS y, balance AS u, {_PRIORITY} AS v, {_fold('block_id')} AS fold FROM blocks), f AS (SELECT DISTINCT fold FROM t), "
    "m AS (SELECT f.fold, avg(u) AS mu, avg(v) AS mv, avg(y) AS my, var_pop(u) AS uu, var_pop(v) AS vv, var_pop(y) AS yy, covar_pop(u, v) AS uv, "
    "covar_pop(u, y) AS uy, covar_pop(v, y) AS vy FROM f JOIN t ON t.fold <> f.fold GROUP BY f.fold), "
    "p(point, reg) AS (VALUES " + ", ".join(f"({i}, {r}::DOUBLE)" for i, r in enumerate(RIDGE)) + "), "
    "h AS (SELECT *, uu * (1 + reg / sqrt(yy)) AS a, vv * (1 + reg / sqrt(yy)) AS d FROM m, p), "
    "w AS (SELECT *, (d * uy - uv * vy) / (a * d - uv * uv) AS wu, (a * vy - uv * uy) / (a * d - uv * uv) AS wv FROM h), "
    "e AS (SELECT point, w.fold, sqrt(avg(power(y - my - wu * (u - mu) - wv * (v - mv), 2))) AS rmse FROM w JOIN t ON t.fold = w.fold GROUP BY ALL) "
)


@query("gram_cv", "M1,T1,T2,T3,T6,E1", _GRAM_SQL + "SELECT point::INTEGER AS point, fold, round(rmse, 5) AS metric FROM e")
def q_gram_cv(spark, base):
    """Ridge regression on two predictors, three penalties, four folds: every fit and metric from one pass of sums."""
    df = split.with_folds(blocks(spark, base), "block_id", FOLDS)
    x = F.array(F.col("balance").cast("double"), F.substring("priority", 1, 1).cast("double"))
    found = search_linear(df.select("fold", F.col("total_value").alias("label"), x.alias("features")), {"regParam": list(RIDGE)}, FOLDS)
    return profile.with_rounded(found.by_fold(spark), {"metric": 5})


# ------------------------------------------------------------ medians of fold complements (F2, T2)

@query("fold_medians", "F2,T2,D2",
       f"WITH t AS (SELECT *, {_fold('block_id')} AS fold FROM blocks), f AS (SELECT DISTINCT fold FROM t), "
       "u AS (SELECT f.fold, " + ", ".join(f"quantile_disc({c}, 0.5)::DOUBLE AS {c}" for c in IMPUTE_COLS) + " FROM f JOIN t ON t.fold <> f.fold GROUP BY f.fold) "
       "SELECT fold, column_name, round(median, 6) AS median FROM (UNPIVOT u ON " + ", ".join(IMPUTE_COLS) + " INTO NAME column_name VALUE median)")
def q_fold_medians(spark, base):
    df = cut_lineage(split.with_folds(blocks(spark, base), "block_id", FOLDS).select("fold", *IMPUTE_COLS))
    found = complement_quantiles(df, IMPUTE_COLS, FOLDS)
    rows = [(f, c, m) for f, medians in found.items() for c, m in medians.items()]
    return profile.with_rounded(spark.createDataFrame(rows, "fold int, column_name string, median double"), {"median": 6})


# -------------------------------------------------------------- dictionaries of many labels (F4, F5)

_DICTIONARY = ("WITH n AS (SELECT l_orderkey::VARCHAR AS label, count(*) AS n FROM lineitem GROUP BY ALL), "
               "i AS (SELECT label, n, row_number() OVER (ORDER BY n DESC, label) - 1 AS idx FROM n) ")


@query("label_dictionary", "F4", _DICTIONARY + "SELECT label, n, idx FROM i")
def q_label_dictionary(spark, base):
    return label_dictionary(load(spark, base, "lineitem"), "l_orderkey")


@query("index_many_labels", "F4,F5",
       _DICTIONARY + "SELECT l_orderkey, l_linenumber, idx, label AS back FROM lineitem JOIN i ON label = l_orderkey::VARCHAR")
def q_index_many_labels(spark, base):
    """Index and label again, of every line item by its order."""
    df = load(spark, base, "lineitem").select("l_orderkey", "l_linenumber")
    dictionary = cut_lineage(label_dictionary(df, "l_orderkey"))
    return with_label(with_index(df, "l_orderkey", dictionary, "idx"), "idx", dictionary, "back")


# ---------------------------------------------------------------- correlations by column blocks (A11)

WIDE_COLS = ["total_value", "balance", "total_qty", "lines", "ext_price", "qty_per_line", "price_per_qty", "value_per_line"]


@query("correlation_wide", "A11,S8",
       "SELECT x, y, round(corr, 9) AS corr, n FROM (" + " UNION ALL ".join(
           f"SELECT '{a}' AS x, '{b}' AS y, " + ("1.0" if a == b else f"corr({a}, {b})") + f" AS corr, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM blocks"
           for i, a in enumerate(WIDE_COLS) for b in WIDE_COLS[i:]) + ")")
def q_correlation_wide(spark, base):
    df = cut_lineage(blocks(spark, base).select(*WIDE_COLS))
    return profile.with_rounded(correlation_wide(df, WIDE_COLS, block=3), {"corr": 9})


# ------------------------------------------------------------------- paired comparison of models (E2, E8)

def _placements_sql(s: str) -> str:
    return (f"g{s} AS (SELECT {s} AS s, sum(label) AS pos, count(*) - sum(label) AS neg FROM t GROUP BY {s}), "
            f"p{s} AS (SELECT s, (sum(neg) OVER (ORDER BY s) - neg / 2) / (SELECT sum(neg) FROM g{s}) AS of_pos, "
            f"((SELECT sum(pos) FROM g{s}) - sum(pos) OVER (ORDER BY s) + pos / 2) / (SELECT sum(pos) FROM g{s}) AS of_neg FROM g{s}), ")


@query("auc_comparison", "E2,E8",
       "WITH t AS (SELECT pay_1::DOUBLE AS a, (pay_2 + pay_1 / 2.0)::DOUBLE AS b, label FROM clients_prep), " + _placements_sql("a") + _placements_sql("b")
       + "v AS (SELECT label, CASE WHEN label = 1 THEN pa.of_pos ELSE pa.of_neg END AS va, CASE WHEN label = 1 THEN pb.of_pos ELSE pb.of_neg END AS vb "
       "FROM t JOIN pa ON pa.s = t.a JOIN pb ON pb.s = t.b), "
       "m AS (SELECT label, count(*) AS n, avg(va) AS va, avg(vb) AS vb, var_samp(va) / count(*) AS sa, var_samp(vb) / count(*) AS sb, "
       "var_samp(va - vb) / count(*) AS sd FROM v GROUP BY label), "
       "o AS (SELECT sum(n) FILTER (WHERE label = 1) AS n_pos, sum(n) FILTER (WHERE label = 0) AS n_neg, max(va) FILTER (WHERE label = 1) AS auc_a, "
       "max(vb) FILTER (WHERE label = 1) AS auc_b, sqrt(sum(sa)) AS se_a, sqrt(sum(sb)) AS se_b, sqrt(sum(sd)) AS se FROM m) "
       "SELECT n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg, 0::BIGINT AS n_dropped, round(auc_a, 9) AS auc_a, round(auc_b, 9) AS auc_b, round(se_a, 9) AS se_a, "
       "round(se_b, 9) AS se_b, round(auc_a - auc_b, 9) AS difference, round(se, 9) AS se, round((auc_a - auc_b) / se, 6) AS z, "
       "round(auc_a - auc_b - 1.959963984540054 * se, 9) AS low, round(auc_a - auc_b + 1.959963984540054 * se, 9) AS high FROM o")
def q_auc_comparison(spark, base):
    """Two scoring rules on the same rows: is one really better?"""
    df = cut_lineage(prepared_clients(spark, base).select("label", F.col("pay_1").alias("a"), (F.col("pay_2") + F.col("pay_1") / 2).alias("b")))
    out = compare_auc(df, "a", "b")
    return profile.with_rounded(out, {c: 6 if c == "z" else 9 for c in out.columns if not c.startswith("n_")})


# ------------------------------------------------------------------------------- run table (E8)

@query("run_table", "E8,M7,M8",
       "WITH c AS (SELECT count(*) FILTER (WHERE bucket < 80) AS train, count(*) FILTER (WHERE bucket >= 80) AS test FROM clients_split), "
       "m(model) AS (VALUES ('decision_tree'), ('logistic_regression')) "
       "SELECT model, 'fit' AS step, train AS n_rows, true AS timed FROM m, c UNION ALL SELECT model, 'score', test, true FROM m, c")
def q_run_table(spark, base):
    """Fits and scores as measured: their rows, and times only for being there."""
    df = split.with_split(prepared_clients(spark, base), "id").withColumn("label", F.col("label").cast("double"))
    frame = cut_lineage(VectorAssembler(inputCols=["pay_1", "pay_2", "limit_bal"], outputCol="features").transform(df).select("split", "features", "label"))
    runs = Runs(spark, "run_table")
    for name, est in (("logistic_regression", LogisticRegression(maxIter=5)), ("decision_tree", DecisionTreeClassifier(maxDepth=3))):
        runs.score(name, runs.fit(name, est, frame.where("split = 'train'")), frame.where("split = 'test'"))
    table = runs.write(scratch_path(spark, "runs"))
    return table.select("model", "step", "n_rows", (F.col("seconds") > 0).alias("timed"))


# ---------------------------------------------------------------------- splits of exact size (D1, D2)

@query("stratified_split", "D1,D2",
       f"WITH o AS (SELECT id, education, row_number() OVER (PARTITION BY education ORDER BY {hx(None, 'id')}, id::VARCHAR) AS nth, "
       "count(*) OVER (PARTITION BY education) AS n FROM clients_prep) "
       "SELECT id, education, CASE WHEN nth <= round(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM o")
def q_stratified_split(spark, base):
    return stratified_split(prepared_clients(spark, base).select("id", "education"), "id", "education", 0.8)


# --------------------------------------------------------------------- mergeable distinct counts (A10)

DISTINCT_COLS = ["o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]


@query("distinct_merged", "A10",
       " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact, true AS in_bound FROM orders" for c in DISTINCT_COLS))
def q_distinct_merged(spark, base):
    """Sketches kept by order priority and merged, beside the exact counts: is the estimate within its bound?"""
    orders = load(spark, base, "orders")
    path = scratch_path(spark, "distinct-states")
    parts = [r[0] for r in orders.select("o_orderpriority").distinct().limit(20).collect()]  # five priorities
    for part in parts:
        save_states(distinct_states(orders.where(F.col("o_orderpriority").eqNullSafe(F.lit(part))), "o_orderpriority", DISTINCT_COLS), path)
    exact = profile.distinct_counts(orders, DISTINCT_COLS).select("column_name", F.col("n_distinct").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.lit(error_bound()) * F.col("n_exact")
    return exact.join(merged_distinct(load_states(spark, path)), "column_name").select("column_name", "n_exact", off.alias("in_bound"))

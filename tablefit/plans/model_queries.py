"""Catalogue: models (saturated-design oracles), metrics, leaderboard, tuning.

Saturated designs: when every feature combination ("cell") can be separated
by the model, the fitted prediction has a closed form -- the cell mean for
least squares and regression trees, the cell rate for logistic regression,
the cell majority for classification trees -- which SQL computes directly.
Trees get a depth that can isolate every cell (two factors of 5 and 3
values need up to 4 + 2 levels).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tablefit.operators import evaluate, features, forest_fit, models, profile, search_log, split, tune
from tablefit.plans.feature_queries import client_features, client_spec
from tablefit.plans.profile_queries import prepared_clients
from tablefit.plans.registry import query
from tablefit.session import cut_lineage
from tablefit.sources import blocks, clients, load, spread_rows
from tablefit.sources.tables import table_path

TRAIN_BLOCKS = "(SELECT * FROM blocks_split WHERE bucket < 80)"
TRAIN_CLIENTS = "(SELECT * FROM clients_split WHERE bucket < 80)"
TREE_DEPTH = 8  # isolates every (category, status) cell


def _train(df, key):
    return split.with_split(df, key).where(F.col("split") == "train")


# ------------------------------------------------------------ linear (M1-M3)

def _linreg(spark, base):
    train = _train(blocks(spark, base), "block_id")
    pipe = Pipeline(stages=[
        features.categorical_stage(["category"]),
        VectorAssembler(inputCols=["category_ohe"], outputCol="features"),
        LinearRegression(labelCol="total_value"),
    ])
    model = pipe.fit(train)
    return model, model.transform(train)


@query("linreg_one_factor", "M1,M10",
       f"SELECT category, round(avg(total_value), 4) AS prediction FROM {TRAIN_BLOCKS} GROUP BY category")
def q_linreg_one_factor(spark, base):
    _, scored = _linreg(spark, base)
    out = scored.groupBy("category").agg(F.min("prediction").alias("prediction"))
    return profile.with_rounded(out, {"prediction": 4})


@query("linreg_coefficients", "M2",
       f"WITH g AS (SELECT category, count(*) AS n, avg(total_value) AS m FROM {TRAIN_BLOCKS} GROUP BY category), "
       "r AS (SELECT category, m, row_number() OVER (ORDER BY n DESC, category) - 1 AS ci FROM g), "
       "last AS (SELECT m AS m_last FROM r WHERE ci = (SELECT max(ci) FROM r)) "
       "SELECT 'category_ohe_' || category AS feature, round(m - m_last, 4) AS coefficient "
       "FROM r, last WHERE ci < (SELECT max(ci) FROM r) "
       "UNION ALL SELECT 'intercept' AS feature, round(m_last, 4) AS coefficient FROM last")
def q_linreg_coefficients(spark, base):
    model, scored = _linreg(spark, base)
    out = models.coefficients_frame(spark, model.stages[-1], scored)
    return profile.with_rounded(out, {"coefficient": 4})


@query("linreg_train_rmse", "M3",
       f"WITH t AS {TRAIN_BLOCKS}, g AS (SELECT category, avg(total_value) AS m FROM t GROUP BY category) "
       "SELECT round(sqrt(avg((total_value - m) * (total_value - m))), 4) AS rmse, count(*) AS n "
       "FROM t JOIN g USING (category)")
def q_linreg_train_rmse(spark, base):
    model, _ = _linreg(spark, base)
    out = models.training_summary_frame(spark, model.stages[-1]).select("rmse", "n")
    return profile.with_rounded(out, {"rmse": 4})


# -------------------------------------------------------- regression trees

_CELL_MEAN = (f"SELECT category, status, round(avg(total_value), 4) AS prediction FROM {TRAIN_BLOCKS} "
              "GROUP BY category, status")


def _cell_regression(spark, base, learner):
    train = _train(blocks(spark, base), "block_id")
    pipe = Pipeline(stages=[
        StringIndexer(inputCols=["category", "status"], outputCols=["category_index", "status_index"]),
        VectorAssembler(inputCols=["category_index", "status_index"], outputCol="features"),
        learner,
    ])
    scored = pipe.fit(train).transform(train)
    out = scored.groupBy("category", "status").agg(F.min("prediction").alias("prediction"))
    return profile.with_rounded(out, {"prediction": 4})


@query("dt_regression", "M4,M10", _CELL_MEAN)
def q_dt_regression(spark, base):
    return _cell_regression(spark, base, DecisionTreeRegressor(labelCol="total_value", maxDepth=TREE_DEPTH))


@query("rf_regression", "M5,M10", _CELL_MEAN)
def q_rf_regression(spark, base):
    return _cell_regression(spark, base, RandomForestRegressor(
        labelCol="total_value", maxDepth=TREE_DEPTH, numTrees=20, bootstrap=False,
        featureSubsetStrategy="all", seed=1234))


@query("gbt_regression", "M6,M10", _CELL_MEAN)
def q_gbt_regression(spark, base):
    return _cell_regression(spark, base, GBTRegressor(labelCol="total_value", maxDepth=TREE_DEPTH,
                                                      maxIter=10, seed=1234))


# --------------------------------------------------------- classification

@query("logreg_one_factor", "M7,M10",
       f"SELECT pay_1, round(avg(label), 4) AS probability FROM {TRAIN_CLIENTS} GROUP BY pay_1")
def q_logreg_one_factor(spark, base):
    train = _train(prepared_clients(spark, base), "id").withColumn("label", F.col("label").cast("double"))
    pipe = Pipeline(stages=[
        features.integer_onehot_stage(["pay_1"]),
        VectorAssembler(inputCols=["pay_1_ohe"], outputCol="features"),
        LogisticRegression(maxIter=100, tol=1e-10),
    ])
    scored = pipe.fit(train).transform(train)
    out = scored.groupBy("pay_1").agg(F.min(vector_to_array("probability").getItem(1)).alias("probability"))
    return profile.with_rounded(out, {"probability": 4})


_CELL_MAJORITY = (f"SELECT pay_1, sex, CASE WHEN avg(label) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction "
                  f"FROM {TRAIN_CLIENTS} GROUP BY pay_1, sex")


def _cell_classify(spark, base, learner):
    train = _train(prepared_clients(spark, base), "id").withColumn("label", F.col("label").cast("double"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["pay_1", "sex"], outputCol="features"), learner])
    scored = pipe.fit(train).transform(train)
    return scored.groupBy("pay_1", "sex").agg(F.min("prediction").alias("prediction"))


@query("dt_classify", "M8,M10", _CELL_MAJORITY)
def q_dt_classify(spark, base):
    return _cell_classify(spark, base, DecisionTreeClassifier())


@query("rf_classify", "M9,M10", _CELL_MAJORITY)
def q_rf_classify(spark, base):
    return _cell_classify(spark, base, RandomForestClassifier(seed=1234))


# ---------------------------------------------------------------- metrics

@query("rmse", "E1",
       "SELECT count(*) AS n, (SELECT count(*) FROM blocks WHERE ext_price IS NULL) AS n_dropped, round(sqrt(avg((total_value - ext_price) * (total_value - ext_price))), 4) AS rmse, "
       "round(avg((total_value - ext_price) * (total_value - ext_price)), 0) AS mse, "
       "round(avg(abs(total_value - ext_price)), 4) AS mae, "
       "round(1 - avg((total_value - ext_price) * (total_value - ext_price)) / var_pop(total_value), 8) AS r2 "
       "FROM blocks WHERE ext_price IS NOT NULL")
def q_rmse(spark, base):
    out = evaluate.regression_metrics(blocks(spark, base), label="total_value", prediction="ext_price")
    return profile.with_rounded(out, {"rmse": 4, "mse": 0, "mae": 4, "r2": 8})


def _auc_sql(score: str) -> str:
    return (
        f"WITH g AS (SELECT {score}::DOUBLE AS s, count(*) FILTER (WHERE label = 1)::DOUBLE AS pos, "
        f"count(*) FILTER (WHERE label <> 1)::DOUBLE AS neg FROM clients GROUP BY {score}), "
        "c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS below FROM g) "
        "SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 10) AS auc, (SELECT count(*) FROM clients WHERE label IS NULL OR "
        f"{score} IS NULL) AS n_dropped FROM c"
    )


@query("auc_swept", "E2", _auc_sql("pay_1"))
def q_auc_swept(spark, base):
    out = evaluate.auc(clients(spark, base), label="label", score="pay_1")
    return profile.with_rounded(out, {"auc": 10})


@query("auc_swept_fine", "E2", _auc_sql("limit_bal"))
def q_auc_swept_fine(spark, base):
    out = evaluate.auc(clients(spark, base), label="label", score="limit_bal", rows_per_bucket=500)
    return profile.with_rounded(out, {"auc": 10})


RULES = {"pay_1_ge_3": "pay_1 >= 3", "pay_1_ge_2": "pay_1 >= 2", "pay_2_ge_3": "pay_2 >= 3"}
_METRIC_DIGITS = {m: 12 for m in ("accuracy", "precision", "recall", "f1", "balanced_accuracy")}


def _rule_predictions(spark, base):
    df = clients(spark, base)
    cols = {name: F.expr(f"CASE WHEN {rule} THEN 1.0 ELSE 0.0 END") for name, rule in RULES.items()}
    wide = df.select("label", *[c.alias(n) for n, c in cols.items()])
    return wide.unpivot(ids=["label"], values=list(RULES), variableColumnName="model",
                        valueColumnName="prediction")


def _bundle_sql(models_filter: str | None = None) -> str:
    parts = [f"SELECT '{n}' AS model, label, CASE WHEN {r} THEN 1 ELSE 0 END AS prediction FROM clients"
             for n, r in RULES.items() if models_filter in (None, n)]
    return (
        "WITH p AS (" + " UNION ALL ".join(parts) + "), "
        "c AS (SELECT model, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, "
        "count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp, "
        "count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn, "
        "count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM p GROUP BY model) "
    )


def _hard(spark, base):
    preds = _rule_predictions(spark, base).where(F.col("model") == "pay_1_ge_3")
    return profile.with_rounded(evaluate.binary_metrics(preds), _METRIC_DIGITS)


@query("auc_hard", "E3", _bundle_sql("pay_1_ge_3")
       + "SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 12) AS balanced_accuracy FROM c")
def q_auc_hard(spark, base):
    return _hard(spark, base).select("balanced_accuracy")


@query("accuracy", "E4", _bundle_sql("pay_1_ge_3")
       + "SELECT round((tp + tn) / (tp + fp + fn + tn), 12) AS accuracy FROM c")
def q_accuracy(spark, base):
    return _hard(spark, base).select("accuracy")


@query("f1_positive", "E5", _bundle_sql("pay_1_ge_3") + "SELECT round(2 * tp / (2 * tp + fp + fn), 12) AS f1 FROM c")
def q_f1_positive(spark, base):
    return _hard(spark, base).select("f1")


@query("confusion", "E6",
       "SELECT label::DOUBLE AS label, CASE WHEN pay_1 >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS count "
       "FROM clients GROUP BY ALL")
def q_confusion(spark, base):
    preds = _rule_predictions(spark, base).where(F.col("model") == "pay_1_ge_3")
    return evaluate.confusion(preds)


@query("metric_bundle", "E7", _bundle_sql() + (
    "SELECT model, tp, fp, fn, tn, tp + fp + fn + tn AS n, round((tp + tn) / (tp + fp + fn + tn), 12) AS accuracy, "
    "round(tp / (tp + fp), 12) AS precision, round(tp / (tp + fn), 12) AS recall, "
    "round(2 * tp / (2 * tp + fp + fn), 12) AS f1, "
    "round((tp / (tp + fn) + tn / (tn + fp)) / 2, 12) AS balanced_accuracy FROM c"))
def q_metric_bundle(spark, base):
    out = evaluate.binary_metrics(_rule_predictions(spark, base), group_by=["model"])
    return profile.with_rounded(out, _METRIC_DIGITS)


# ------------------------------------------------- leaderboard and tuning

def _client_rows(df):
    """What the models take of the clients, written once: statistics and features are then made from it."""
    spec = client_spec()
    return cut_lineage(df.select(spec.id, "split", F.col(spec.label).cast("double").alias("label"), *spec.numeric, *spec.integer_categorical))


def client_frames(spark, base):
    df, pipe = client_features(spark, base)
    df = _client_rows(df)
    fitted = features.fit_features(pipe, df, train=df.where(F.col("split") == "train"))
    frame = cut_lineage(fitted.transform(df).select("id", "split", "features", "label"))
    return frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")


@query("leaderboard", "E8,M7,M8,M9,M10")
def q_leaderboard(spark, base):
    train, test = client_frames(spark, base)
    fitted = _fit_all(spark, train, ("logistic_regression", "decision_tree", "random_forest"))
    stacked = evaluate.stack_predictions(test, fitted)
    return evaluate.leaderboard([evaluate.model_metrics(stacked)], "balanced_accuracy")


@query("leaderboard_rules", "E8", _bundle_sql() + (
    ", m AS (SELECT model, tp, fp, fn, tn, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 12) AS balanced_accuracy FROM c) "
    "SELECT *, row_number() OVER (ORDER BY round(balanced_accuracy, 10) DESC, model)::INTEGER AS rank FROM m"))
def q_leaderboard_rules(spark, base):
    bundles = evaluate.binary_metrics(_rule_predictions(spark, base), group_by=["model"])
    board = evaluate.leaderboard([bundles], "balanced_accuracy")
    return profile.with_rounded(board, {"balanced_accuracy": 12}).select("model", "tp", "fp", "fn", "tn", "balanced_accuracy", "rank")


def _fit_all(spark, train, names):
    """Fit each registry estimator on the persisted training frame."""
    fitted = {}
    with models.persisted(train):
        for name in names:
            est = models.estimator(name)
            if est.hasParam("seed"):
                est = est.copy({est.getParam("seed"): 1234})
            fitted[name] = models.with_checkpointing(est, spark).fit(train)
    return fitted


def _logged(spark, base, tables, est, grid, train, folds, evaluator=None, about=""):
    """A search that takes from the log in the shared folder what an earlier run on the same files has finished."""
    evaluator = evaluator or tune.auc_evaluator()
    version = search_log.input_version(spark, [table_path(base, t) for t in tables])
    log = search_log.SearchLog(spark, search_log.search_key(version, est, grid, evaluator, folds, about))
    return search_log.search(est, grid, train, log, evaluator, "fold", folds, parallelism=8)


def _search(spark, base, name):
    """The surveyed grid and folds of a classifier of the registry: (search, test frame)."""
    train, test = client_frames(spark, base)
    folds = models.FOLDS[name]
    est = models.estimator(name)
    if est.hasParam("seed"):
        est = est.copy({est.getParam("seed"): 1234})
    if est.hasParam("numTrees"):
        est = forest_fit.forest_classifier(models.with_checkpointing(est, spark))
    found = _logged(spark, base, ("orders", "customer"), est, models.GRIDS[name], split.with_folds(train, "id", folds), folds, about="client_frames")
    return found, test


def _cv(spark, base):
    return _search(spark, base, "logistic_regression")


def _search_rows(spark, base, name):
    """Per-point results of a search, the test metrics of its best model on the best row."""
    found, test = _search(spark, base, name)
    score = evaluate.model_metrics(evaluate.stack_predictions(test, {name: found.best_model()}))
    return found.results(spark).withColumn("model", F.when(F.col("is_best"), F.lit(name))).join(
        F.broadcast(score), "model", "left")  # one row


@query("cv_tree", "T1,T2,T3,T4,T5,T6,M8")
def q_cv_tree(spark, base):
    return _search_rows(spark, base, "decision_tree")


@query("cv_forest", "T1,T2,T3,T4,T5,T6,M9")
def q_cv_forest(spark, base):
    return _search_rows(spark, base, "random_forest")


_SEARCH_SQL = (
    "WITH t AS (SELECT category, status, total_value AS y, bucket, "
    "CAST(('0x' || substr(md5(block_id::VARCHAR || ':fold'), 1, 8))::BIGINT % 3 AS INTEGER) AS fold FROM blocks_split), "
    "tr AS (SELECT * FROM t WHERE bucket < 80), folds AS (SELECT DISTINCT fold FROM tr), "
    "m0 AS (SELECT f.fold, avg(y) AS p FROM folds f JOIN tr ON tr.fold <> f.fold GROUP BY f.fold), "
    "m8 AS (SELECT f.fold, category, status, avg(y) AS p FROM folds f JOIN tr ON tr.fold <> f.fold GROUP BY ALL), "
    "e AS (SELECT 0 AS point, tr.fold, sqrt(avg((y - p) * (y - p))) AS rmse FROM tr JOIN m0 USING (fold) GROUP BY tr.fold "
    "UNION ALL SELECT 1, tr.fold, sqrt(avg((y - p) * (y - p))) FROM tr JOIN m8 USING (fold, category, status) GROUP BY tr.fold), "
    "r AS (SELECT point, CASE point WHEN 0 THEN '{\"maxDepth\": 0}' ELSE '{\"maxDepth\": 8}' END AS params, "
    "avg(rmse) AS mean_metric, stddev_pop(rmse) AS std_metric FROM e GROUP BY point), "
    "b AS (SELECT point AS best FROM r ORDER BY round(mean_metric, 10), point LIMIT 1) "
)


def _saturated_search(spark, base):
    """A search whose metrics have a closed form: a tree of depth 0 predicts the mean of the other folds, one of depth 8
    the cell mean of the other folds."""
    from pyspark.ml.evaluation import RegressionEvaluator

    df = split.with_folds(split.with_split(blocks(spark, base), "block_id"), "block_id", 3)
    df = df.select("category", "status", "split", "fold", F.col("total_value").alias("label"))
    prep = Pipeline(stages=[
        StringIndexer(inputCols=["category", "status"], outputCols=["category_index", "status_index"]),
        VectorAssembler(inputCols=["category_index", "status_index"], outputCol="features"),
    ]).fit(df)
    frame = cut_lineage(prep.transform(df).select("features", "label", "fold", "split"))
    found = _logged(spark, base, ("orders", "customer", "lineitem"), DecisionTreeRegressor(), {"maxDepth": [0, TREE_DEPTH]}, frame.where("split = 'train'"), 3,
                    RegressionEvaluator(metricName="rmse"), "saturated")
    return found, frame.where("split = 'test'")


@query("cv_saturated", "T1,T2,T3,T6",
       _SEARCH_SQL + "SELECT CAST(point AS INTEGER) AS point, params, round(mean_metric, 4) AS mean_metric, "
       "round(std_metric, 4) AS std_metric, point = best AS is_best FROM r, b")
def q_cv_saturated(spark, base):
    out = _saturated_search(spark, base)[0].results(spark)
    return profile.with_rounded(out, {"mean_metric": 4, "std_metric": 4})


@query("cv_saturated_best", "T4",
       _SEARCH_SQL + "SELECT 'maxDepth' AS param, CASE best WHEN 0 THEN '0' ELSE '8' END AS value FROM b")
def q_cv_saturated_best(spark, base):
    return _saturated_search(spark, base)[0].best_params(spark, ["maxDepth"])


@query("cv_saturated_score", "T5,E1",
       _SEARCH_SQL + ", c AS (SELECT category, status, avg(y) AS p8 FROM tr GROUP BY ALL), a AS (SELECT avg(y) AS p0 FROM tr) "
       "SELECT count(*) AS n, round(sqrt(avg(power(y - CASE best WHEN 0 THEN p0 ELSE p8 END, 2))), 4) AS rmse "
       "FROM t JOIN c USING (category, status), a, b WHERE bucket >= 80")
def q_cv_saturated_score(spark, base):
    found, test = _saturated_search(spark, base)
    out = evaluate.regression_metrics(found.best_model().transform(test)).select("n", "rmse")
    return profile.with_rounded(out, {"rmse": 4})


@query("cv_results", "T1,T2,T3,T6")
def q_cv_results(spark, base):
    return _cv(spark, base)[0].results(spark)


@query("cv_best_params", "T4")
def q_cv_best_params(spark, base):
    return _cv(spark, base)[0].best_params(spark, ["regParam", "elasticNetParam", "maxIter"])


@query("cv_score", "T5,E7")
def q_cv_score(spark, base):
    found, test = _cv(spark, base)
    stacked = evaluate.stack_predictions(test, {"logistic_regression_cv": found.best_model()})
    return evaluate.model_metrics(stacked)


# ------------------------------------------------ regression comparison (A)

#: Blocks in one task: their features are few, and each part of a deep forest's fit sends on the counts of all its nodes.
BLOCKS_PER_PART = 1_000_000
LEAST_BLOCKS = 50_000


def _block_frames(spark, base):
    """blocks -> (train, test) modelling frames: numeric columns imputed and
    scaled, category one-hot; fitted on the training rows only."""
    from tablefit.plans.feature_queries import _block_numeric

    df = split.with_split(blocks(spark, base), "block_id")
    numeric = _block_numeric(df)
    df = df.select("block_id", "split", "category", F.col("total_value").alias("label"), *numeric)
    df = cut_lineage(spread_rows(df, load(spark, base, "orders").count(), BLOCKS_PER_PART, LEAST_BLOCKS))
    pipe = features.feature_pipeline(numeric=numeric, categorical=["category"])
    fitted = features.fit_features(pipe, df, train=df.where(F.col("split") == "train"))
    frame = cut_lineage(fitted.transform(df).select("block_id", "split", "features", "label"))
    return frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")


REGRESSORS = ("linear_regression", "decision_tree_regression", "random_forest_regression", "gbt_regression")


@query("regression_leaderboard", "E1,E8,M1,M4,M5,M6,M10")
def q_regression_leaderboard(spark, base):
    train, test = _block_frames(spark, base)
    stacked = evaluate.stack_regressions(test, _fit_all(spark, train, REGRESSORS))
    metrics = evaluate.regression_metrics(stacked, group_by=["model"])
    return evaluate.leaderboard([metrics], "rmse", larger_is_better=False)


@query("rf_regression_cv", "T1,T2,T3,T4,T5")
def q_rf_regression_cv(spark, base):
    """Per-point results of the surveyed forest search; on the best row, the held-out errors of its model."""
    from pyspark.ml.evaluation import RegressionEvaluator

    name = "random_forest_regression"
    train, test = _block_frames(spark, base)
    folds = models.FOLDS[name]
    found = _logged(spark, base, ("orders", "customer", "lineitem"), models.with_checkpointing(models.estimator(name, seed=1234), spark), models.GRIDS[name], split.with_folds(train, "block_id", folds), folds,
                    RegressionEvaluator(metricName="rmse"), "block_frames")
    held_out = evaluate.regression_metrics(found.best_model().transform(test)).withColumn("model", F.lit(name))
    return found.results(spark).withColumn("model", F.when(F.col("is_best"), F.lit(name))).join(F.broadcast(held_out), "model", "left")  # one row


@query("cv_leak_free", "T1,T2,T3,T6,F8,D2")
def q_cv_leak_free(spark, base):
    """The surveyed logistic search with the features refitted on each fold's own
    training rows: imputation, scaling and one-hot widths (unseen codes in a
    validation fold are kept as an all-zero slot)."""
    name = "logistic_regression"
    df, pipe = client_features(spark, base, handle_invalid="keep")
    train = split.with_folds(_client_rows(df.where(F.col("split") == "train")), "id", models.FOLDS[name])
    cvm = tune.cross_validate_pipeline(pipe, models.estimator(name), models.GRIDS[name], train,
                                       num_folds=models.FOLDS[name], parallelism=8)
    return tune.cv_results(spark, cvm)


_CELLS = (
    f"WITH r AS (SELECT pay_1, sex, avg(label) AS p FROM {TRAIN_CLIENTS} GROUP BY ALL), "
    "t AS (SELECT label, p, p > 0.5 AS hit FROM clients_split JOIN r USING (pay_1, sex) WHERE bucket >= 80), "
    "c AS (SELECT count(*) FILTER (WHERE hit AND label = 1) AS tp, count(*) FILTER (WHERE hit AND label = 0) AS fp, "
    "count(*) FILTER (WHERE NOT hit AND label = 1) AS fn, count(*) FILTER (WHERE NOT hit AND label = 0) AS tn FROM t), "
    "m(model, rank) AS (VALUES ('decision_tree', 1), ('random_forest', 2)) "
)


@query("leaderboard_saturated", "E8,E7,M8,M9,M10",
       _CELLS + "SELECT model, rank::INTEGER AS rank, tp, fp, fn, tn, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 12) AS balanced_accuracy FROM m, c")
def q_leaderboard_saturated(spark, base):
    """Two fitted models that isolate every cell of two factors, scored on the held-out rows: their board has a closed form."""
    df = split.with_split(prepared_clients(spark, base), "id").withColumn("label", F.col("label").cast("double"))
    frame = cut_lineage(VectorAssembler(inputCols=["pay_1", "sex"], outputCol="features").transform(df).select("split", "features", "label"))
    train = frame.where("split = 'train'")
    learners = {"decision_tree": DecisionTreeClassifier(maxDepth=TREE_DEPTH),
                "random_forest": RandomForestClassifier(maxDepth=TREE_DEPTH, numTrees=5, bootstrap=False, featureSubsetStrategy="all", seed=1234)}
    with models.persisted(train):
        fitted = {name: est.fit(train) for name, est in learners.items()}
    board = evaluate.leaderboard([evaluate.model_metrics(evaluate.stack_predictions(frame.where("split = 'test'"), fitted))], "balanced_accuracy")
    out = board.select("model", "rank", "tp", "fp", "fn", "tn", "balanced_accuracy")
    return profile.with_rounded(out, {"balanced_accuracy": 12})


@query("stream_rules", "M10,E6",
       "SELECT label::DOUBLE AS label, CASE WHEN pay_1 >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS count FROM clients_prep GROUP BY ALL")
def q_stream_rules(spark, base):
    """All clients replayed as a file stream, scored by a rule, in a running confusion matrix."""
    import uuid

    from tablefit.session import scratch_path
    from tablefit.streaming import read_stream, start_confusion

    df = prepared_clients(spark, base).select("id", "pay_1", F.col("label").cast("double").alias("label"))
    path = scratch_path(spark, "stream-rules")
    df.repartition(4, "id").write.parquet(path)
    stream = read_stream(spark, path, df.schema, max_files_per_trigger=2)
    name = f"rules_{uuid.uuid4().hex[:12]}"
    q = start_confusion(stream.withColumn("prediction", (F.col("pay_1") >= 3).cast("double")), name)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


#: Rows of a part of the replayed stream, about.
STREAM_ROWS = 200_000


@query("stream_confusion", "M10,E6")
def q_stream_confusion(spark, base):
    """The held-out clients, written as parquet parts to the shared folder,
    replayed as a file stream (a quarter of the parts per micro-batch), scored by the fitted
    feature pipeline + logistic regression, and accumulated into a running
    confusion matrix (four keys of state); returns the final counts."""
    import uuid

    from tablefit.session import scratch_path
    from tablefit.streaming import read_stream, score_stream, start_confusion

    df, pipe = client_features(spark, base, handle_invalid="keep")
    df = df.withColumn("label", F.col("label").cast("double"))
    train = _client_rows(df.where(F.col("split") == "train"))
    fitted = features.fit_features(pipe, train, train=train)
    with models.persisted(fitted.transform(train).select("features", "label")) as frame:
        clf = models.estimator("logistic_regression").fit(frame)

    test = df.where(F.col("split") == "test").drop("split")
    path = scratch_path(spark, "stream-clients")
    files = max(1, load(spark, base, "orders").count() // 5 // 4 // STREAM_ROWS)  # a fifth is held out
    test.repartition(4 * files, "id").write.parquet(path)
    stream = read_stream(spark, path, test.schema, max_files_per_trigger=files)
    name = f"confusion_{uuid.uuid4().hex[:12]}"
    q = start_confusion(score_stream(clf, score_stream(fitted, stream)), name)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)

"""Grid search by k-fold cross-validation.

Folds come from a hash of the key (``split.with_folds``) through
``CrossValidator(foldCol=...)``, so every fold is the same on every run and
partitioning.  Metrics are sums of floating-point numbers whose order may
differ from run to run; so the best point is chosen on metrics rounded to
``METRIC_DIGITS`` digits, the first of the grid among equals.  ``parallelism`` fits grid points
concurrently (driver threads, each fit itself distributed).  The training
frame is persisted for the k x |grid| + 1 fits.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.operators.fold_quantile import complement_quantiles
from tablefit.operators.impute import MissingValueImputer, MissingValueImputerModel
from tablefit.operators.models import persisted


METRIC_DIGITS = 10
#: Training rows, of all fits together, that the fits running at once may keep.
ROWS_AT_ONCE = 80_000_000


def at_once(train: DataFrame, parallelism: int) -> int:
    """Fits to run at the same time on a persisted frame: each keeps a copy of its rows, and those of many large ones would go to disk and be read from
    there in every step."""
    return max(1, min(parallelism, ROWS_AT_ONCE // max(train.count(), 1)))


def best_point(metrics: Sequence[float], larger_is_better: bool) -> int:
    """Index of the best rounded metric, the lowest among equals; NaN is never best."""
    def key(i: int):
        m = round(metrics[i], METRIC_DIGITS) if metrics[i] == metrics[i] else float("-inf" if larger_is_better else "inf")
        return (-m if larger_is_better else m, i)

    return min(range(len(metrics)), key=key)


def _chosen(model: CrossValidatorModel, est, train: DataFrame) -> CrossValidatorModel:
    """The model of the best point by ``best_point``: refitted where the search kept another one."""
    larger = model.getEvaluator().isLargerBetter()
    metrics = list(model.avgMetrics)
    kept = max(range(len(metrics)), key=lambda i: metrics[i] if larger else -metrics[i])
    best = best_point(metrics, larger)
    if best != kept:
        model.bestModel = est.fit(train, model.getEstimatorParamMaps()[best])
    return model


def param_grid(est, grid: Mapping[str, Sequence]) -> list:
    """Cartesian grid over named params of ``est``."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    return builder.build()


def auc_evaluator(raw_col: str = "rawPrediction", num_bins: int = 1000) -> BinaryClassificationEvaluator:
    """Threshold-swept AUC on scores (the tuning criterion)."""
    return BinaryClassificationEvaluator(rawPredictionCol=raw_col, metricName="areaUnderROC",
                                         numBins=num_bins)


def cross_validate(est, grid: Mapping[str, Sequence], train: DataFrame, evaluator=None,
                   fold_col: str | None = "fold", num_folds: int = 3, parallelism: int = 1,
                   seed: int = 1234) -> CrossValidatorModel:
    maps = param_grid(est, grid)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator or auc_evaluator(),
                        numFolds=num_folds, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    with persisted(train):
        return _chosen(cv.fit(train), est, train)


def _param_value(v):
    return v if isinstance(v, (int, float, str, bool)) or v is None else str(v)


def cv_results(spark: SparkSession, cv_model: CrossValidatorModel) -> DataFrame:
    """One row per grid point: ``(point, params, mean_metric, std_metric, is_best)``."""
    maps = cv_model.getEstimatorParamMaps()
    means = list(cv_model.avgMetrics)
    stds = list(cv_model.stdMetrics) if cv_model.stdMetrics else [None] * len(means)
    best = best_point(means, cv_model.getEvaluator().isLargerBetter())
    rows = []
    for i, (pm, m, s) in enumerate(zip(maps, means, stds)):
        params = json.dumps({p.name: _param_value(v) for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)})
        rows.append((i, params, float(m), None if s is None else float(s), i == best))
    return spark.createDataFrame(
        rows, "point int, params string, mean_metric double, std_metric double, is_best boolean")


def best_params(spark: SparkSession, cv_model: CrossValidatorModel, names: Sequence[str] | None = None) -> DataFrame:
    """``(param, value)`` of the refitted best model (values as strings)."""
    pm = cv_model.bestModel.extractParamMap()
    rows = sorted((p.name, str(v)) for p, v in pm.items() if names is None or p.name in names)
    return spark.createDataFrame(rows, "param string, value string")


def _stages(stage) -> list:
    """All stages of nested pipelines."""
    return [s for part in stage.getStages() for s in _stages(part)] if isinstance(stage, Pipeline) else [stage]


def _exact_median(stage) -> bool:
    return isinstance(stage, MissingValueImputer) and stage.getOrDefault(stage.strategy) == "median" and stage.getRelativeError() == 0.0


def _with_medians(stage, medians: Mapping[str, float | None]):
    """The stage with its exact-median imputers replaced by models of the given medians; columns without one are left to the fit, which refuses them."""
    if isinstance(stage, Pipeline):
        return Pipeline(stages=[_with_medians(s, medians) for s in stage.getStages()])
    if not _exact_median(stage) or any(medians.get(c) is None for c in stage.getInputCols()):
        return stage
    return stage._copyValues(MissingValueImputerModel(surrogates=[float(medians[c]) for c in stage.getInputCols()]))


def cross_validate_pipeline(prep, final_stage, grid: Mapping[str, Sequence], train: DataFrame,
                            evaluator=None, fold_col: str = "fold", num_folds: int = 3,
                            parallelism: int = 1) -> CrossValidatorModel:
    """Cross-validate ``final_stage`` behind a feature pipeline that is fitted on
    each fold's own training rows, so no fitted statistic -- median, deviation,
    category list -- leaks from validation to training.

    The features do not depend on the grid: they are fitted once per fold, and
    the grid is searched on the transformed rows.  Exact medians of all folds' training rows
    are found together, in the rounds of one.  The best model is the whole
    pipeline, refitted on all rows.
    """
    imputed = [c for s in _stages(prep) if _exact_median(s) for c in s.getInputCols()]
    medians = complement_quantiles(train, imputed, num_folds, fold_col) if imputed else {}
    evaluator = evaluator or auc_evaluator()
    maps = param_grid(final_stage, grid)
    metrics: list[list[float]] = [[] for _ in maps]
    for fold in range(num_folds):
        fitted = _with_medians(prep, medians.get(fold, {})).fit(train.where(F.col(fold_col) != fold))
        seen = fitted.transform(train.where(F.col(fold_col) != fold))
        held = fitted.transform(train.where(F.col(fold_col) == fold))
        with persisted(seen), persisted(held), ThreadPool(at_once(seen, parallelism)) as pool:
            score = inheritable_thread_target(train.sparkSession)(
                lambda point, seen=seen, held=held: evaluator.evaluate(final_stage.fit(seen, point).transform(held)))
            for i, m in enumerate(pool.map(score, maps)):
                metrics[i].append(m)
    means = [sum(m) / num_folds for m in metrics]
    stds = [(sum((x - mean) ** 2 for x in m) / num_folds) ** 0.5 for m, mean in zip(metrics, means)]
    best = maps[best_point(means, evaluator.isLargerBetter())]
    model = Pipeline(stages=[prep, final_stage.copy(best)]).fit(train)
    out = CrossValidatorModel(model, avgMetrics=means, stdMetrics=stds)
    return out._set(estimatorParamMaps=maps, evaluator=evaluator, numFolds=num_folds)

"""Model registry over ``pyspark.ml`` estimators, with the settings the
surveyed analyses use, plus readers that turn fitted models into frames.

Training itself is Spark ML's: gradient / normal-equation aggregation for
linear models and histogram aggregation for trees, with the model broadcast
to executors each iteration.  Inputs should be persisted across iterations
(``persisted``), and tree learners get a checkpoint interval when the session
has a shared checkpoint folder, so an executor loss late in a long fit
recomputes from the last checkpoint rather than from the source.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from tablefit.operators.features import feature_names

# Estimator settings of the surveyed analyses.
ESTIMATORS = {
    "linear_regression": lambda: LinearRegression(),
    "decision_tree_regression": lambda: DecisionTreeRegressor(),
    "random_forest_regression": lambda: RandomForestRegressor(),
    "gbt_regression": lambda: GBTRegressor(maxIter=10),
    "logistic_regression": lambda: LogisticRegression(maxIter=10),
    "decision_tree": lambda: DecisionTreeClassifier(),
    "random_forest": lambda: RandomForestClassifier(),
}

# Hyper-parameter grids of the surveyed analyses.
GRIDS = {
    "random_forest_regression": {"numTrees": [1, 5, 10], "maxDepth": [5, 10, 15]},
    "logistic_regression": {"regParam": [0.2, 0.1, 0.0], "elasticNetParam": [0.2, 0.1, 0.0]},
    "decision_tree": {"maxDepth": [4, 5, 6, 7, 8, 9, 10]},
    "random_forest": {"maxDepth": [10, 15], "featureSubsetStrategy": ["all", "sqrt"],
                      "numTrees": [10, 15, 20]},
}

# Cross-validation folds used with those grids.
FOLDS = {"random_forest_regression": 3, "logistic_regression": 4, "decision_tree": 4, "random_forest": 4}


def estimator(name: str, **params):
    """A fresh estimator of the registry, with ``params`` overriding."""
    est = ESTIMATORS[name]()
    if params:
        est = est.copy({est.getParam(k): v for k, v in params.items()})
    return est


def with_checkpointing(est, spark: SparkSession, interval: int = 10):
    """Tree learners: checkpoint node-id caches every ``interval`` iterations
    into the session's checkpoint folder (when one is configured)."""
    if spark.sparkContext.getCheckpointDir() and est.hasParam("checkpointInterval"):
        est = est.copy({est.getParam("checkpointInterval"): interval})
        if est.hasParam("cacheNodeIds"):
            est = est.copy({est.getParam("cacheNodeIds"): True})
    return est


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a frame cached for the duration of iterative fits; lost blocks are
    recomputed from lineage.  A frame that came in cached stays as it is."""
    cached = df.storageLevel.useMemory or df.storageLevel.useDisk
    if not cached:
        df.persist(level)
    try:
        yield df
    finally:
        if not cached:
            df.unpersist()


def coefficients_frame(spark: SparkSession, model, scored: DataFrame, features_col: str = "features",
                       numeric_names=()) -> DataFrame:
    """``(feature, coefficient)`` of a linear model, plus an ``intercept`` row;
    names from the features' ML attribute metadata."""
    names = feature_names(scored, features_col, numeric_names)
    coefs = model.coefficients.toArray().tolist()
    rows = [(n, float(c)) for n, c in zip(names, coefs)] + [("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def training_summary_frame(spark: SparkSession, model) -> DataFrame:
    """Training-set summary of a linear regression as a one-row frame."""
    s = model.summary
    return spark.createDataFrame(
        [(float(s.rootMeanSquaredError), float(s.r2), float(s.meanAbsoluteError), int(s.numInstances))],
        "rmse double, r2 double, mae double, n bigint",
    )

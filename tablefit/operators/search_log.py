"""Cross-validation that survives its driver: finished (fold, point) pairs are kept in the shared folder.

Each metric is a one-row table of its own, written as soon as its fit is scored, under a key made of the input's files (path, length, time of
change), the estimator with its parameters, the grid, the folds and the evaluator.  A search that starts again, in this session or another,
fits only what the log has not; after a table is rewritten the key is another one, and everything is fitted anew.  Nothing is remembered in the process.

The points of a fold are fitted at once, each in a scheduler pool of its own, on the persisted rows of the fold; on many rows fewer at once, for each
fit keeps its rows in its own form.  Points of trees and forests that differ in depth or number of trees alone come from one fit; where that leaves a
fold with fewer fits than may run at once, several folds go together.  A search that fails ends its running fits before it raises.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from contextlib import ExitStack
from dataclasses import dataclass
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.operators.forest_fit import ForestClassifier
from tablefit.operators.models import persisted
from tablefit.operators.tree_depths import FOREST_LEARNERS, by_depth, fitted_by_depth
from tablefit.operators.tune import _param_value, at_once, auc_evaluator, best_point, param_grid
from tablefit.session import checkpoint_root
from tablefit.sources.tables import ROWS_PER_PART

SCHEMA = "metric double, fold int, point int"
#: Forests grown, and scored, at the same time where they come from more training rows than these: deep ones have hundreds of thousands of nodes, and the
#: driver holds each while it is loaded and sent out.
FORESTS_AT_ONCE, FOREST_ROWS = 3, 1_000_000


def input_version(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, str]]:
    """(path, length, time of change) of all files under the paths; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    rows = files.select("path", "length", F.col("modificationTime").cast("string").alias("changed")).collect()  # one row for each file
    return sorted((r["path"], r["length"], r["changed"]) for r in rows)


def _described(stage) -> dict:
    return {"class": type(stage).__name__, **{p.name: repr(_param_value(v)) for p, v in stage.extractParamMap().items() if "Col" not in p.name or p.name in ("labelCol", "featuresCol")}}


def search_key(version, est, grid: Mapping[str, Sequence], evaluator, num_folds: int, about: str = "") -> str:
    text = json.dumps([version, _described(est), {k: list(map(repr, v)) for k, v in grid.items()}, _described(evaluator), num_folds, about], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Search:
    """A finished search: parameter maps, metrics by point and fold, and what the best model is fitted from."""

    est: object
    maps: list
    metrics: list[list[float]]
    larger_is_better: bool
    train: DataFrame
    fitted: int

    @property
    def means(self) -> list[float]:
        return [sum(m) / len(m) for m in self.metrics]

    @property
    def best(self) -> int:
        return best_point(self.means, self.larger_is_better)

    def results(self, spark: SparkSession) -> DataFrame:
        """One row for each point, as ``tune.cv_results``."""
        rows = []
        for i, (point, metrics, mean) in enumerate(zip(self.maps, self.metrics, self.means, strict=True)):
            params = json.dumps({p.name: _param_value(v) for p, v in sorted(point.items(), key=lambda kv: kv[0].name)})
            rows.append((i, params, mean, (sum((x - mean) ** 2 for x in metrics) / len(metrics)) ** 0.5, i == self.best))
        return spark.createDataFrame(rows, "point int, params string, mean_metric double, std_metric double, is_best boolean")

    def best_params(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        params = self.est.copy(self.maps[self.best]).extractParamMap()
        return spark.createDataFrame(sorted((p.name, str(v)) for p, v in params.items() if p.name in names), "param string, value string")

    def best_model(self):
        """Fitted on all rows when asked for."""
        with persisted(self.train):
            return self.est.fit(self.train, self.maps[self.best])


class SearchLog:
    """Metrics of one search, by (fold, point)."""

    def __init__(self, spark: SparkSession, key: str, root: str | None = None) -> None:
        self.spark, self.path = spark, os.path.join(root or os.path.join(checkpoint_root(spark), "search-log"), key)

    def finished(self) -> dict[tuple[int, int], float]:
        try:
            rows = self.spark.read.schema(SCHEMA).parquet(self.path).collect()  # folds * points rows
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {(r["fold"], r["point"]): r["metric"] for r in rows}

    def add(self, fold: int, point: int, metric: float) -> None:
        """A folder of its own for each metric: fits that end together do not meet."""
        one = self.spark.createDataFrame([(float(metric),)], "metric double").coalesce(1)
        one.write.mode("overwrite").parquet(os.path.join(self.path, f"fold={fold}", f"point={point}"))


def _for_fits(est, seen: DataFrame, beside: int) -> DataFrame:
    """The rows as a forest's fit takes them, so many fits at once: every part sends on the counts of all nodes of a level, so no more parts than keep to
    ROWS_PER_PART rows and give each fit its share of the cluster."""
    if not isinstance(est, FOREST_LEARNERS):
        return seen
    return seen.coalesce(max(1, -(-seen.count() // ROWS_PER_PART), -(-seen.sparkSession.sparkContext.defaultParallelism // beside)))


def search(est, grid: Mapping[str, Sequence], train: DataFrame, log: SearchLog, evaluator=None, fold_col: str = "fold", num_folds: int = 3,
           parallelism: int = 1) -> Search:
    """The metrics of ``CrossValidator`` with the same folds; what the log has is not fitted again (``Search.fitted`` counts what was)."""
    evaluator = evaluator or auc_evaluator()
    maps = param_grid(est, grid)
    done = log.finished()
    spark, fitted = train.sparkSession, 0
    missing = {f: [i for i in range(len(maps)) if (f, i) not in done] for f in range(num_folds)}
    groups = {f: by_depth(est, maps, points) for f, points in missing.items() if points}

    @inheritable_thread_target(spark)
    def fit(points: list[int], seen: DataFrame) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"point-{points[0]}")
        return fitted_by_depth(est, maps, points, seen)

    @inheritable_thread_target(spark)
    def score(fold: int, i: int, model, held: DataFrame) -> tuple[int, int, float]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"point-{i}")
        metric = evaluator.evaluate(model().transform(held))
        log.add(fold, i, metric)
        return fold, i, metric

    threads = at_once(train, parallelism) if groups else 1
    if groups and isinstance(est, ForestClassifier) and train.count() > FOREST_ROWS:
        threads = min(threads, FORESTS_AT_ONCE)
    together = max(1, threads // max(map(len, groups.values()), default=1))
    folds = list(groups)
    for part in (folds[a : a + together] for a in range(0, len(folds), together)):
        with ExitStack() as kept:
            fits, scores = (kept.enter_context(ThreadPoolExecutor(threads)) for _ in range(2))
            beside = min(threads, sum(len(groups[f]) for f in part))
            rows = {f: (_for_fits(est, train.where(F.col(fold_col) != f), beside), train.where(F.col(fold_col) == f)) for f in part}
            for df in (df for both in rows.values() for df in both):
                kept.enter_context(persisted(df))
            try:
                fitting = {fits.submit(fit, points, rows[f][0]): f for f in part for points in groups[f]}
                scored = [scores.submit(score, fitting[found], i, model, rows[fitting[found]][1])
                          for found in as_completed(fitting) for i, model in found.result().items()]
                for f, i, metric in (s.result() for s in as_completed(scored)):
                    done[f, i] = metric
                    fitted += 1
            except BaseException:
                for pool in (fits, scores):
                    pool.shutdown(cancel_futures=True)  # waits for those that run
                raise
    return Search(est, maps, [[done[f, i] for f in range(num_folds)] for i in range(len(maps))], evaluator.isLargerBetter(), train, fitted)

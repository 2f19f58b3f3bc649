"""A table of runs: how long each model took to fit and to score, and over how many rows.

The frame of a step is kept and counted before its clock starts, so that times are those of the model and not of what made its input; the clock is the
driver's, around the whole step.  (``Observation`` would count on the way, but a session that has used one can no longer send fitted
classifiers with a summary to its tasks: Spark 4.1 keeps the session in the summary.)  Rows are appended to a table in the shared folder.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablefit.operators.models import persisted

SCHEMA = "run string, model string, step string, n_rows long, seconds double"


class Runs:
    """Measures fits and scores of one comparison; ``write`` appends what was measured."""

    def __init__(self, spark: SparkSession, run: str) -> None:
        self.spark, self.run = spark, run
        self.rows: list[tuple[str, str, str, int, float]] = []

    def _measured(self, model: str, step: str, df: DataFrame, act):
        with persisted(df):
            n = df.count()
            began = time.perf_counter()
            out = act(df)
            self.rows.append((self.run, model, step, n, time.perf_counter() - began))
        return out

    def fit(self, model: str, est, train: DataFrame):
        return self._measured(model, "fit", train, est.fit)

    def score(self, model: str, fitted, test: DataFrame) -> None:
        """Scores all rows, keeping none."""
        self._measured(model, "score", test, lambda df: fitted.transform(df).write.format("noop").mode("overwrite").save())

    def write(self, path: str) -> DataFrame:
        self.spark.createDataFrame(self.rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        self.rows = []
        return self.spark.read.schema(SCHEMA).parquet(path)


def speeds(runs: DataFrame) -> DataFrame:
    """(model, fit_seconds, score_seconds): medians over the runs."""
    one = [F.percentile_approx(F.when(F.col("step") == s, F.col("seconds")), 0.5).alias(f"{s}_seconds") for s in ("fit", "score")]
    return runs.groupBy("model").agg(*one)


def leaderboard_with_speed(board: DataFrame, runs: DataFrame, metric: str, larger_is_better: bool = True, digits: int = 10) -> DataFrame:
    """A board of one row for each model, best metric first (to ``digits`` digits), then the faster fit, then the name; with both times."""
    value = F.round(F.col(metric), digits)
    order = [value.desc_nulls_last() if larger_is_better else value.asc_nulls_last(), F.col("fit_seconds").asc_nulls_last(), F.asc("model")]
    joined = board.drop("rank", "ranked_by").join(F.broadcast(speeds(runs)), "model", "left")  # one row for each model
    return joined.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")

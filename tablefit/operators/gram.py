"""Linear regression and its whole cross-validation from one pass of sums.

One scan adds up Z'Z for each fold, Z = [1, x - shift, y - shift]; a training set is all folds but one, so its sums are the total less that fold's.
Every (fold, grid point) is then solved on d x d numbers: ridge directly, elastic net by coordinate descent.  The error on a held-out
fold is a quadratic form in that fold's own sums, so no fit and no metric reads the data again.  The shift (the means, from a scan before)
keeps the sums small where a column's mean is large against its deviation.

The solutions are those of ``pyspark.ml.regression.LinearRegression`` (features and label in units of their deviation, intercept free).
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.operators.partials import as_array, collected, matrix, sum_by_key
from tablefit.operators.tune import best_point

#: (d + 2)^2 sums of each fold are held by every task.
MAX_DIMENSION = 2_000
SWEEPS = 10_000


@dataclass(frozen=True)
class FoldGram:
    """``sums[f]``: Z'Z over the rows of fold f; ``shift``: what was taken from the features, then from the label."""

    sums: dict[int, np.ndarray]
    shift: np.ndarray

    @property
    def total(self) -> np.ndarray:
        return sum(self.sums.values())

    def without(self, fold: int | None) -> np.ndarray:
        return self.total if fold is None else self.total - self.sums[fold]


@dataclass(frozen=True)
class LinearFit:
    coefficients: np.ndarray
    intercept: float


def fold_gram(df: DataFrame, num_folds: int, features_col: str = "features", label_col: str = "label", fold_col: str = "fold") -> FoldGram:
    """The sums by fold; rows without a label, fold or features, or with a component that is null or NaN, are left out."""
    rows = usable_rows(df, features_col, label_col, fold_col)
    first = rows.select(F.size("x").alias("d")).head()
    d = first["d"] if first else 0
    if d > MAX_DIMENSION:
        raise ValueError(f"{d} features exceed {MAX_DIMENSION}")

    def means(batch):
        z = np.column_stack([np.ones(batch.num_rows), matrix(batch.column(0)), batch.column(1).to_numpy()])
        return {0: z.sum(axis=0)} if batch.num_rows else {}

    sums = collected(sum_by_key(rows, means), 1).get(0)
    shift = sums[1:] / sums[0] if sums is not None else np.zeros(d + 1)

    def products(batch):
        if not batch.num_rows:
            return {}
        z = np.column_stack([np.ones(batch.num_rows), np.column_stack([matrix(batch.column(0)), batch.column(1).to_numpy()]) - shift])
        fold = batch.column(2).to_numpy()
        return {int(f): z[fold == f].T @ z[fold == f] for f in np.unique(fold)}

    side = d + 2
    found = collected(sum_by_key(rows, products), num_folds)
    return FoldGram({f: found[f].reshape(side, side) if f in found else np.zeros((side, side)) for f in range(num_folds)}, shift)


def usable_rows(df: DataFrame, features_col: str, label_col: str, fold_col: str) -> DataFrame:
    """(x, y, fold) of the rows that have them."""
    rows = df.select(as_array(df, features_col).alias("x"), F.col(label_col).cast("double").alias("y"), F.col(fold_col).cast("int").alias("fold"))
    return rows.where(F.col("fold").isNotNull() & F.col("y").isNotNull() & ~F.isnan("y") & F.col("x").isNotNull()
                      & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))


def solve(sums: np.ndarray, shift: np.ndarray, reg: float = 0.0, alpha: float = 0.0) -> LinearFit:
    """The model of a set of rows from its sums."""
    n, d = sums[0, 0], len(shift) - 1
    if n <= 0:
        raise ValueError("no rows to fit")
    mean = sums[0, 1:] / n
    spread = (sums[1:, 1:] - n * np.outer(mean, mean)) / n
    deviation = np.sqrt(np.maximum(np.diag(spread), 0.0))
    used = np.flatnonzero(deviation[:d] > 1e-12 * (1 + np.abs(mean[:d] + shift[:d])))
    w = np.zeros(d)
    if len(used) and deviation[d] > 0:
        scale = deviation[used]
        a = spread[np.ix_(used, used)] / np.outer(scale, scale)
        b = spread[used, d] / (scale * deviation[d])
        strength = reg / deviation[d]  # the label is in units of its deviation, too
        w[used] = penalised(a, b, strength * (1 - alpha), strength * alpha) * deviation[d] / scale
    centre = mean + shift
    return LinearFit(w, float(centre[d] - w @ centre[:d]))


def penalised(a: np.ndarray, b: np.ndarray, l2: float, l1: float, start: np.ndarray | None = None, free: int | None = None) -> np.ndarray:
    """argmin u'au / 2 - b'u + l2 |u|^2 / 2 + l1 |u|_1; the entry ``free`` is not penalised."""
    weight = np.ones(len(b))
    if free is not None:
        weight[free] = 0.0
    h = a + np.diag(l2 * weight)
    if l1 == 0:
        return np.linalg.lstsq(h, b, rcond=1e-12)[0]
    u = np.zeros(len(b)) if start is None else start.copy()
    rest = b - h @ u
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(b)):
            if h[j, j] <= 0:
                continue
            z = rest[j] + h[j, j] * u[j]
            new = np.sign(z) * max(abs(z) - l1 * weight[j], 0.0) / h[j, j]
            if new != u[j]:
                rest -= h[:, j] * (new - u[j])
                moved = max(moved, abs(new - u[j]))
                u[j] = new
        if moved < 1e-14:
            break
    return u


def squared_error(fit: LinearFit, sums: np.ndarray, shift: np.ndarray) -> float:
    """Sum of squared errors over the rows of the sums."""
    v = np.concatenate(([shift[-1] - fit.intercept - fit.coefficients @ shift[:-1]], -fit.coefficients, [1.0]))
    return float(max(v @ sums @ v, 0.0))


@dataclass(frozen=True)
class GridSearch:
    """Metrics by grid point and fold, the best point and its model over all rows."""

    points: list[dict]
    metrics: np.ndarray
    best: int
    fits: list

    @property
    def best_fit(self):
        return self.fits[self.best]

    def results(self, spark: SparkSession) -> DataFrame:
        """One row for each grid point, as ``tune.cv_results``."""
        rows = [(i, json.dumps(dict(sorted(p.items()))), float(m.mean()), float(m.std()), i == self.best) for i, (p, m) in enumerate(zip(self.points, self.metrics, strict=True))]
        return spark.createDataFrame(rows, "point int, params string, mean_metric double, std_metric double, is_best boolean")

    def by_fold(self, spark: SparkSession) -> DataFrame:
        rows = [(i, f, float(x)) for i, m in enumerate(self.metrics) for f, x in enumerate(m)]
        return spark.createDataFrame(rows, "point int, fold int, metric double")


def grid_points(grid: Mapping[str, Sequence[float]]) -> list[dict]:
    """The points of a grid in the order of ``ParamGridBuilder``: the first name varies slowest."""
    unknown = set(grid) - {"regParam", "elasticNetParam"}
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def search_linear(df: DataFrame, grid: Mapping[str, Sequence[float]], num_folds: int, features_col: str = "features", label_col: str = "label",
                  fold_col: str = "fold") -> GridSearch:
    """Cross-validation of linear regression over ``regParam`` and ``elasticNetParam`` by root mean squared error, from two scans in all."""
    gram = fold_gram(df, num_folds, features_col, label_col, fold_col)
    points = grid_points(grid)
    metrics = np.full((len(points), num_folds), np.nan)
    for i, p in enumerate(points):
        for f in range(num_folds):
            if gram.sums[f][0, 0] and gram.without(f)[0, 0]:
                fit = solve(gram.without(f), gram.shift, p.get("regParam", 0.0), p.get("elasticNetParam", 0.0))
                metrics[i, f] = np.sqrt(squared_error(fit, gram.sums[f], gram.shift) / gram.sums[f][0, 0])
    best = best_point([float(m.mean()) for m in metrics], False)
    fits = [solve(gram.total, gram.shift, p.get("regParam", 0.0), p.get("elasticNetParam", 0.0)) for p in points]
    return GridSearch(points, metrics, best, fits)

"""Logistic regression over a whole grid and all folds at once.

Every (fold, grid point) has coefficients of its own, and so has every point over all rows.  One scan a step adds up, for all of them together,
the loss, gradient and Hessian over their training rows; the driver takes a Newton step for each (by coordinate descent where there is an
absolute-value penalty) and halves it where the loss has grown.  Models that have settled leave the sums.  A search costs as many scans as the
slowest model has steps, instead of a fit for each model.

The solutions are those that ``pyspark.ml.classification.LogisticRegression`` converges to (features in units of their deviation, intercept free).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.operators.evaluate import auc
from tablefit.operators.gram import FoldGram, GridSearch, LinearFit, fold_gram, grid_points, penalised, usable_rows
from tablefit.operators.models import persisted
from tablefit.operators.partials import collected, matrix, sum_by_key
from tablefit.operators.tune import best_point

#: Doubles that a task may hold: models * (d + 1)^2.
MAX_STATE = 16_000_000
MAX_STEPS = 60
HALVINGS = 30


@dataclass
class _Model:
    """One (fold, point): its penalty, scale, current point u (intercept first, in units of the deviations) and the step on trial."""

    fold: int | None
    l1: float
    l2: float
    scale: np.ndarray
    rows: float
    u: np.ndarray
    value: float = np.inf
    step: np.ndarray | None = None
    size: float = 1.0
    done: bool = False
    halved: int = 0
    at: tuple = field(default_factory=tuple)

    @property
    def trial(self) -> np.ndarray:
        return self.u if self.step is None else self.u + self.size * self.step

    def weights(self, u: np.ndarray) -> np.ndarray:
        """Intercept and coefficients of the shifted features."""
        return np.concatenate((u[:1], u[1:] / self.scale))

    def penalty(self, u: np.ndarray) -> float:
        return self.l1 * np.abs(u[1:]).sum() + self.l2 / 2 * (u[1:] ** 2).sum()

    def learn(self, sums: np.ndarray, tolerance: float) -> None:
        """Takes in the sums at the trial point, and sets the next one."""
        side = len(self.u)
        u = self.trial
        value = sums[0] / self.rows + self.penalty(u)
        if self.step is not None and not value <= self.value + 1e-13 * abs(self.value) and self.halved < HALVINGS:
            self.size /= 2
            self.halved += 1
            return
        by = np.concatenate(([1.0], self.scale))
        gradient = sums[1 : 1 + side] / self.rows / by
        hessian = sums[1 + side :].reshape(side, side) / self.rows / np.outer(by, by)
        self.u, self.value, self.size, self.halved = u, value, 1.0, 0
        # the model of the loss around u, in the new point: a quadratic with the penalty as it is
        new = penalised(hessian, hessian @ u - gradient, self.l2, self.l1, start=u, free=0)
        self.step = new - u
        self.done = bool(np.abs(self.step).max() < tolerance)


def _models(gram: FoldGram, points: list[dict], num_folds: int) -> list[_Model]:
    d = len(gram.shift) - 1
    out = []
    for fold in [*range(num_folds), None]:
        sums = gram.without(fold)
        n = sums[0, 0]
        if not n:
            raise ValueError(f"fold {fold} leaves no rows to fit")
        mean = sums[0, 1 : d + 1] / n
        variance = np.maximum(np.diag(sums)[1 : d + 1] - n * mean**2, 0.0) / max(n - 1, 1)
        constant = variance <= 1e-18 * (1 + gram.shift[:d] ** 2)
        scale = np.where(constant, np.inf, np.sqrt(variance))  # a constant feature has no coefficient
        rate = np.clip(gram.shift[d] + sums[0, d + 1] / n, 1e-12, 1 - 1e-12)
        for p in points:
            reg, alpha = p.get("regParam", 0.0), p.get("elasticNetParam", 0.0)
            out.append(_Model(fold, reg * alpha, reg * (1 - alpha), scale, n, np.concatenate(([np.log(rate / (1 - rate))], np.zeros(d)))))
    return out


def search_logistic(df: DataFrame, grid: Mapping[str, Sequence[float]], num_folds: int, features_col: str = "features", label_col: str = "label",
                    fold_col: str = "fold", tolerance: float = 1e-9, max_steps: int = MAX_STEPS) -> tuple[GridSearch, list[list[LinearFit]]]:
    """Cross-validation of logistic regression over ``regParam`` and ``elasticNetParam`` by the exact area under ROC.

    Returns the search and the models of each fold by grid point.  Labels are 0 or 1; rows without a label, fold or features are left out.
    Needs models * (d + 1)^2 doubles in each task, MAX_STATE at most.
    """
    points = grid_points(grid)
    rows = usable_rows(df, features_col, label_col, fold_col)
    with persisted(rows):
        gram = fold_gram(rows, num_folds, "x", "y", "fold")
        d = len(gram.shift) - 1
        if len(points) * (num_folds + 1) * (d + 1) ** 2 > MAX_STATE:
            raise ValueError(f"{len(points)} points, {num_folds} folds and {d} features exceed {MAX_STATE} doubles a task")
        models = _models(gram, points, num_folds)
        for _ in range(max_steps):
            active = {i: m for i, m in enumerate(models) if not m.done}
            if not active:
                break
            sums = collected(sum_by_key(rows, _step_of({i: (m.fold, m.weights(m.trial)) for i, m in active.items()}, gram.shift[:d])), len(models))
            for i, m in active.items():
                m.learn(sums[i], tolerance)
        else:
            raise RuntimeError(f"{sum(not m.done for m in models)} of {len(models)} models did not settle in {max_steps} steps")
        fits = [_plain(m, gram.shift[:d]) for m in models]
        by_fold = [fits[f * len(points) : (f + 1) * len(points)] for f in range(num_folds)]
        found = {(r["point"], r["fold"]): r["auc"] for r in auc(_held_out(rows, by_fold), label="y", score="score", group_by=["point", "fold"]).collect()}
    metrics = np.array([[found.get((i, f)) if found.get((i, f)) is not None else np.nan for f in range(num_folds)] for i in range(len(points))], dtype=float)
    best = best_point([float(m.mean()) for m in metrics], True)
    return GridSearch(points, metrics, best, fits[num_folds * len(points) :]), by_fold


def _plain(m: _Model, shift: np.ndarray) -> LinearFit:
    w = m.weights(m.trial if m.step is not None and m.done else m.u)
    return LinearFit(w[1:], float(w[0] - w[1:] @ shift))


def _step_of(weights: dict[int, tuple[int | None, np.ndarray]], shift: np.ndarray):
    """Loss, gradient and Hessian of each model over the rows of a batch that it is fitted on."""

    def step(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        if not batch.num_rows:
            return {}
        z = np.column_stack([np.ones(batch.num_rows), matrix(batch.column(0)) - shift])
        y, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        out: dict[int, np.ndarray] = {}
        for own in {f for f, _ in weights.values()}:
            seen = slice(None) if own is None else fold != own
            x, label = z[seen], y[seen]
            for i, (f, w) in weights.items():
                if f == own:
                    margin = x @ w
                    p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
                    loss = (np.logaddexp(0, margin) - label * margin).sum()
                    hessian = (x * (p * (1 - p))[:, None]).T @ x
                    out[i] = np.concatenate(([loss], x.T @ (p - label), hessian.ravel()))
        return out

    return step


def _held_out(rows: DataFrame, by_fold: list[list[LinearFit]]) -> DataFrame:
    """(point, fold, y, score): each row's margin by the models of its own fold, which have not seen it."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, fold = matrix(batch.column(0)), batch.column(2).to_numpy()
            scores = np.zeros((batch.num_rows, len(by_fold[0])))
            for f in np.unique(fold):
                own = x[fold == f]
                for i, fit in enumerate(by_fold[f]):
                    # row by row sums: equal rows get equal scores, wherever they stand
                    scores[fold == f, i] = (own * fit.coefficients).sum(axis=1) + fit.intercept
            lists = pa.FixedSizeListArray.from_arrays(pa.array(scores.ravel()), scores.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), lists], names=["fold", "y", "scores"])

    wide = rows.mapInArrow(run, "fold int, y double, scores array<double>")
    return wide.select("fold", "y", F.posexplode("scores").alias("point", "score"))

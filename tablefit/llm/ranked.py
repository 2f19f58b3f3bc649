"""The first few of each row of a score matrix, and their merge: the heaps of the operators that rank."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablefit.llm.common import quoted

#: Of no score: what is masked out.
NONE = np.iinfo(np.int64).min


def first_of_rows(scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` largest scores of each row, larger first, ties by column; masked ones (NONE) never."""
    if not scores.size:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    least = np.partition(scores, -most, axis=1)[:, -most] if scores.shape[1] > most else np.full(len(scores), NONE)
    row, col = np.nonzero((scores >= least[:, None]) & (scores != NONE))
    return first_of_groups(row, scores[row, col], col, most, row, col)


def first_of_groups(group: np.ndarray, score: np.ndarray, tie: np.ndarray, most: int, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The columns at the ``most`` best entries of each group: larger scores first, then smaller ``tie``."""
    order = np.lexsort((tie, -score, group))
    ranked = group[order]
    fresh = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(ranked)])
    place = np.arange(len(ranked)) - np.repeat(fresh, np.diff(np.concatenate((fresh, [len(ranked)]))))
    order = order[place < most]
    return tuple(c[order] for c in columns)


class Heap:
    """The best entries of each group so far; ``add`` merges more into them."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.group = self.score = self.id = np.empty(0, dtype=np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        given = [np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids))]
        self.group, self.score, self.id = first_of_groups(*given, self.most, *given)


def merged(parts: DataFrame, by: list[str], order: list, most: int, rank: str = "rank", ways: int = 64) -> DataFrame:
    """The first ``most`` rows of each group of ``by``, with their rank from 1.

    Merged in two steps, so that what many tasks found for one group does not meet in one task at once: first within
    (group, one of ``ways`` sets of tasks), then within the group.
    """
    keys = [quoted(c) for c in by]
    some = parts.withColumn("__way", F.pmod(F.spark_partition_id(), F.lit(ways)))
    some = some.withColumn(rank, F.row_number().over(Window.partitionBy(*keys, "__way").orderBy(*order))).where(F.col(rank) <= most)
    return some.drop("__way").withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= most)

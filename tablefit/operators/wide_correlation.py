"""Pearson correlations of wide tables, pair by pair of column blocks.

Columns are cut into blocks; the sums of a pair of blocks are one array that a task adds up over its rows, reading only these columns.  Means of all columns come
from a scan before, so the sums are of centred values.  Each pair of columns is taken over the rows that have both values, by products of the
blocks' 0/1 masks.  The result is long, one row for each pair; nothing of size d x d exists anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.operators.partials import sum_by_key

#: Columns of a block; a task holds six sums of BLOCK x BLOCK.
BLOCK = 256
PARTS = 6


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) if batch.num_columns else np.empty((batch.num_rows, 0))


def _doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])


def column_means(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> np.ndarray:
    """Means of the valid values, block by block; 0 for a column without any."""
    out = np.zeros(len(cols))
    for at in range(0, len(cols), 16 * block):
        part = cols[at : at + 16 * block]

        def step(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
            x = _values(batch)
            return {0: np.stack([np.nansum(x, axis=0), (~np.isnan(x)).sum(axis=0)])}

        for r in sum_by_key(_doubles(df, part), step).collect():  # one row
            total, n = np.frombuffer(bytes(r["sums"])).reshape(2, -1)
            out[at : at + len(part)] = total / np.maximum(n, 1)
    return out


def correlation_wide(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(x, y, corr, n) of each pair of columns, x before y in ``cols``, and of each column with itself.

    ``n`` counts the rows with both values; ``corr`` is null where fewer than two are, or where a column does not vary over them.  Nulls
    and NaN are no values.
    """
    cols = list(cols)
    if len(set(cols)) != len(cols):
        raise ValueError("a column is named twice")
    means = column_means(df, cols, block)
    starts = range(0, len(cols), block)
    pairs = [_pair(df, cols[i : i + block], cols[j : j + block], means[i : i + block], means[j : j + block], i == j) for i in starts for j in starts if i <= j]
    return reduce(DataFrame.unionAll, pairs)


def _pair(df: DataFrame, left: list[str], right: list[str], left_means: np.ndarray, right_means: np.ndarray, same: bool) -> DataFrame:
    """Rows of one pair of blocks."""
    k = len(left)
    centre = left_means if same else np.concatenate((left_means, right_means))

    def step(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
        x = _values(batch) - centre
        have = (~np.isnan(x)).astype(np.float64)
        x = np.where(have > 0, x, 0.0)
        a, b, ha, hb = (x, x, have, have) if same else (x[:, :k], x[:, k:], have[:, :k], have[:, k:])
        return {0: np.stack([ha.T @ hb, a.T @ hb, ha.T @ b, (a * a).T @ hb, ha.T @ (b * b), a.T @ b])}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sums in batch.column(1).to_pylist():
                n, sa, sb, saa, sbb, sab = np.frombuffer(sums).reshape(PARTS, k, len(right))
                some = np.maximum(n, 1)
                va, vb, cov = saa - sa * sa / some, sbb - sb * sb / some, sab - sa * sb / some
                # what rounding leaves of a column that does not vary
                flat = (va <= 1e-13 * saa) | (vb <= 1e-13 * sbb) | (n < 2)
                corr = np.clip(cov / np.where(flat, 1.0, np.sqrt(np.maximum(va * vb, 0))), -1.0, 1.0)
                i, j = np.nonzero(np.triu(np.ones((k, len(right)), dtype=bool)) if same else np.ones((k, len(right)), dtype=bool))
                names = [pa.array(left).take(pa.array(i)), pa.array(right).take(pa.array(j))]
                yield pa.RecordBatch.from_arrays([*names, pa.array(corr[i, j], mask=flat[i, j]), pa.array(n[i, j].astype(np.int64))], names=["x", "y", "corr", "n"])

    sums = sum_by_key(_doubles(df, left if same else [*left, *right]), step)
    return sums.mapInArrow(pairs, "x string, y string, corr double, n long")

"""Train/test splits and cross-validation folds.

The default is a *hash* split: a row's side depends only on its key
(``md5(key)`` -> bucket), so it is reproducible across runs, partitionings and
engines, costs no shuffle (a per-row expression, pushed into the scan's
codegen stage), and a re-executed task after an executor loss assigns exactly
the same rows.  ``randomSplit`` is kept as an option; even seeded, its result
depends on the partitioning of its input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.functions.expr import as_col, hash_bucket, hex_hash

SPLIT_BUCKETS = 100
HASHES = 2 ** 32


def _key(key: str | Column) -> Column:
    """A null key hashes like the empty string: all rows with one are in the same part."""
    return F.coalesce(as_col(key).cast("string"), F.lit(""))


def split_bucket(key: str | Column, buckets: int = SPLIT_BUCKETS, tag: str | None = None) -> Column:
    """Position of the key's hash among ``buckets`` equal ranges (0 .. buckets - 1)."""
    return F.shiftright(hex_hash(_key(key), tag) * F.lit(buckets), 32).cast("int")


def _in_train(key: str | Column, train_fraction: float, tag: str | None) -> Column:
    if not 0.0 <= train_fraction <= 1.0:
        raise ValueError("train_fraction must be in [0, 1]")
    return hex_hash(_key(key), tag) < F.lit(train_fraction * HASHES)


def with_split(df: DataFrame, key: str, train_fraction: float = 0.8, col: str = "split",
               tag: str | None = None) -> DataFrame:
    """Add ``split`` = 'train' / 'test': train where the key's 32-bit hash is below that fraction of all hashes."""
    return df.withColumn(col, F.when(_in_train(key, train_fraction, tag), F.lit("train")).otherwise(F.lit("test")))


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8,
               tag: str | None = None) -> tuple[DataFrame, DataFrame]:
    train = _in_train(key, train_fraction, tag)
    return df.where(train), df.where(~train)


def with_folds(df: DataFrame, key: str, k: int, col: str = "fold", tag: str = "fold") -> DataFrame:
    """Add an INT fold id in [0, k) from the key's hash (for ``CrossValidator(foldCol=...)``)."""
    return df.withColumn(col, hash_bucket(_key(key), k, tag))


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2),
                 seed: int | None = None) -> list[DataFrame]:
    """Spark's sampling split (not reproducible across partitionings)."""
    return df.randomSplit(list(weights), seed)

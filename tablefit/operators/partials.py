"""Sums of matrices over all rows of a frame: each task adds up its own, and these are added in two more steps.

``sum_by_key`` is what ``treeAggregate`` is for vectors: numpy works on whole Arrow batches, a task passes on one row for each key, and
no task adds more rows of a key than there are tasks in one of WAYS sets, then WAYS.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import tablefit.operators

# tasks get these functions with their code, whether or not the library is installed on the executors
cloudpickle.register_pickle_by_value(tablefit.operators)

#: Sets of tasks whose sums are added first.
WAYS = 256


def sum_by_key(rows: DataFrame, step: Callable[[pa.RecordBatch], dict[int, np.ndarray]], ways: int = WAYS) -> DataFrame:
    """(key int, sums binary) of all that ``step`` gives for the batches: float64 arrays by key, added up.

    A task holds one array for each key that it meets; the caller bounds both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, value in step(batch).items():
                value = np.asarray(value, dtype=np.float64).ravel()
                held[key] = held[key] + value if key in held else value
        yield _rows(held)

    def add(group: pa.Table) -> pa.Table:
        key = group.column("key")[0].as_py()
        total = 0.0
        for b in group.column("sums").to_pylist():
            total = total + np.frombuffer(b)
        return pa.Table.from_batches([_rows({key: total})])

    parts = rows.mapInArrow(run, "key int, sums binary").withColumn("way", F.pmod(F.spark_partition_id(), F.lit(ways)))
    some = parts.groupBy("key", "way").applyInArrow(lambda g: add(g.drop_columns(["way"])), "key int, sums binary")
    return some.groupBy("key").applyInArrow(add, "key int, sums binary")


def _rows(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["key", "sums"])


def collected(sums: DataFrame, most: int) -> dict[int, np.ndarray]:
    """The sums of at most ``most`` keys, on the driver."""
    out = {r["key"]: np.frombuffer(bytes(r["sums"])) for r in sums.limit(most + 1).collect()}
    if len(out) > most:
        raise ValueError(f"more than {most} keys")
    return out


def as_array(df: DataFrame, name: str) -> Column:
    """A vector or array column as an array of doubles."""
    return vector_to_array(F.col(name)) if isinstance(df.schema[name].dataType, VectorUDT) else F.col(name).cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of arrays of one length as a matrix."""
    if not len(column):
        return np.empty((0, 0))
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(values) % len(column) or column.null_count:
        raise ValueError("vectors of different lengths, or null ones")
    return values.reshape(len(column), -1)

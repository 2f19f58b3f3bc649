"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tablefit.llm
from tablefit.session import scratch_path

# tasks get this subpackage's functions with their code, whether or not the library is installed on the executors
cloudpickle.register_pickle_by_value(tablefit.llm)

#: Rows and bytes handed to a Python worker at once: one batch must fit beside the worker's own state whatever the
#: length of the texts (a single longer text still arrives whole).
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches bounded by rows and bytes, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, UPPER.lower())


def map_text(
    df: DataFrame,
    text_col: str,
    added: T.StructType,
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    carry: list[str] | None = None,
) -> DataFrame:
    """Append columns computed from whole texts, one Arrow batch at a time.

    ``make()`` runs once in each task and returns the function from a batch's texts to one Arrow array for
    each field of ``added``; it may keep bounded state between batches.  ``carry`` names the input columns that are kept
    (all by default); an added field takes the place of a carried one of the same name.
    """
    bound_batches(df.sparkSession)
    names = [f.name for f in added.fields]
    kept = [c for c in (df.columns if carry is None else carry) if c not in names]
    own = text_col in kept and df.schema[text_col].dataType == T.StringType()  # else the text travels beside the carried columns
    # plain names on the way: a task cannot take a column whose name has a dot
    given = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)],
                      *([] if own else [quoted(text_col).cast("string").alias(f"c{len(kept)}")]))
    at = kept.index(text_col) if own else len(kept)
    schema = T.StructType([*given.schema.fields[: len(kept)], *[T.StructField(f"f{i}", f.dataType) for i, f in enumerate(added.fields)]])
    passed = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            if batch.num_rows:
                out = fn(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed) - len(out)], *out], names=passed)

    return given.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(passed, [*kept, *names], strict=True)])


def hand_out(spark: SparkSession, data):
    """Broadcast of plain data of a size that the caller bounds, for ``in_worker``."""
    return spark.sparkContext.broadcast({"data": data})


def in_worker(shared, build: Callable):
    """``build(data)``, once for each worker process: what it remembers serves all tasks that the process runs."""
    held = shared.value
    if "made" not in held:
        held["made"] = build(held["data"])
    return held["made"]


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a compressed table in the shared folder, read again: what it took to make it is not repeated, nor lost with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.toDF(*[f"c{i}" for i in range(len(df.columns))]).write.parquet(path)  # plain names, whatever the columns are called
    return df.sparkSession.read.parquet(path).toDF(*df.columns)


def quoted(name: str) -> Column:
    """A column by its literal name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")

"""Table loading: parquet (the default), CSV with explicit schema or inference,
and the CSV writer used for round trips."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer_schema: bool | None = None,
    **options,
) -> DataFrame:
    """Read one table; ``options`` go to the reader (quote, escape, nullValue, multiLine, mode, ...).

    CSV: with ``schema`` given, no inference job runs (production route);
    without it the header names the columns and types are inferred by a
    separate pass over the file (the route of an exploratory session).  With
    a schema and a header, columns are taken by their header names, in whatever
    order the file has them, and a value that is not of its type fails the
    read; without a header they go by position, malformed lines failing
    unless ``mode`` says otherwise.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", header).option("sep", sep)
        if schema is None:
            reader = reader.option("inferSchema", True if infer_schema is None else infer_schema)
        elif header:
            wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
            named = reader.option("inferSchema", False).load(path)
            absent = [f.name for f in wanted.fields if f.name not in named.columns]
            if absent:
                raise KeyError(f"no column {absent} in the header {named.columns}")
            return named.select(*[F.col("`" + f.name.replace("`", "``") + "`").cast(f.dataType).alias(f.name) for f in wanted.fields])
        elif "mode" not in options:
            reader = reader.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def load(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One of the driver tables, e.g. ``load(spark, '/root/testdata/sf0.01', 'orders')``."""
    return spark.read.parquet(table_path(base_dir, name))


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    """Write a frame as CSV parts under ``path`` (a fresh shared-folder path)."""
    df.write.mode("errorifexists").option("header", header).option("sep", sep).csv(path)
    return path


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``key`` when it has fewer partitions than the
    cluster can run at once; otherwise return it unchanged.

    A table stored as one file with one row group is scanned by a single task,
    and a CPU-heavy projection after it (e.g. dozens of hashes per row) would
    then run serially.  At scale the scan is split by row groups into many
    tasks and this is a no-op (the check only plans, it runs no job).
    Partitioning by the key keeps re-executed tasks deterministic.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key)


#: Rows of a table about to become wide that one task shall hold.
ROWS_PER_PART = 500_000


def spread_rows(df: DataFrame, rows: int, per_part: int = ROWS_PER_PART, least: int | None = None) -> DataFrame:
    """Hash-partition ``df``, of about ``rows`` rows, into parts of about ``per_part`` rows where that makes more parts than the cluster
    can run at once; otherwise return it unchanged.  With ``least``, fewer rows are dealt over the cluster, too, at least that many to a part.

    Adaptive execution sizes the parts of a join by its narrow rows; what is computed from them later (one-hot vectors, binned copies of them in
    tree fits) takes many times their room, and a fixed number of parts would grow with the table.
    """
    parts, cores = -(-rows // per_part), df.sparkSession.sparkContext.defaultParallelism
    if parts <= cores:
        parts = max(parts, min(cores, rows // least)) if least else 1
    return df if parts <= 1 else df.repartition(parts, *df.columns)

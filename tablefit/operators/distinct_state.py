"""Distinct counts that are kept by part of a table and merged.

Each part (a day, a folder, a load) has one small sketch for each column.  A new or rewritten part is counted alone, its sketches replace those of
that part only, and the table's distinct counts are a union of sketches: no row of another part is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

#: log2 of a sketch's registers: a relative standard error of about 1.04 / 2^(LG_K / 2).
LG_K = 14


def error_bound(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error that an estimate keeps within, for so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def distinct_states(df: DataFrame, part_col: str, cols: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """(part string, column_name, sketch): the state of each column in each part; nulls are not counted, a null part is the part ''."""
    def value(c: str):
        kind = df.schema[c].dataType
        return F.col(c).cast("long") if isinstance(kind, IntegralType) else F.col(c) if isinstance(kind, StringType) else F.col(c).cast("string")

    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    # the sketches of many tasks are merged by part and salt, then by part
    salt = F.pmod(F.spark_partition_id(), F.lit(64)).alias("salt")
    some = df.groupBy(part, salt).agg(*[F.hll_sketch_agg(value(c), lg_k).alias(f"s{i}") for i, c in enumerate(cols)])
    wide = some.groupBy("part").agg(*[F.hll_union_agg(f"s{i}").alias(f"s{i}") for i in range(len(cols))])
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return wide.select("part", F.explode(each).alias("e")).select("part", "e.column_name", "e.sketch")


def save_states(states: DataFrame, path: str) -> None:
    """Writes the states; of parts that are there already, these take the place, and all others stay untouched."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def load_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column_name string, sketch binary, part string").parquet(path)


def merged_distinct(states: DataFrame) -> DataFrame:
    """(column_name, n_distinct): estimates over all parts."""
    return states.groupBy("column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))

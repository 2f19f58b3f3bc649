"""Indexing of string columns with any number of labels: the dictionary stays a table.

``StringIndexer`` brings its label list to the driver.  Here the labels are counted (partial sums before the shuffle), sorted by descending count, then
label, into ranges, and numbered within each; a running sum over one row for each range gives the offsets.  The ranges are written before they are numbered, so
a task that runs again sees the same ones.  Index 0 is the most frequent label, as there.

Rows meet their index in two joins: the first HOT labels, which may make up most rows, come as a broadcast of that bounded size; all other rows are
shuffled by label, and no such label is frequent enough to matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablefit.session import cut_lineage

#: Labels, most frequent ones first, whose rows are not shuffled.
HOT = 1_000


def label_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(label string, n, idx long): every label of the column with its count and index; nulls are no label."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(F.col(col).cast("string").alias("label")).where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ranges = cut_lineage(counts.repartitionByRange(n, F.desc("n"), F.asc("label")).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy(F.desc("n"), F.asc("label"))
    return (
        ranges.withColumn("place", F.row_number().over(within)).join(F.broadcast(offsets), "part")
        .select("label", "n", (F.col("offset") + F.col("place") - 1).alias("idx"))
    )


def with_index(df: DataFrame, col: str, dictionary: DataFrame, index_col: str, handle_invalid: str = "error", hot: int = HOT) -> DataFrame:
    """The rows with ``index_col`` (long): the label's index in the dictionary.

    A label that the dictionary has not, or a null one, fails the job (``error``), drops the row (``skip``) or gets the next index after all labels
    (``keep``), as in ``StringIndexer``.
    """
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"unknown handle_invalid {handle_invalid}")
    key, own, found = "__label", "__hot", "__idx"
    given = df.withColumn(key, F.col(col).cast("string"))
    first = dictionary.where(F.col("idx") < hot).select(F.col("label").alias(key), F.col("idx").alias(own))  # `hot` rows
    rest = dictionary.where(F.col("idx") >= hot).select(F.col("label").alias(key), F.col("idx").alias(found))
    split = given.join(F.broadcast(first), key, "left")
    direct = split.where(F.col(own).isNotNull() | F.col(key).isNull()).withColumn(found, F.lit(None).cast("long"))
    shuffled = split.where(F.col(own).isNull() & F.col(key).isNotNull()).join(rest, key, "left")
    both = direct.unionByName(shuffled).withColumn(index_col, F.coalesce(own, found))
    if handle_invalid == "skip":
        both = both.where(F.col(index_col).isNotNull())
    elif handle_invalid == "error":
        refused = F.raise_error(F.concat(F.lit(f"{col} has a label without an index: "), F.coalesce(key, F.lit("null"))))
        both = both.withColumn(index_col, F.when(F.col(index_col).isNotNull(), F.col(index_col)).otherwise(refused.cast("long")))
    else:
        size = dictionary.agg(F.count(F.lit(1)).alias("__size"))  # one row
        both = both.join(F.broadcast(size)).withColumn(index_col, F.coalesce(index_col, "__size"))
    return both.select(*[F.col(c) for c in df.columns if c != index_col], index_col)


def with_label(df: DataFrame, index_col: str, dictionary: DataFrame, label_col: str, hot: int = HOT) -> DataFrame:
    """The rows with the label of each index (null for an index that is none): the way back."""
    own, found = "__hot", "__label"
    first = dictionary.where(F.col("idx") < hot).select(F.col("idx").alias("__i"), F.col("label").alias(own))
    rest = dictionary.where(F.col("idx") >= hot).select(F.col("idx").alias("__j"), F.col("label").alias(found))
    split = df.join(F.broadcast(first), F.col(index_col).cast("long") == F.col("__i"), "left")
    direct = split.where(F.col(index_col) < hot).withColumn(found, F.lit(None).cast("string"))
    shuffled = split.where((F.col(index_col) >= hot) | F.col(index_col).isNull()).join(rest, F.col(index_col).cast("long") == F.col("__j"), "left").drop("__j")
    return direct.unionByName(shuffled).withColumn(label_col, F.coalesce(own, found)).select(*[c for c in df.columns if c != label_col], label_col)

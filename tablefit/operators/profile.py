"""Profiling: counts, summaries, group statistics, contingency tables, missing
values, distinct counts and correlation -- each as ONE aggregation job that
returns a (long-form) DataFrame.

Where an exploratory session launches one job per column (null counts), per
attribute (contingency tables) or per metric, these functions fold the work
into a single scan with partial (map-side) aggregation, so a hot key or a hot
category costs one partial row per map task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from tablefit.functions.expr import as_col, round_half_away

# Largest correlation matrix we bring to the driver (d x d doubles).
MAX_CORRELATION_COLUMNS = 1024
#: Columns of ``via="agg"``; ``wide_correlation`` has no such bound.
MAX_PAIRWISE_COLUMNS = 64


def _c(name: str) -> Column:
    """A column by its literal name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _long(wide: DataFrame, names: Sequence[str], rows: Sequence[Sequence[Column]]) -> DataFrame:
    """One row of aggregates to one row for each list of columns."""
    structs = [F.struct(*[x.alias(n) for n, x in zip(names, row, strict=True)]) for row in rows]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def where_count(df: DataFrame, predicate: str | Column, alias: str = "n_rows") -> DataFrame:
    """``where(predicate)`` then count; a null predicate drops the row."""
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(pred).agg(F.count(F.lit(1)).alias(alias))


def filtered_counts(df: DataFrame, predicates: Mapping[str, str | Column],
                    total_alias: str | None = "n_total") -> DataFrame:
    """Many filtered counts in one pass: ``count_if(pred)`` per named predicate."""
    aggs = [F.count(F.lit(1)).alias(total_alias)] if total_alias else []
    for name, pred in predicates.items():
        pred = F.expr(pred) if isinstance(pred, str) else pred
        aggs.append(F.count_if(pred).alias(name))
    return df.agg(*aggs)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows by an explicit order (top-k: per-partition heaps, then a
    merge of n rows per partition), so the preview is deterministic."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count / mean / sample stddev / min / max per column, numbers not strings.

    One aggregation over all columns, then unpivoted to one row
    per column: ``(column_name, count, mean, stddev, min, max)``.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = _c(c).try_cast("double")  # strings that are no numbers only count
        aggs += [
            F.count(_c(c)).alias(f"n{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"sd{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    wide = df.agg(*aggs)
    return _long(wide, ("column_name", "count", "mean", "stddev", "min", "max"),
                 [[F.lit(c), *[F.col(f"{n}{i}") for n in ("n", "mean", "sd", "min", "max")]] for i, c in enumerate(cols)])


def aggregate(df: DataFrame, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Global aggregates over different columns, e.g.
    ``[("max", "total_value", "max_value"), ("avg", "lines", "avg_lines")]``."""
    return df.agg(*[getattr(F, fn)(F.col(c)).alias(alias) for fn, c, alias in spec])


def category_counts(df: DataFrame, key: str, alias: str = "count") -> DataFrame:
    """Rows per value of ``key`` (null is its own group), most frequent first,
    ties by key so the order is total."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
            .orderBy(F.desc(alias), F.asc(key)))


def group_mean(df: DataFrame, key: str | Sequence[str], value: str, alias: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))


def group_mean_sql(spark: SparkSession, df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """The same as :func:`group_mean`, spelled in SQL over a parameterised frame
    (no global view name); both spellings resolve to the same plan."""
    return spark.sql(
        f"SELECT `{key}`, avg(`{value}`) AS `{alias}` FROM {{frame}} GROUP BY `{key}`",
        frame=df,
    )


def contingency(df: DataFrame, label: str, attributes: Sequence[str],
                alias: str = "count") -> DataFrame:
    """``label x attribute`` counts for several attributes in one job.

    The attributes are unpivoted to ``(attribute, value)`` and grouped once by
    ``(label, attribute, value)``; output ordered by label, attribute, value.
    """
    types = {df.schema[a].dataType for a in attributes}
    if len(types) == 1:
        values = [F.col(a) for a in attributes]
    else:
        values = [F.col(a).cast(StringType()).alias(a) for a in attributes]
    long = df.select(label, *values).unpivot(
        ids=[label], values=attributes, variableColumnName="attribute", valueColumnName="value"
    )
    # attributes of different types became strings: numbers among them still sort as numbers
    return (long.groupBy(label, "attribute", "value").agg(F.count(F.lit(1)).alias(alias))
            .orderBy(label, "attribute", *([F.col("value").try_cast("double")] if len(types) > 1 else []), "value"))


def missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN counts per column in one pass: ``(column_name, n_null, n_nan)``.

    NaN is counted separately: it is not null, yet ``Imputer`` treats it as
    missing.  Non-floating columns have ``n_nan = 0``.
    """
    cols = list(cols or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count_if(_c(c).isNull()).alias(f"nul{i}"))
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            aggs.append(F.count_if(F.isnan(_c(c))).alias(f"nan{i}"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"nan{i}"))
    wide = df.agg(*aggs)
    return _long(wide, ("column_name", "n_null", "n_nan"), [[F.lit(c), F.col(f"nul{i}"), F.col(f"nan{i}")] for i, c in enumerate(cols)])


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column: ``(column_name, n_distinct)``.

    Exact by default (Spark expands the rows once per column and de-duplicates
    with partial aggregation); ``approx=True`` uses HyperLogLog++ sketches,
    constant memory per column, for very wide or very large tables.
    """
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    wide = df.agg(*[fn(_c(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    return _long(wide, ("column_name", "n_distinct"), [[F.lit(c), F.col(f"d{i}")] for i, c in enumerate(cols)])


def correlation_long(df: DataFrame, cols: Sequence[str], method: str = "pearson",
                     via: str = "matrix") -> DataFrame:
    """Correlation matrix in long form ``(x, y, corr)``, d*d rows.

    ``via="matrix"``: assemble a vector and run ``Correlation.corr`` (one
    tree-aggregated job, any method Spark ML has, e.g. spearman); only the
    d x d result comes to the driver, and d is capped.
    ``via="agg"``: pairwise ``corr`` aggregates in one job (pearson only), no
    driver round trip; each pair is taken over the rows that have both values,
    the diagonal is 1.0 by definition, NaN for a column without values.
    ``via="matrix"`` needs nulls removed or imputed first (the assembler rejects them).
    """
    cols = list(cols)
    d = len(cols)
    if d > MAX_CORRELATION_COLUMNS:
        raise ValueError(f"{d} columns exceeds the correlation limit {MAX_CORRELATION_COLUMNS}")
    spark = df.sparkSession
    if via == "agg":
        if d > MAX_PAIRWISE_COLUMNS:  # d * (d - 1) / 2 aggregates in one plan
            raise ValueError(f"{d} columns exceed {MAX_PAIRWISE_COLUMNS} for pairwise aggregates; use correlation_wide")
        if method != "pearson":
            raise ValueError("via='agg' supports pearson only")
        aggs, pairs = [], []
        for i in range(d):
            for j in range(i + 1, d):
                x, y = _c(cols[i]).cast("double"), _c(cols[j]).cast("double")
                both = x.isNotNull() & y.isNotNull()
                x, y = F.when(both, x), F.when(both, y)
                # ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column
                aggs.append(F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
                            .alias(f"c{i}_{j}"))
                pairs.append((i, j))
        aggs += [(F.count(_c(c)) > 0).alias(f"v{i}") for i, c in enumerate(cols)]
        nan = F.lit(float("nan"))
        rows = [[F.lit(c), F.lit(c), F.when(F.col(f"v{i}"), 1.0).otherwise(nan)] for i, c in enumerate(cols)]
        rows += [[F.lit(cols[a]), F.lit(cols[b]), F.coalesce(f"c{i}_{j}", nan)] for i, j in pairs for a, b in ((i, j), (j, i))]
        return _long(df.agg(*aggs), ("x", "y", "corr"), rows)

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=cols, outputCol="_corr_vec").transform(df.select(*cols))
    matrix = Correlation.corr(vec, "_corr_vec", method).head()[0].toArray()
    rows = [(cols[i], cols[j], float(matrix[i, j])) for i in range(d) for j in range(d)]
    return spark.createDataFrame(rows, "x string, y string, corr double")


def correlation_blocks(df: DataFrame, blocks: Mapping[str, Sequence[str]],
                       method: str = "pearson") -> DataFrame:
    """Several correlation matrices over overlapping column blocks from ONE
    ``Correlation`` job on the union of their columns, sliced afterwards:
    ``(block, x, y, corr)``.  The union is capped like a single matrix."""
    union: list[str] = []
    for cols in blocks.values():
        union += [c for c in cols if c not in union]
    full = correlation_long(df, union, method=method, via="matrix")
    pairs = [(b, x, y) for b, cols in blocks.items() for x in cols for y in cols]
    wanted = df.sparkSession.createDataFrame(pairs, "block string, x string, y string")  # d^2 rows at most
    return wanted.join(full, ["x", "y"]).select("block", "x", "y", "corr")


def numeric_only(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]


def with_rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round selected double columns (for comparisons across engines)."""
    return df.withColumns({c: round_half_away(as_col(c), d) for c, d in digits.items()})

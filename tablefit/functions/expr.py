"""Column expressions.  All of them are built-in Spark expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_hash(key: str | Column, tag: str | None = None) -> Column:
    """First 8 hex digits of ``md5(key [|| ':' || tag])`` as a BIGINT.

    A deterministic, engine-neutral pseudo-random number in [0, 2^32): the same
    rule in DuckDB is ``('0x' || substr(md5(k::varchar || ':tag'), 1, 8))::bigint``.
    It depends only on the key, never on partitioning or task order.
    """
    s = as_col(key).cast("string")
    if tag is not None:
        s = F.concat(s, F.lit(":" + tag))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hex_hash_sql(key: str, tag: str | None = None) -> str:
    """:func:`hex_hash` as Spark SQL text, for building wide projections with a
    single ``selectExpr`` call."""
    s = f"CAST({key} AS STRING)"
    if tag is not None:
        s = f"concat({s}, ':{tag}')"
    return f"CAST(conv(substring(md5({s}), 1, 8), 16, 10) AS BIGINT)"


def hash_bucket(key: str | Column, buckets: int, tag: str | None = None) -> Column:
    """``hex_hash(key, tag) % buckets`` as INT: stable split / fold assignment."""
    return (hex_hash(key, tag) % F.lit(buckets)).cast("int")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``; null when either side is null or the denominator is zero.

    ``try_divide`` never raises, also under ANSI mode (the Spark 4 default),
    where plain ``/`` fails the whole job on the first zero.
    """
    return F.try_divide(as_col(num), as_col(den))


def clamp_min(c: str | Column, lower=0) -> Column:
    """Values below ``lower`` become ``lower``; null stays null.

    (``greatest`` would turn null into ``lower``, because it skips nulls.)
    """
    c = as_col(c)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def recode_above(c: str | Column, threshold, value) -> Column:
    """Values strictly above ``threshold`` become ``value``; others (and null) kept."""
    c = as_col(c)
    return F.when(c > F.lit(threshold), F.lit(value)).otherwise(c)


def recode_equal(c: str | Column, mapping: dict) -> Column:
    """Replace listed values; others (and null) kept."""
    c = as_col(c)
    out = None
    for src, dst in mapping.items():
        out = (F.when(c == F.lit(src), F.lit(dst)) if out is None
               else out.when(c == F.lit(src), F.lit(dst)))
    return c if out is None else out.otherwise(c)


def ordinal_class(c: str | Column, lower_bounds: Sequence[float]) -> Column:
    """Class index by ascending lower bounds: ``[20, 25, 35]`` maps [20,25)->0,
    [25,35)->1, >=35->2; below the first bound (or null) -> null."""
    c = as_col(c)
    out = None
    for idx in range(len(lower_bounds) - 1, -1, -1):
        cond = c >= F.lit(lower_bounds[idx])
        out = F.when(cond, F.lit(idx)) if out is None else out.when(cond, F.lit(idx))
    return out


def null_safe_mean(cols: Sequence[str | Column]) -> Column:
    """Row-wise mean of a column family; any null input gives null."""
    total = None
    for c in cols:
        total = as_col(c) if total is None else total + as_col(c)
    return total / F.lit(float(len(cols)))


def round_half_away(c: str | Column, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(x*10^d) / 10^d`` with ties away
    from zero, computed in binary floating point.

    Spark's ``round`` goes through the decimal *string* of the double, which
    differs from the binary product at exact decimal ties (e.g. 1032.2150625);
    this form gives bit-identical results to engines that round the product
    (DuckDB's ``round``), which keeps cross-engine result hashes stable.
    """
    c = as_col(c)
    p = float(10 ** digits)
    y = c * F.lit(p)
    return (F.when(F.isnan(c) | (F.abs(y) >= F.lit(1e15)), c)
            .otherwise(F.signum(y) * F.floor(F.abs(y) + F.lit(0.5)) / F.lit(p)))

"""Derived and recoded columns.  Each function adds or replaces columns with
ONE ``withColumns`` projection of native expressions (Catalyst collapses it
into the scan's codegen stage; long ``withColumn`` chains only slow analysis).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.functions.expr import (
    as_col,
    clamp_min,
    null_safe_mean,
    ordinal_class,
    recode_above,
    recode_equal,
    safe_ratio,
)

# Lower bounds of the five age classes 0..4 (below 20: no class).
AGE_CLASS_BOUNDS = (20, 25, 35, 45, 55)


def ratios(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{name: (numerator, denominator)}``; zero or null denominator -> null."""
    return df.withColumns({name: safe_ratio(n, d) for name, (n, d) in spec.items()})


def recode_above_threshold(df: DataFrame, col: str, threshold, value) -> DataFrame:
    """e.g. education codes above 3 -> 0 (null kept)."""
    return df.withColumn(col, recode_above(col, threshold, value))


def recode_values(df: DataFrame, col: str, mapping: Mapping) -> DataFrame:
    """e.g. marriage code 0 -> 3 (null kept)."""
    return df.withColumn(col, recode_equal(col, dict(mapping)))


def clamp_columns(df: DataFrame, cols: Sequence[str], lower=0) -> DataFrame:
    """Negatives -> ``lower`` over a family of columns, null preserved."""
    return df.withColumns({c: clamp_min(c, lower) for c in cols})


def age_class(df: DataFrame, col: str = "age", out: str = "age_class",
              bounds: Sequence[float] = AGE_CLASS_BOUNDS) -> DataFrame:
    return df.withColumn(out, ordinal_class(col, bounds))


def row_mean(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, null_safe_mean(cols))


def relative_change(df: DataFrame, cols: Sequence[str], out_prefix: str,
                    newest_first: bool = True, zero_base=-2.0) -> DataFrame:
    """Relative change between adjacent steps of a wide series.

    ``cols`` are in column order (e.g. bill_amt1..6).  With ``newest_first``
    (column 1 is the latest month) output ``i`` is ``(c[i+1] - c[i]) / c[i]``
    for i = 1..n-1, i.e. the base is the *later* month, as the column order
    dictates; ``newest_first=False`` takes the earlier month as the base:
    ``(c[i] - c[i+1]) / c[i+1]``.  A zero base gives the sentinel
    ``zero_base``; null in -> null out.
    """
    out = {}
    for i in range(len(cols) - 1):
        a, b = as_col(cols[i]), as_col(cols[i + 1])
        base, cur = (a, b) if newest_first else (b, a)
        out[f"{out_prefix}{i + 1}"] = (
            F.when(base == 0, F.lit(float(zero_base)))
            .otherwise(F.try_divide((cur - base).cast("double"), base))
        )
    return df.withColumns(out)

"""Exact quantiles of several columns by distributed rank selection.

``Imputer(relativeError=0)`` (and ``percentile`` / ``percentile_disc``) keep
every distinct value of a column in one buffer before answering, which does
not survive a column of 10^12 values.  Here the exact k-th smallest value is
found with scans whose aggregation state is bounded:

1. one pass: count of valid values ``n`` and GK sketches
   (``percentile_approx``) giving a bracket ``[lo, hi]`` around rank
   ``k = ceil(p * n)``.  Sketches are merged in two levels: rows are dealt to
   ``SALTS`` groups by a hash, each group's sketch gives a bracket, and the
   widest of them is taken (a quantile of the whole lies between the smallest
   and the largest of the groups' quantiles), so no single task merges one
   sketch per input task;
2. one pass: exact counts of values below ``lo``, equal to ``lo``, strictly
   inside, and equal to ``hi``.  The counts, not the sketch, decide: rank
   ``k`` is an end of the bracket (done), strictly inside (continue on the
   open interval), or outside (move the bracket to that side);
3. while ``M`` is above ``final_limit`` the bracket is refined by a sketch of
   the in-bracket values only (each round shrinks it by ~``accuracy``/6; a
   round that does not halve it raises the sketch accuracy tenfold, up to
   ``MAX_ACCURACY``);
4. one pass: the at most ``final_limit`` values strictly inside are sorted per
   column (a bounded ``collect_list``) and the ``(k-L)``-th is taken there;
   one number for each column comes to the driver.

A rank that falls on a value repeated by a third of all rows is found as a
bracket end at once, however many copies there are.  All columns advance together, one
aggregation job per round; with ``accuracy=10^4`` a column of 10^12 values
needs about five scans, a small one two.  Nulls and NaN are not values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000
DEFAULT_FINAL_LIMIT = 100_000
MAX_ROUNDS = 60
MAX_ACCURACY = 100_000
SALTS = 32


def _value(df: DataFrame, c: str):
    x = F.col(c).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), x)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    p: float = 0.5,
    accuracy: int = DEFAULT_ACCURACY,
    final_limit: int = DEFAULT_FINAL_LIMIT,
) -> dict[str, float | None]:
    """Exact ``p``-quantile (the ``ceil(p*n)``-th smallest valid value, i.e. the
    lower middle for p=0.5) of each column; ``None`` for a column without
    valid values."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    cols = list(cols)
    xs = {c: _value(df, c) for c in cols}

    def bracket_probs(q: float, acc: int) -> list[float]:
        delta = 3.0 / acc
        return [max(q - delta, 0.0), min(q + delta, 1.0)]

    def sketched(wanted: list[tuple[str, object, float, int]]):
        """name -> (count, lo, hi) of (name, values, quantile, accuracy), merged in two levels."""
        if not wanted:
            return {}
        salted = df.select(*[x.alias(name) for name, x, _, _ in wanted])
        salt = F.pmod(F.xxhash64(*salted.columns), F.lit(SALTS))
        parts = salted.groupBy(salt.alias("_salt")).agg(*[
            e for name, _, q, acc in wanted for e in (
                F.count(name).alias(f"{name}_n"), F.percentile_approx(name, bracket_probs(q, acc), acc).alias(f"{name}_q"))])
        row = parts.agg(*[
            e for name, *_ in wanted for e in (
                F.sum(f"{name}_n").alias(f"{name}_n"), F.min(F.get(f"{name}_q", F.lit(0))).alias(f"{name}_lo"),
                F.max(F.get(f"{name}_q", F.lit(1))).alias(f"{name}_hi"))]).head()
        return {name: (row[f"{name}_n"], row[f"{name}_lo"], row[f"{name}_hi"]) for name, *_ in wanted}

    first = sketched([(f"c{i}", xs[c], p, accuracy) for i, c in enumerate(cols)])

    result: dict[str, float | None] = {}
    state: dict[str, dict] = {}
    for i, c in enumerate(cols):
        n, lo, hi = first[f"c{i}"]
        if not n:
            result[c] = None
            continue
        state[c] = {"k": max(1, math.ceil(p * n)), "lo": lo, "hi": hi, "phase": "verify", "M": n, "acc": accuracy}

    for _ in range(MAX_ROUNDS):
        if not state:
            return result
        refining = [(c, s) for c, s in state.items() if s["phase"] == "refine"]
        for j, (_, lo, hi) in sketched([
                (f"c{j}", F.when(_between(xs[c], s["lo"], s["hi"]), xs[c]), (s["k"] - s["L"]) / s["M"], s["acc"])
                for j, (c, s) in enumerate(refining)]).items():
            s = refining[int(j[1:])][1]
            s["lo"], s["hi"], s["phase"] = lo, hi, "verify"
        aggs, plan = [], []
        for j, (c, s) in enumerate(state.items()):
            x, lo, hi = xs[c], s["lo"], s["hi"]
            inside = _between(x, lo, hi)
            if s["phase"] == "verify":
                aggs += [F.count_if(_less(x, lo)).alias(f"A{j}"), F.count_if(_equal(x, lo)).alias(f"E{j}"),
                         F.count_if(inside).alias(f"I{j}"), F.count_if(_equal(x, hi)).alias(f"H{j}")]
            else:  # final: bounded by final_limit values per column
                aggs.append(F.element_at(F.sort_array(F.collect_list(F.when(inside, x))), s["k"] - s["L"]).alias(f"v{j}"))
            plan.append((j, c, s))
        row = df.agg(*aggs).head()
        for j, c, s in plan:
            if s["phase"] == "final":
                result[c] = float(row[f"v{j}"])
                del state[c]
            else:
                a, e, inner, h, k = row[f"A{j}"], row[f"E{j}"], row[f"I{j}"], row[f"H{j}"], s["k"]
                if k <= a:  # below the bracket
                    s["lo"], s["hi"] = -math.inf, s["lo"]
                elif k <= a + e:  # rank k is the lower end itself
                    result[c] = float(s["lo"])
                    del state[c]
                elif k <= a + e + inner:  # strictly inside
                    if inner > s["M"] // 2:
                        # the sketch did not halve the bracket: sharpen it
                        s["acc"] = min(s["acc"] * 10, max(MAX_ACCURACY, accuracy))
                    s["L"], s["M"] = a + e, inner
                    s["phase"] = "final" if inner <= final_limit else "refine"
                elif k <= a + e + inner + h:  # the upper end
                    result[c] = float(s["hi"])
                    del state[c]
                else:  # above the bracket
                    s["lo"], s["hi"] = s["hi"], math.inf
    raise RuntimeError(f"exact quantile did not converge for {sorted(state)}")


def _less(x, bound: float):
    return F.lit(False) if bound == -math.inf else x < F.lit(bound)


def _equal(x, bound: float):
    return F.lit(False) if math.isinf(bound) else x == F.lit(bound)


def _between(x, lo: float, hi: float):
    """Strictly inside (lo, hi); an infinite end is no bound at all."""
    cond = x.isNotNull()
    if lo != -math.inf:
        cond = cond & (x > F.lit(lo))
    if hi != math.inf:
        cond = cond & (x < F.lit(hi))
    return cond


def exact_median(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    return exact_quantiles(df, cols, 0.5, **kw)


def approx_quantiles(df: DataFrame, cols: Sequence[str], p: float = 0.5,
                     relative_error: float = 0.001) -> dict[str, float | None]:
    """GK-sketch quantiles in one pass (rank error <= relative_error * n)."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    row = df.agg(*[F.percentile_approx(_value(df, c), p, accuracy).alias(f"q{i}")
                   for i, c in enumerate(cols)]).head()
    return {c: (None if row[f"q{i}"] is None else float(row[f"q{i}"])) for i, c in enumerate(cols)}

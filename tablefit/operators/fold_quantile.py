"""Exact quantiles of every fold's complement (all rows but the fold's) in the rounds of one.

The rank selection of ``operators.quantile`` with counts kept by fold: what lies below a bound among all folds but one is the total less that
fold's count, so one count of a bound serves every complement that asks for it.  Sketches are made by fold and salt, too: a quantile of a
complement lies between the smallest and the largest of its parts' quantiles.  The counts, not the sketches, decide.  All columns and complements
advance together; where their brackets are the same, they are counted once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.operators.quantile import (DEFAULT_ACCURACY, DEFAULT_FINAL_LIMIT, MAX_ACCURACY, MAX_ROUNDS, SALTS, _between, _equal, _less, _value)


#: Values of a part from which on its quantiles narrow a bracket well.
PART = 4_096


@dataclass
class _Sought:
    """The rank-th smallest value of ``col`` outside ``fold``: strictly inside (lo, hi) once ``below`` values are known to lie up to lo."""

    col: str
    fold: int
    rank: int
    lo: float
    hi: float
    below: int = 0
    inside: int = 0
    phase: str = "verify"
    accuracy: int = DEFAULT_ACCURACY

    @property
    def bracket(self) -> tuple[str, float, float]:
        return self.col, self.lo, self.hi


def complement_quantiles(df: DataFrame, cols: Sequence[str], num_folds: int, fold_col: str = "fold", p: float = 0.5, accuracy: int = DEFAULT_ACCURACY,
                         final_limit: int = DEFAULT_FINAL_LIMIT) -> dict[int, dict[str, float | None]]:
    """For each fold, the ceil(p * n)-th smallest valid value of each column over the rows of the other folds; None without any.

    Nulls and NaN are no values; rows without a fold are left out.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    folds = range(num_folds)
    named = {c: f"x{i}" for i, c in enumerate(cols)}
    rows = df.where(F.col(fold_col).isNotNull()).select(F.col(fold_col).cast("int").alias("fold"), *[_value(df, c).alias(n) for c, n in named.items()])
    xs = {c: F.col(n) for c, n in named.items()}

    def sketched(wanted: dict, probs: dict, acc: dict, n: int | None = None) -> dict:
        """key -> fold -> (count, smallest and largest of the parts' values at each probability of the key).  ``n``: values about, of which a
        part shall have enough for its quantiles to be near the whole's."""
        salts = SALTS if n is None else max(1, min(SALTS, n // (num_folds * PART)))
        salt = F.pmod(F.xxhash64(*named.values()), F.lit(salts))
        parts = rows.select("fold", salt.alias("salt"), *[x.alias(f"v{i}") for i, x in enumerate(wanted.values())]).groupBy("fold", "salt").agg(*[
            e for i, k in enumerate(wanted) for e in (F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", probs[k], acc[k]).alias(f"q{i}"))])
        by_fold = parts.groupBy("fold").agg(*[
            e for i, k in enumerate(wanted) for e in (F.sum(f"n{i}").alias(f"n{i}"), *[
                f(F.get(f"q{i}", F.lit(j))).alias(f"{name}{i}_{j}") for j in range(len(probs[k])) for f, name in ((F.min, "lo"), (F.max, "hi"))])])
        found = {r["fold"]: r for r in by_fold.collect()}  # one row for each fold
        return {k: {f: (found[f][f"n{i}"], [(found[f][f"lo{i}_{j}"], found[f][f"hi{i}_{j}"]) for j in range(len(probs[k]))])
                    for f in folds if f in found and found[f][f"n{i}"]} for i, k in enumerate(wanted)}

    def ends(parts: dict, fold: int, low: int, high: int) -> tuple[float, float]:
        others = [q for f, (_, q) in parts.items() if f != fold]
        return min(q[low][0] for q in others), max(q[high][1] for q in others)

    delta = 3.0 / accuracy
    first = sketched(xs, {c: [max(p - delta, 0.0), min(p + delta, 1.0)] for c in cols}, dict.fromkeys(cols, accuracy))
    out: dict[int, dict[str, float | None]] = {f: dict.fromkeys(cols) for f in folds}
    sought: list[_Sought] = []
    for c in cols:
        for f in folds:
            if n := sum(count for g, (count, _) in first[c].items() if g != f):
                sought.append(_Sought(c, f, max(1, math.ceil(p * n)), *ends(first[c], f, 0, 1), inside=n, accuracy=accuracy))

    for _ in range(MAX_ROUNDS):
        if not sought:
            return out
        _refine([s for s in sought if s.phase == "refine"], xs, sketched, ends)
        brackets = list(dict.fromkeys(s.bracket for s in sought if s.phase == "verify"))
        finals = list(dict.fromkeys(s.bracket for s in sought if s.phase == "final"))
        if brackets:
            aggs = [e for j, (c, lo, hi) in enumerate(brackets) for e in (
                F.count_if(_less(xs[c], lo)).alias(f"A{j}"), F.count_if(_equal(xs[c], lo)).alias(f"E{j}"),
                F.count_if(_between(xs[c], lo, hi)).alias(f"I{j}"), F.count_if(_equal(xs[c], hi)).alias(f"H{j}"))]
            counts = rows.groupBy("fold").agg(*aggs).collect()  # one row for each fold
        if finals:
            # at most final_limit values of a complement, and so of all but one fold, lie in a bracket
            values = [F.sort_array(F.collect_list(F.when(_between(xs[c], lo, hi), F.struct(xs[c].alias("v"), F.col("fold"))))).alias(f"f{j}")
                      for j, (c, lo, hi) in enumerate(finals)]
            picked = [(s, finals.index(s.bracket)) for s in sought if s.phase == "final"]
            row = rows.agg(*values).select(*[
                F.get(F.filter(f"f{j}", _outside(s.fold)), F.lit(s.rank - s.below - 1))["v"].alias(f"r{i}")
                for i, (s, j) in enumerate(picked)]).head()
            for i, (s, _) in enumerate(picked):
                out[s.fold][s.col] = float(row[f"r{i}"])
        left = []
        for s in sought:
            if s.phase == "final":
                continue
            j = brackets.index(s.bracket)
            a, e, inner, h = (sum(r[f"{x}{j}"] for r in counts if r["fold"] != s.fold) for x in "AEIH")
            if (value := _narrow(s, a, e, inner, h, accuracy, final_limit)) is None:
                left.append(s)
            else:
                out[s.fold][s.col] = float(value)
        sought = left
    raise RuntimeError(f"exact quantiles did not converge for {sorted({s.col for s in sought})}")


def _outside(fold: int):
    return lambda v: v["fold"] != fold


def _narrow(s: _Sought, a: int, e: int, inner: int, h: int, accuracy: int, final_limit: int) -> float | None:
    """The value, if the counts show it; else the next bracket."""
    if s.rank <= a:
        s.lo, s.hi = -math.inf, s.lo
    elif s.rank <= a + e:
        return s.lo
    elif s.rank <= a + e + inner:
        if inner > s.inside // 2:  # the sketch did not halve the bracket: sharpen it
            s.accuracy = min(s.accuracy * 10, max(MAX_ACCURACY, accuracy))
        s.below, s.inside = a + e, inner
        s.phase = "final" if inner <= final_limit else "refine"
    elif s.rank <= a + e + inner + h:
        return s.hi
    else:
        s.lo, s.hi = s.hi, math.inf
    return None


def _refine(sought: list[_Sought], xs: dict, sketched, ends) -> None:
    """Smaller brackets, from sketches of the values inside the present ones."""
    if not sought:
        return
    by_bracket: dict[tuple, list[_Sought]] = {}
    for s in sought:
        by_bracket.setdefault(s.bracket, []).append(s)
    wanted = {b: F.when(_between(xs[b[0]], b[1], b[2]), xs[b[0]]) for b in by_bracket}
    acc = {b: max(s.accuracy for s in own) for b, own in by_bracket.items()}
    probs = {b: [q for s in own for q in (max((s.rank - s.below) / s.inside - 3.0 / acc[b], 0.0), min((s.rank - s.below) / s.inside + 3.0 / acc[b], 1.0))]
             for b, own in by_bracket.items()}
    found = sketched(wanted, probs, acc, min(s.inside for s in sought))
    for b, own in by_bracket.items():
        for i, s in enumerate(own):
            s.lo, s.hi = ends(found[b], s.fold, 2 * i, 2 * i + 1)
            s.phase = "verify"

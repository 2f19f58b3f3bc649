"""Missing-value imputation as a ``pyspark.ml`` stage.

``MissingValueImputer`` is a drop-in for ``pyspark.ml.feature.Imputer`` in a
``Pipeline`` or ``CrossValidator`` (mean / median / mode; null and NaN are
both missing; integer columns stay integer), with one difference: a
``relativeError`` of 0 computes the *exact* median by distributed rank
selection (``tablefit.operators.quantile``) instead of a sketch that holds
the whole column.  ``relativeError > 0`` uses the one-pass GK sketch.

The fitted model applies ``when(isnull or isnan, surrogate)`` -- a native
expression inside whole-stage codegen, no UDF.
"""

from __future__ import annotations

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, HasRelativeError
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tablefit.operators.quantile import approx_quantiles, exact_quantiles


class _ImputerParams(HasInputCols, HasOutputCols, HasRelativeError):
    strategy = Param(Params._dummy(), "strategy", "mean, median or mode",
                     typeConverter=TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(strategy="median", relativeError=0.0)

    def _in_out(self) -> list[tuple[str, str]]:
        ins = self.getInputCols()
        outs = self.getOrDefault(self.outputCols) if self.isDefined(self.outputCols) else ins
        if len(ins) != len(outs):
            raise ValueError("inputCols and outputCols differ in length")
        return list(zip(ins, outs))


class MissingValueImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, strategy="median", relativeError=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MissingValueImputerModel":
        # exact medians take a few passes: keep the input cached meanwhile
        cached = dataset.storageLevel.useMemory or dataset.storageLevel.useDisk
        if not cached:
            dataset = dataset.select(*self.getInputCols()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._fit_cached(dataset)
        finally:
            if not cached:
                dataset.unpersist()

    def _fit_cached(self, dataset: DataFrame) -> "MissingValueImputerModel":
        cols = self.getInputCols()
        for c in cols:
            if not isinstance(dataset.schema[c].dataType, NumericType):
                raise TypeError(f"column {c} is not numeric")
        strategy = self.getOrDefault(self.strategy)
        if strategy == "median":
            rel = self.getRelativeError()
            values = (exact_quantiles(dataset, cols, 0.5) if rel == 0.0
                      else approx_quantiles(dataset, cols, 0.5, rel))
        elif strategy == "mean":
            row = dataset.agg(*[F.avg(_valid(dataset, c)).alias(f"m{i}") for i, c in enumerate(cols)]).head()
            values = {c: row[f"m{i}"] for i, c in enumerate(cols)}
        elif strategy == "mode":
            values = _modes(dataset, cols)
        else:
            raise ValueError(f"unknown strategy {strategy}")
        empty = [c for c, v in values.items() if v is None]
        if empty:
            raise ValueError(f"no valid value to impute from in columns {empty}")
        model = MissingValueImputerModel(surrogates=[float(values[c]) for c in cols])
        return self._copyValues(model)


class MissingValueImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    surrogates = Param(Params._dummy(), "surrogates", "replacement value per input column",
                       typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, surrogates=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def surrogate_map(self) -> dict[str, float]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.surrogates)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        for (ic, oc), value in zip(self._in_out(), self.getOrDefault(self.surrogates)):
            dtype = dataset.schema[ic].dataType
            c = F.col(ic)
            missing = c.isNull()
            if isinstance(dtype, (DoubleType, FloatType)):
                missing = missing | F.isnan(c)
            out[oc] = F.when(missing, F.lit(value).cast(dtype)).otherwise(c)
        return dataset.withColumns(out)


def _valid(df: DataFrame, c: str):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _modes(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Most frequent valid value per column (ties: the smallest), in one
    shuffle: unpivot, count per (column, value) with partial aggregation, then
    a per-column ``max_by`` (bounded state per group)."""
    long = df.select(*[_valid(df, c).alias(c) for c in cols]).unpivot(
        ids=[], values=cols, variableColumnName="column_name", valueColumnName="value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").count()
    best = counts.groupBy("column_name").agg(
        F.max(F.struct(F.col("count"), (-F.col("value")).alias("neg"))).alias("best"))
    got = {r["column_name"]: -r["best"]["neg"] for r in best.collect()}  # one row per column
    return {c: got.get(c) for c in cols}

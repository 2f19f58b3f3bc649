"""Feature preparation as ``pyspark.ml`` pipelines.

Numeric:      impute (median) -> assemble -> scale (divide by sample stddev;
              centring is opt-in, as in ``StandardScaler``'s defaults).
Categorical:  string index (most frequent -> 0, ties alphabetical) -> one-hot
              (k categories -> k-1 slots by default).
Integer codes: one-hot directly (width = max code + 1, codes must be >= 0).
Final:        assemble everything into ``features``.

Fitting is a handful of aggregation jobs (quantile passes, a moments pass,
a label count per categorical column); ``transform`` is a map-only
projection.  Default: fit on the training rows only (no test-to-train
leakage of medians, deviations or category lists); ``fit_on="all"``
reproduces fitting on the whole table.

What comes to the driver is bounded by the schema, not the data: one
surrogate and one deviation per numeric column, and the label list of each
string column, which is checked against ``max_categories`` before fitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.operators.impute import MissingValueImputer

DEFAULT_MAX_CATEGORIES = 10_000


def numeric_stage(cols: Sequence[str], output_col: str = "numeric_features", strategy: str = "median",
                  relative_error: float = 0.0, with_mean: bool = False, with_std: bool = True,
                  impute: bool = True) -> Pipeline:
    cols = list(cols)
    stages = []
    if impute:
        stages.append(MissingValueImputer(inputCols=cols, outputCols=cols, strategy=strategy,
                                          relativeError=relative_error))
    raw = f"{output_col}_raw"
    stages.append(VectorAssembler(inputCols=cols, outputCol=raw))
    stages.append(StandardScaler(inputCol=raw, outputCol=output_col, withMean=with_mean, withStd=with_std))
    return Pipeline(stages=stages)


def categorical_stage(cols: Sequence[str], index_suffix: str = "_index", ohe_suffix: str = "_ohe",
                      order: str = "frequencyDesc", handle_invalid: str = "error",
                      drop_last: bool = True) -> Pipeline:
    cols = list(cols)
    idx = [f"{c}{index_suffix}" for c in cols]
    ohe = [f"{c}{ohe_suffix}" for c in cols]
    return Pipeline(stages=[
        StringIndexer(inputCols=cols, outputCols=idx, stringOrderType=order, handleInvalid=handle_invalid),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=drop_last, handleInvalid=handle_invalid),
    ])


def integer_onehot_stage(cols: Sequence[str], ohe_suffix: str = "_ohe", handle_invalid: str = "error",
                         drop_last: bool = True) -> OneHotEncoder:
    cols = list(cols)
    return OneHotEncoder(inputCols=cols, outputCols=[f"{c}{ohe_suffix}" for c in cols],
                         dropLast=drop_last, handleInvalid=handle_invalid)


def feature_pipeline(numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                     integer_categorical: Sequence[str] = (), features_col: str = "features",
                     ohe_suffix: str = "_ohe", handle_invalid: str = "error",
                     **numeric_kw) -> Pipeline:
    """Nested pipeline: [numeric stage, categorical stage, integer one-hot, assemble]."""
    stages, parts = [], []
    if numeric:
        stages.append(numeric_stage(numeric, output_col="numeric_features", **numeric_kw))
        parts.append("numeric_features")
    if categorical:
        stages.append(categorical_stage(categorical, ohe_suffix=ohe_suffix, handle_invalid=handle_invalid))
        parts += [f"{c}{ohe_suffix}" for c in categorical]
    if integer_categorical:
        stages.append(integer_onehot_stage(integer_categorical, ohe_suffix=ohe_suffix,
                                           handle_invalid=handle_invalid))
        parts += [f"{c}{ohe_suffix}" for c in integer_categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol=features_col))
    return Pipeline(stages=stages)


@dataclass(frozen=True)
class FeatureSpec:
    """Declared roles of a modelling table: key, label and feature lists.

    ``numeric`` are imputed and scaled, ``categorical`` (strings) indexed then
    one-hot encoded, ``integer_categorical`` (non-negative codes) one-hot
    encoded directly.  Everything else in the table is ignored.
    """

    id: str
    label: str
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    integer_categorical: tuple[str, ...] = ()
    handle_invalid: str = "error"
    numeric_options: dict = field(default_factory=dict)

    def pipeline(self, features_col: str = "features") -> Pipeline:
        return feature_pipeline(numeric=list(self.numeric), categorical=list(self.categorical),
                                integer_categorical=list(self.integer_categorical),
                                features_col=features_col, handle_invalid=self.handle_invalid,
                                **self.numeric_options)

    def slot_names(self, model: PipelineModel, df: DataFrame, features_col: str = "features") -> list[str]:
        """Names of the assembled slots (numeric names first, then one-hot slots)."""
        return feature_names(model.transform(df.limit(0)), features_col, self.numeric)


def check_cardinality(df: DataFrame, cols: Sequence[str], max_categories: int = DEFAULT_MAX_CATEGORIES) -> None:
    """Refuse to index a column whose label list would not fit the driver
    (one HyperLogLog pass over all columns at once)."""
    if not cols:
        return
    row = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)]).head()
    wide = [c for i, c in enumerate(cols) if row[f"d{i}"] > max_categories]
    if wide:
        raise ValueError(f"columns {wide} exceed {max_categories} categories; hash or bucket them instead")


def _indexed_columns(stage) -> list[str]:
    """Input columns of every ``StringIndexer`` inside a (nested) pipeline."""
    if isinstance(stage, Pipeline):
        return [c for sub in stage.getStages() for c in _indexed_columns(sub)]
    if isinstance(stage, StringIndexer):
        return stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
    return []


def fit_features(pipeline: Pipeline, df: DataFrame, train: DataFrame | None = None,
                 fit_on: str = "train", max_categories: int | None = DEFAULT_MAX_CATEGORIES) -> PipelineModel:
    """Fit on the training rows (default) or on the whole table.

    String columns to be indexed are first checked against ``max_categories``
    (their label lists come to the driver); ``None`` skips the check.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    if fit_on == "train" and train is None:
        raise ValueError("fit_on='train' needs the training rows; fit_on='all' fits on the whole table")
    source = df if fit_on == "all" else train
    # each stage's fit is one or more aggregation passes over the same rows
    cached = source.storageLevel.useMemory or source.storageLevel.useDisk
    if not cached:
        source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if max_categories is not None:
            check_cardinality(source, _indexed_columns(pipeline), max_categories)
        return pipeline.fit(source)
    finally:
        if not cached:
            source.unpersist()


def modelling_frame(model: PipelineModel, df: DataFrame, id_col: str, label_col: str = "label",
                    features_col: str = "features") -> DataFrame:
    """``(id, features, label)``: the key is kept for joins and stable splits."""
    return model.transform(df).select(id_col, features_col, F.col(label_col).cast("double").alias("label"))


def feature_names(df: DataFrame, vector_col: str, numeric_names: Sequence[str] = ()) -> list[str]:
    """Slot names from the ML attribute metadata of a vector column.

    A scaled block loses its names (Spark calls them ``<col>_0``...), so
    ``numeric_names`` -- the numeric input list, in order -- replaces the
    names of the leading unnamed slots.
    """
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    size = meta.get("num_attrs", 0)
    names = [None] * size
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name")
    numeric_names = list(numeric_names)
    for i, nm in enumerate(numeric_names):
        if i < size:
            names[i] = nm
    return [n if n is not None else f"{vector_col}_{i}" for i, n in enumerate(names)]


def unpack(df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Vector column -> one double column per slot (vectors are not comparable
    across engines; arrays of doubles are)."""
    # two projections: the array is computed once per row, not once per slot
    arrays = df.select(*keep, vector_to_array(F.col(vector_col)).alias("_slots"))
    return arrays.select(*keep, *[F.col("_slots").getItem(i).alias(n) for i, n in enumerate(names)])


def label_mapping(spark: SparkSession, indexer_model) -> DataFrame:
    """``(column_name, label, index)`` from a fitted ``StringIndexerModel``
    (its label lists are already on the driver; nothing is refitted)."""
    cols = indexer_model.getInputCols() if indexer_model.isSet("inputCols") else [indexer_model.getInputCol()]
    rows = [(c, lab, i) for c, labels in zip(cols, indexer_model.labelsArray) for i, lab in enumerate(labels)]
    return spark.createDataFrame(rows, "column_name string, label string, index int")

"""Catalogue: imputation, scaling, indexing, one-hot, assembly, pipelines."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import features, profile, split
from tablefit.operators.impute import MissingValueImputer
from tablefit.operators.models import persisted
from tablefit.operators.quantile import exact_quantiles
from tablefit.plans.profile_queries import PAY, prepared_clients
from tablefit.plans.registry import query
from tablefit.sources import blocks, numeric_columns


def _union(parts):
    return "\nUNION ALL\n".join(parts)


IMPUTE_COLS = ["total_qty", "lines", "ext_price", "qty_per_line", "price_per_qty"]
_RATIO = {"qty_per_line", "price_per_qty"}


def _r(expr: str, c: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})" if c in _RATIO else expr


@query("impute_median", "F2",
       "WITH med AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in IMPUTE_COLS)
       + " FROM blocks) SELECT block_id, "
       + ", ".join(f"{_r(f'coalesce({c}, m_{c})', c)} AS {c}" for c in IMPUTE_COLS) + " FROM blocks, med")
def q_impute_median(spark, base):
    df = blocks(spark, base)
    model = MissingValueImputer(inputCols=IMPUTE_COLS, outputCols=IMPUTE_COLS, strategy="median").fit(df)
    out = model.transform(df).select("block_id", *IMPUTE_COLS)
    return profile.with_rounded(out, {c: 6 for c in _RATIO})


@query("impute_median_refined", "F2",
       "SELECT 'balance' AS column_name, quantile_disc(balance, 0.5) AS median FROM blocks UNION ALL "
       "SELECT 'total_value', quantile_disc(total_value, 0.5) FROM blocks UNION ALL "
       "SELECT 'lines', quantile_disc(lines, 0.5)::DOUBLE FROM blocks")
def q_impute_median_refined(spark, base):
    """The exact median with coarse sketches and a short final list, so that all of its rounds run on any table."""
    cols = ["balance", "total_value", "lines"]
    with persisted(blocks(spark, base).select(*cols)) as df:
        found = exact_quantiles(df, cols, 0.5, accuracy=100, final_limit=100)
    return spark.createDataFrame([(c, found[c]) for c in cols], "column_name string, median double")


@query("impute_bigint", "F2",
       "WITH k AS (SELECT block_id, CASE WHEN lines IS NOT NULL THEN block_id + 9007199254740993 END AS big FROM blocks) "
       "SELECT block_id, CASE WHEN big IS NULL THEN -1 ELSE big END AS big FROM k")
def q_impute_bigint(spark, base):
    """Integers beyond 2^53 that are not missing stay as they are (imputed ones are shown as -1)."""
    df = blocks(spark, base).selectExpr("block_id", "CASE WHEN lines IS NOT NULL THEN block_id + 9007199254740993 END AS big")
    model = MissingValueImputer(inputCols=["big"], outputCols=["filled"], strategy="mean").fit(df)
    return model.transform(df).selectExpr("block_id", "CASE WHEN big IS NULL THEN -1 ELSE filled END AS big")


@query("impute_mean", "F2",
       "WITH mu AS (SELECT avg(total_qty) AS m_q, avg(lines) AS m_l FROM blocks) "
       "SELECT block_id, round(coalesce(total_qty, m_q), 6) AS total_qty, "
       "coalesce(lines, CAST(trunc(m_l) AS BIGINT)) AS lines FROM blocks, mu")
def q_impute_mean(spark, base):
    df = blocks(spark, base)
    cols = ["total_qty", "lines"]
    model = MissingValueImputer(inputCols=cols, outputCols=cols, strategy="mean").fit(df)
    return profile.with_rounded(model.transform(df).select("block_id", *cols), {"total_qty": 6})


@query("impute_mode", "F2",
       "WITH cnt AS (SELECT lines, count(*) AS n FROM blocks WHERE lines IS NOT NULL GROUP BY lines), "
       "mode AS (SELECT lines AS m FROM cnt ORDER BY n DESC, lines LIMIT 1) "
       "SELECT block_id, coalesce(lines, m) AS lines FROM blocks, mode")
def q_impute_mode(spark, base):
    df = blocks(spark, base)
    model = MissingValueImputer(inputCols=["lines"], outputCols=["lines"], strategy="mode").fit(df)
    return model.transform(df).select("block_id", "lines")


SCALE_COLS = ["total_value", "balance"]


@query("standardize", "F3,F1",
       "SELECT block_id, " + ", ".join(
           f"round({c} / stddev_samp({c}) OVER (), 8) AS {c}_scaled" for c in SCALE_COLS) + " FROM blocks")
def q_standardize(spark, base):
    df = blocks(spark, base)
    vec = VectorAssembler(inputCols=SCALE_COLS, outputCol="raw").transform(df)
    scaled = StandardScaler(inputCol="raw", outputCol="scaled").fit(vec).transform(vec)
    out = features.unpack(scaled, "scaled", [f"{c}_scaled" for c in SCALE_COLS], keep=["block_id"])
    return profile.with_rounded(out, {f"{c}_scaled": 8 for c in SCALE_COLS})


_INDEX_CTE = ("WITH cnt AS (SELECT category, count(*) AS n FROM blocks GROUP BY category), "
              "idx AS (SELECT category, row_number() OVER (ORDER BY n DESC, category) - 1 AS ci FROM cnt) ")


@query("string_index", "F4",
       _INDEX_CTE + "SELECT block_id, category, ci::DOUBLE AS category_index FROM blocks JOIN idx USING (category)")
def q_string_index(spark, base):
    df = blocks(spark, base)
    model = StringIndexer(inputCol="category", outputCol="category_index").fit(df)
    return model.transform(df).select("block_id", "category", "category_index")


@query("index_labels", "F5",
       _INDEX_CTE + "SELECT 'category' AS column_name, category AS label, ci::INTEGER AS index FROM idx")
def q_index_labels(spark, base):
    df = blocks(spark, base)
    model = StringIndexer(inputCols=["category"], outputCols=["category_index"]).fit(df)
    return features.label_mapping(spark, model)


@query("onehot_string", "F6",
       _INDEX_CTE + "SELECT block_id, " + ", ".join(
           f"CASE WHEN ci = {j} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS category_ohe_{j}" for j in range(4))
       + " FROM blocks JOIN idx USING (category)")
def q_onehot_string(spark, base):
    df = blocks(spark, base)
    model = features.categorical_stage(["category"]).fit(df)
    out = model.transform(df)
    width = model.stages[1].categorySizes[0] - 1
    return features.unpack(out, "category_ohe", [f"category_ohe_{j}" for j in range(width)], keep=["block_id"])


# Widths follow from the stand-in's code ranges: sex 1..2, education 0..3,
# marriage 1..3 (after recoding) -> max code slots each with dropLast.
ONEHOT_INT = {"sex": 2, "education": 3, "marriage": 3}


@query("onehot_int", "F7,P11",
       "SELECT id, " + ", ".join(
           f"CASE WHEN {c} = {j} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_ohe_{j}"
           for c, w in ONEHOT_INT.items() for j in range(w)) + " FROM clients_prep")
def q_onehot_int(spark, base):
    df = prepared_clients(spark, base)
    cols = list(ONEHOT_INT)
    model = features.integer_onehot_stage(cols).fit(df)
    out = model.transform(df)
    arrays = out.select("id", *[features.vector_to_array(F.col(f"{c}_ohe")).alias(c) for c in cols])
    slots = [F.col(c).getItem(j).alias(f"{c}_ohe_{j}")
             for c, size in zip(cols, model.categorySizes) for j in range(size - 1)]
    return arrays.select("id", *slots)


ASSEMBLE_COLS = ["total_value", "balance", "lines"]


@query("assemble_vector", "F1",
       "SELECT block_id, " + ", ".join(f"{c}::DOUBLE AS v_{c}" for c in ASSEMBLE_COLS)
       + " FROM blocks WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ASSEMBLE_COLS))
def q_assemble_vector(spark, base):
    df = blocks(spark, base)
    vec = VectorAssembler(inputCols=ASSEMBLE_COLS, outputCol="v", handleInvalid="skip").transform(df)
    return features.unpack(vec, "v", [f"v_{c}" for c in ASSEMBLE_COLS], keep=["block_id"])


# --------------------------------------------------- nested pipelines (F8-F10)

def _block_numeric(df):
    # schema-derived list: numeric columns minus key, label and the leaking ratio
    return numeric_columns(df.schema, exclude=["block_id", "total_value", "value_per_line"])


_BLOCK_NUMERIC = ["balance", "total_qty", "lines", "ext_price", "qty_per_line", "price_per_qty"]


def _staged_sql() -> str:
    num = _BLOCK_NUMERIC
    imp_cols = ", ".join(f"coalesce(b.{c}, m_{c}) AS {c}" for c in num)
    return (
        "WITH tr AS (SELECT * FROM blocks_split WHERE bucket < 80), "
        "med AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in num) + " FROM tr), "
        f"imp AS (SELECT b.block_id, b.bucket, b.category, {imp_cols} FROM blocks_split b, med), "
        "sd AS (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in num) + " FROM imp WHERE bucket < 80), "
        "cnt AS (SELECT category, count(*) AS n FROM tr GROUP BY category), "
        "idx AS (SELECT category, row_number() OVER (ORDER BY n DESC, category) - 1 AS ci FROM cnt) "
        "SELECT block_id, " + ", ".join(f"round({c} / s_{c}, 8) AS {c}" for c in num) + ", "
        + ", ".join(f"CASE WHEN ci = {j} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS category_ohe_{j}" for j in range(4))
        + " FROM imp JOIN idx USING (category), sd"
    )


@query("staged_features", "F8,F9,P5,P11", _staged_sql())
def q_staged_features(spark, base):
    df = split.with_split(blocks(spark, base), "block_id")
    numeric = _block_numeric(df)
    pipe = features.feature_pipeline(numeric=numeric, categorical=["category"])
    model = features.fit_features(pipe, df, train=df.where(F.col("split") == "train"))
    out = model.transform(df)
    names = numeric + [f"category_ohe_{j}" for j in range(4)]
    res = features.unpack(out, "features", names, keep=["block_id"])
    return profile.with_rounded(res, {c: 8 for c in numeric})


CLIENT_CATEGORICAL = ["education", "sex", "marriage", *PAY]
# Code ranges of the prepared stand-in (fixed by its rules): slots with dropLast.
CLIENT_SLOTS = {"education": 3, "sex": 2, "marriage": 3, **{p: 8 for p in PAY}}


def _modelling_sql() -> str:
    slots = [f"CASE WHEN {c} = {j} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_ohe_{j}"
             for c in CLIENT_CATEGORICAL for j in range(CLIENT_SLOTS[c])]
    return (
        "WITH sd AS (SELECT stddev_samp(limit_bal) AS s FROM clients_split WHERE bucket < 80) "
        "SELECT id, label::DOUBLE AS label, round(limit_bal / s, 8) AS limit_bal, "
        + ", ".join(slots) + " FROM clients_split, sd"
    )


def client_spec(handle_invalid: str = "error") -> features.FeatureSpec:
    """Declared features of the clients table: the credit limit (imputed,
    scaled) and nine integer-coded categoricals (one-hot); id and the amount
    series are not features."""
    return features.FeatureSpec(id="id", label="label", numeric=("limit_bal",),
                                integer_categorical=tuple(CLIENT_CATEGORICAL), handle_invalid=handle_invalid)


def client_features(spark, base, handle_invalid: str = "error"):
    """Prepared clients with split, and the unfitted feature pipeline."""
    df = split.with_split(prepared_clients(spark, base), "id")
    return df, client_spec(handle_invalid).pipeline()


@query("modelling_frame", "F8,F9,F10", _modelling_sql())
def q_modelling_frame(spark, base):
    spec = client_spec()
    df = split.with_split(prepared_clients(spark, base), "id")
    model = features.fit_features(spec.pipeline(), df, train=df.where(F.col("split") == "train"))
    frame = features.modelling_frame(model, df, spec.id, spec.label)
    # slot names from the fitted vector's metadata (limit_bal, education_ohe_0, ...)
    res = features.unpack(frame, "features", spec.slot_names(model, df), keep=["id", "label"])
    return profile.with_rounded(res, {"limit_bal": 8})


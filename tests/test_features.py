import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import features
from tablefit.operators.impute import MissingValueImputer, MissingValueImputerModel


def test_imputer_median_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (float("nan"),), (None,)], "x double")
    out = MissingValueImputer(inputCols=["x"], outputCols=["x"]).fit(df).transform(df)
    assert sorted(r.x for r in out.collect()) == [1.0, 2.0, 2.0, 2.0, 3.0, 4.0]


def test_imputer_keeps_integer_type_and_modes(spark):
    df = spark.createDataFrame([(1,), (3,), (3,), (2,), (2,), (None,)], "k int")
    m = MissingValueImputer(inputCols=["k"], strategy="mode").fit(df)
    out = m.transform(df)
    assert dict(out.dtypes)["k"] == "int"
    assert m.surrogate_map() == {"k": 2.0}  # tie 2 vs 3 -> smallest
    mean = MissingValueImputer(inputCols=["k"], outputCols=["k2"], strategy="mean").fit(df)
    assert mean.transform(df).where("k is null").head().k2 == 2  # 2.2 truncated, type kept


def test_imputer_in_pipeline_persists(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (None,), (5.0,)], "x double")
    m = MissingValueImputer(inputCols=["x"], outputCols=["x"]).fit(df)
    path = str(tmp_path / "imp")
    m.save(path)
    again = MissingValueImputerModel.load(path)
    assert again.surrogate_map() == {"x": 1.0}


def test_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    m = StringIndexer(inputCol="s", outputCol="i").fit(df)
    assert list(m.labels) == ["c", "a", "b"]
    lm = features.label_mapping(spark, StringIndexer(inputCols=["s"], outputCols=["i"]).fit(df))
    assert [(r["label"], r["index"]) for r in lm.orderBy("index").collect()] == [("c", 0), ("a", 1), ("b", 2)]


def test_onehot_int_width(spark):
    df = spark.createDataFrame([(1,), (2,), (1,)], "sex int")
    m = features.integer_onehot_stage(["sex"]).fit(df)
    assert m.categorySizes == [3]
    out = features.unpack(m.transform(df), "sex_ohe", ["s0", "s1"], keep=["sex"]).collect()
    assert {(r.sex, r.s0, r.s1) for r in out} == {(1, 0.0, 1.0), (2, 0.0, 0.0)}


def test_negative_onehot_raises(spark):
    df = spark.createDataFrame([(-1,), (1,)], "v int")
    with pytest.raises(Exception):
        OneHotEncoder(inputCols=["v"], outputCols=["o"]).fit(df).transform(df).collect()


def test_assemble_null_raises_and_skip_drops(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    va = VectorAssembler(inputCols=["a", "b"], outputCol="v")
    with pytest.raises(Exception):
        va.transform(df).collect()
    assert va.setHandleInvalid("skip").transform(df).count() == 1


def test_unseen_label_raises_unless_keep(spark):
    train = spark.createDataFrame([("a",), ("b",)], "s string")
    test = spark.createDataFrame([("z",)], "s string")
    with pytest.raises(Exception):
        StringIndexer(inputCol="s", outputCol="i").fit(train).transform(test).collect()
    kept = StringIndexer(inputCol="s", outputCol="i", handleInvalid="keep").fit(train).transform(test)
    assert kept.head().i == 2.0


def test_constant_column_scaled_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "k double, x double")
    pipe = features.numeric_stage(["k", "x"], impute=False)
    out = features.unpack(pipe.fit(df).transform(df), "numeric_features", ["k", "x"])
    assert {r.k for r in out.collect()} == {0.0}


def test_feature_names_from_metadata(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a")], "x double, c string")
    m = features.feature_pipeline(numeric=["x"], categorical=["c"]).fit(df)
    names = features.feature_names(m.transform(df), "features", ["x"])
    assert names == ["x", "c_ohe_a"]


def test_cardinality_guard(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError):
        features.check_cardinality(df, ["s"], max_categories=10)


def test_fit_features_checks_indexed_cardinality(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("s"), F.col("id").cast("double").alias("x"))
    pipe = features.feature_pipeline(numeric=["x"], categorical=["s"])
    with pytest.raises(ValueError):
        features.fit_features(pipe, df, fit_on="all", max_categories=50)
    assert features.fit_features(pipe, df, fit_on="all", max_categories=None) is not None


def test_feature_spec_slot_names(spark):
    df = spark.createDataFrame([(1, 1.0, 0, 2, 0.0), (2, 3.0, 1, 1, 1.0), (3, None, 2, 1, 0.0)],
                               "id int, x double, c int, d int, label double")
    spec = features.FeatureSpec(id="id", label="label", numeric=("x",), integer_categorical=("c", "d"))
    model = features.fit_features(spec.pipeline(), df, fit_on="all")
    assert spec.slot_names(model, df) == ["x", "c_ohe_0", "c_ohe_1", "d_ohe_0", "d_ohe_1"]
    frame = features.modelling_frame(model, df, spec.id, spec.label)
    assert frame.columns == ["id", "features", "label"] and frame.count() == 3

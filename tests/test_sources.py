from pyspark.sql import functions as F

from tablefit.operators import profile
from tablefit.session import checkpoint_root, scratch_path
from tablefit.sources import cast_like, load, read_table, rename_strict, write_csv


def test_scratch_paths_live_under_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_csv_inferred_and_explicit_schema_agree(spark, sf_small):
    src = load(spark, sf_small, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    path = write_csv(src, scratch_path(spark, "cust"), sep="|")
    inferred = read_table(spark, path, fmt="csv", sep="|")
    assert dict(inferred.dtypes) == {"c_custkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
    explicit = read_table(spark, path, fmt="csv", sep="|", schema=src.schema)
    assert explicit.schema == src.schema or dict(explicit.dtypes) == dict(src.dtypes)
    assert cast_like(inferred, src.schema).exceptAll(src).count() == 0
    assert src.exceptAll(explicit).count() == 0


def test_rename_strict_is_case_insensitive(spark):
    df = spark.createDataFrame([(1,)], "Default int")
    assert rename_strict(df, {"label": ["DEFAULT"]}).columns == ["label"]


def test_parquet_scan_prunes_columns(spark, sf_small):
    df = load(spark, sf_small, "orders").select("o_orderkey").where(F.col("o_orderkey") > 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in plan


def test_approx_distinct_close_to_exact(spark, sf_small):
    df = load(spark, sf_small, "lineitem")
    exact = {r.column_name: r.n_distinct for r in profile.distinct_counts(df, ["l_partkey", "l_orderkey"]).collect()}
    approx = {r.column_name: r.n_distinct
              for r in profile.distinct_counts(df, ["l_partkey", "l_orderkey"], approx=True).collect()}
    for c in exact:
        assert abs(approx[c] - exact[c]) <= 0.05 * exact[c]

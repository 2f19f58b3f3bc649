"""Structural checks on physical plans: the catalogue stays JVM-side and the
one-pass profiles really scan once with partial aggregation."""

import pytest

import __spark_entry__ as entry
from tablefit.plans import catalogue


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_no_python_udf_in_plan(spark, sf_small, name):
    plan = _plan(entry.queries()[name](spark, sf_small))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


@pytest.mark.parametrize("name,table", [("missing_counts", "lineitem"), ("summary_stats", "orders"),
                                        ("contingency", "orders"), ("filtered_counts", "customer")])
def test_one_pass_profiles_scan_each_table_once(spark, sf_small, name, table):
    plan = _plan(entry.queries()[name](spark, sf_small))
    assert plan.count(f"{table}.parquet") == 1
    assert "partial_" in plan


def test_contingency_is_one_grouping(spark, sf_small):
    plan = _plan(entry.queries()["contingency"](spark, sf_small))
    assert "Expand" in plan and plan.count("partial_count") == 1

"""The query catalogue: every operator of the survey as a registered query
``(spark, sf_dir) -> DataFrame`` plus, where possible, its DuckDB oracle."""

from tablefit.plans.catalogue import oracle_sql, queries, survey_ids

__all__ = ["oracle_sql", "queries", "survey_ids"]

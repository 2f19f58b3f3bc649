"""Query registry: name -> Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the result is expressible in SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablefit.plans.oracle import with_standins

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register a catalogue query; ``sql=None`` means rows-only checking."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if sql is not None:
            ORACLES[name] = with_standins(sql)
        return fn

    return deco

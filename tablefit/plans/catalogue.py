"""Collects the registered queries of all catalogue modules."""

from __future__ import annotations

from tablefit.plans import feature_queries, model_queries, profile_queries, search_queries  # noqa: F401  (registers)
from tablefit.plans.registry import ORACLES, QUERIES, SURVEY_IDS


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


def survey_ids():
    return dict(SURVEY_IDS)

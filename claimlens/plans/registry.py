"""All registered queries of the refund-risk library with their DuckDB twins."""

from __future__ import annotations

from claimlens.plans import baseline_queries, derived_queries, evaluation_queries, feature_queries, graph_queries, label_queries, model_queries, score_queries, service_queries, serving_queries

MODULES = [feature_queries, graph_queries, score_queries, label_queries, evaluation_queries, baseline_queries, model_queries, service_queries, serving_queries, derived_queries]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.oracle_sql().items()}


def flagship(spark, sf_dir):
    return feature_queries.queries()["order_features"](spark, sf_dir)

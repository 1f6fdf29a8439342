"""Query registry: each family module gives QUERIES and SQL under the same names."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ["metric_queries", "split_queries", "drift_queries", "raster_queries", "relational_queries", "model_queries", "check_queries", "catalogue_queries"]


def queries() -> dict:
    return {k: v for name in FAMILIES for k, v in import_module(f"terracask.plans.{name}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for name in FAMILIES for k, v in import_module(f"terracask.plans.{name}").SQL.items()}

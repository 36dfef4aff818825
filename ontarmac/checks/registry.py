"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from ontarmac.checks import archive_queries, feature_queries, model_queries, request_queries

MODULES = [feature_queries, request_queries, archive_queries, model_queries]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

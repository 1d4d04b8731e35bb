"""All queries of the engine by name, each beside the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import base, ingest_plans, metric_plans, serving_plans, session_plans

PLANS = (ingest_plans, metric_plans, session_plans, serving_plans)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)

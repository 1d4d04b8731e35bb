"""The scalar functions under names that SQL statements can use, as SQL functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "session_id": ("key STRING, millis BIGINT", "STRING", "concat(key, lpad(lower(hex(millis)), 16, '0'))"),
    "floor_millis": ("millis BIGINT, step BIGINT", "BIGINT", "millis - pmod(millis, step)"),
    "long_or": ("value BIGINT, otherwise BIGINT", "BIGINT", "coalesce(value, otherwise)"),
    "string_or": ("value STRING, otherwise STRING", "STRING", "coalesce(value, otherwise)"),
    "retry_topic": ("topic STRING", "STRING", "concat('Replay-', replace(topic, '/', '-'))"),
}


def register(spark: SparkSession) -> list[str]:
    """Make them known to the session; the names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)

"""Scalar functions for SQL text: registered in the session's catalog as SQL
functions, which Catalyst inlines, so a query that calls them runs no function."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "num_diff": """num_diff(a DOUBLE, b DOUBLE, tol DOUBLE) RETURNS BOOLEAN
        COMMENT 'one side missing, or both set and further apart than tol'
        RETURN (a IS NULL) <> (b IS NULL) OR (a IS NOT NULL AND b IS NOT NULL AND abs(a - b) > tol)""",
    "guarded_ratio": """guarded_ratio(num DOUBLE, den DOUBLE) RETURNS DOUBLE
        COMMENT 'the quotient, NULL for a zero denominator'
        RETURN CASE WHEN den <> 0 THEN num / den END""",
}


def register(spark: SparkSession) -> None:
    """Make the functions callable from ``spark.sql`` in this session."""
    for text in FUNCTIONS.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")

"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "granary", **settings: str) -> SparkSession:
    """UTC, adaptive plans with skew joins, Arrow; settings override (dots as __)."""
    builder = SparkSession.builder.appName(name)
    known = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (known | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

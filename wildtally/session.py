"""A Spark session set up for this library."""

from __future__ import annotations

from pyspark.sql import SparkSession


def spark_session(app: str = "wildtally", **conf: str) -> SparkSession:
    """Wall-clock timestamps without zone, UTC, adaptive plans."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.timestampType", "TIMESTAMP_NTZ")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

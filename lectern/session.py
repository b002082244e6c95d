"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps naive log times as they are; javaCharsets lets decode() and the CSV source read windows-1250.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("lectern").config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def with_settings(spark: SparkSession) -> SparkSession:
    """Set what can be set on a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark

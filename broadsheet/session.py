"""A Spark session with the settings that the queries rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **extra: str) -> SparkSession:
    """extra: further settings, with _ for . in their names."""
    builder = SparkSession.builder.appName("broadsheet").config(map=SETTINGS | {k.replace("_", "."): v for k, v in extra.items()})
    return (builder.master(master) if master else builder).getOrCreate()

"""The Spark session with the settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "agorascope", **conf: str) -> SparkSession:
    """UTC and adaptive execution; anything else, partitions above all, is left to the cluster or to `conf`."""
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    return SparkSession.builder.appName(name).config(map=settings).getOrCreate()

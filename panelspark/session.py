"""A session with the settings that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "panelspark", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow on; everything else is left to the cluster, or to ``conf``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"} | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()

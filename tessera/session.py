"""Session settings the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tessera", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC (event times become text) with adaptive execution on."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{key: str(value) for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

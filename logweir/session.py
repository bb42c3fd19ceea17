"""Session settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "logweir", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and naive timestamps read as UTC.

    Shuffle partitions are left to the cluster's own setting; adaptive execution
    coalesces them downwards and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

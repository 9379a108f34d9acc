"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the operators rely on or profit from; a caller's own value always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Text work is heavy per byte: let small shuffles keep several partitions.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Merge sessions inside each input partition before the state store's shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "parley", master: str | None = None, **conf: str) -> SparkSession:
    """Create or get a session carrying ``DEFAULTS``; keyword dots are written as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

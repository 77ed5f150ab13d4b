"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "plantmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution, whose concurrent jobs share the cores. Shuffle sizing is left to the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

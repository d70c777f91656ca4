"""Session defaults. A cluster's own settings always win over these."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app_name: str = "arealis", **conf: str) -> SparkSession:
    """Return the running session, or start one with AQE and skew handling on.

    ANSI mode is left at the cluster's choice: every operator gives the same result either way.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Call-site capture multiplies the driver's work on plans with hundreds of columns.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

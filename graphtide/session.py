"""Session settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Shuffle partitions and file splits are left to the deployment: with adaptive
# execution a high partition count is merged down, a skewed one is split.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "graphtide") -> SparkSession:
    """A local session for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

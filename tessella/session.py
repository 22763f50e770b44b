"""Session settings shared by the bench, the tests and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session with the settings the queries are written for; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessella")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is a default a cluster may override through spark-submit.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str | int = "*", name: str = "tidemark", **overrides: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = dict(DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = "8"
    settings["spark.driver.memory"] = "8g"
    settings["spark.driver.host"] = "127.0.0.1"
    settings["spark.driver.bindAddress"] = "127.0.0.1"
    settings.update(overrides)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session

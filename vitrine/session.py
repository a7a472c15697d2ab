"""Session settings the package is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that change results or plans. Cluster size, memory and the shared
# checkpoint folder belong to the deployment and are never overridden here.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "vitrine", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": os.environ.get("VITRINE_DRIVER_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

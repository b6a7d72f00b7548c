"""Session settings for local runs (tests, bench). A cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "haplometh", memory: str | None = None) -> SparkSession:
    """A ``local[cores]`` session with one shuffle partition per core."""
    width = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory or os.environ.get("HAPLOMETH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

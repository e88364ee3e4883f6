"""SparkSession factory used by the tests and the bench; on a cluster the caller brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(cores: int | str = 8, app: str = "townlens", **extra: str) -> SparkSession:
    """Local session with adaptive execution on and one shuffle partition per core."""
    conf = {
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TOWNLENS_DRIVER_MEMORY", "8g"),
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf | extra).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

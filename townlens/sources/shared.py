"""Tables written into the shared folder, for plans that read one result several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of its own only where a local session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='townlens-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def settled(df: DataFrame, tag: str) -> DataFrame:
    """df written once and read back: what reads it several times computes it once, and filters above it are not pushed
    into the rules below, where they would make code too long to compile."""
    path = f"{shared_folder(df.sparkSession)}/townlens/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

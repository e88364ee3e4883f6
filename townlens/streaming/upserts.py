"""Re-crawl streams: each micro-batch is merged into the state table, which is written anew beside the old one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from townlens.operators.merge import upsert_contacts


def current(spark: SparkSession, folder: str, schema) -> tuple[DataFrame, int]:
    """The state after the last finished epoch, and its number (-1: none)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    if fs.exists(fs_path):
        for s in fs.listStatus(fs_path):
            name = s.getPath().getName()
            if name.startswith("epoch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                done.append(int(name.split("=")[1]))
    if not done:
        return spark.createDataFrame([], schema), -1
    return spark.read.schema(schema).parquet(f"{folder}/epoch={max(done)}"), max(done)


def merge_stream(stream: DataFrame, folder: str, checkpoint: str, merge=upsert_contacts, seq: str = "seq", once: bool = True) -> StreamingQuery:
    """Merge a stream of rows by key. An epoch that is run again finds its result there and writes nothing twice."""
    schema = stream.schema

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        state, last = current(spark, folder, schema)
        if last >= epoch:
            return
        merged = merge(state.withColumn(seq, F.lit(-1).cast(schema[seq].dataType)).unionByName(batch), seq=seq)
        merged.withColumn(seq, F.lit(-1).cast(schema[seq].dataType)).select(*[c for c in schema.names]).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

"""What the operators of this package share: reading tables, and cutting lineage with written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of its own only where a local session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='townlens-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, tag: str, compression: str = "zstd") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a checkpoint that outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/townlens/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._townlens_path = path
    return out


def forget(df: DataFrame) -> None:
    """Remove a table made by written() that no later read needs."""
    if path := getattr(df, "_townlens_path", None):
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_of(df: DataFrame, text: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def narrow(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so that further columns of any name cannot clash."""
    return df.select(df[id_col].alias("doc_id"), text_of(df, text).alias("text"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows, written, with `at`, their place in their tree from 0, and `n`, the rows of their tree. Rows are dealt by ranges of
    (tree, order) and each range counts its own, so that a tree may hold all rows. Equal rows get their places in any order."""
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    held = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row_no", F.monotonically_increasing_id()), "sorted")
    parts = held.groupBy("tree", F.shiftright("row_no", 33).alias("part")).agg(F.min("row_no").alias("low"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", (before - F.col("low")).alias("move"), F.sum("size").over(tree).alias("n"))
    placed = held.withColumn("part", F.shiftright("row_no", 33)).join(parts, ["tree", "part"])
    out = written(placed.withColumn("at", F.col("row_no") + F.col("move")).drop("part", "row_no", "move"), "numbered")
    forget(held)
    return out


_MEMOS: dict[str, object] = {}


def only_memo(name: str, clear) -> None:
    """A Python worker serves several operators in turn and keeps the memo of the last one alone: taking it drops the
    others', so that memory does not add up over the stages of a pipeline."""
    for other in [k for k in _MEMOS if k != name]:
        _MEMOS.pop(other)()
    _MEMOS[name] = clear

"""Places that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of texts that go to a Python worker at once. A batch stands in memory several times over, on both sides.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose texts are to go to Python: lowers the session's limit of rows for each Arrow batch, which is made for rows of
    numbers, to ``BATCH_ROWS`` if it is higher."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def named(column: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def documents(df: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text, which tells texts of one doc_id apart), text and rest (a struct of the other columns)."""
    df = in_small_batches(df)
    others = [named(c) for c in df.columns if c not in ("doc_id", "text")] or [F.lit(None).cast("int").alias("none")]
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*others).alias("rest"))
    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text", "rest")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only where the session names none and runs on one machine a local folder is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
        if not root:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is to name a folder that the driver and all executors see")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="factlake-"))
            root = sc.getCheckpointDir()
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint: an executor may be lost without losing it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

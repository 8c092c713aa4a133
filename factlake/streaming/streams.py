"""Structured Streaming forms of replay, change detection and daily counts. Each runs to the end of what is there and stops.
Progress and results are kept below the folder ``where``: a run that is given the folder of an earlier one resumes at the first
unfinished batch. Without one, a new folder is taken and the whole source is read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.replay import last_rows
from .state import Buckets

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Keeps the state of the streams that are started within in RocksDB, as keyed operators need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if before:
            spark.conf.set(name, before)
        else:
            spark.conf.unset(name)


def folder(spark: SparkSession, what: str) -> str:
    """A new folder under the cluster's shared checkpoint folder; a local one only where none is named, on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is to name a folder that the driver and all executors see")
        root = tempfile.mkdtemp(prefix="factlake-")
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def source(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream of a table's Parquet files (a folder of them, or one file)."""
    reader = spark.readStream.schema(schema).format("parquet").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if path.endswith(".parquet"):  # a file source reads folders; this names one file or folder in its parent
        parent, _, name = path.rpartition("/")
        return reader.load(f"{parent}/{name}*")
    return reader.load(path)


def finished(stream: DataFrame, where: str, mode: str = "append") -> DataFrame:
    """Runs a stream into Parquet, batch by batch under the batch's number, which makes a repeated batch overwrite itself."""
    spark, out = stream.sparkSession, f"{where}/out"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{where}/progress").trigger(availableNow=True).foreachBatch(write).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(out)


def replayed(spark: SparkSession, path: str, schema: T.StructType, key: str, order: list[str], columns: list[str], files_per_batch: int | None = None, where: str | None = None, buckets: int = 64) -> DataFrame:
    """The last row of each key of a streamed log: each batch is folded into the buckets of the state that it has keys of. A batch
    that is run again reads what the one before it has left and overwrites its own state."""
    where = where or folder(spark, "replay")
    state = Buckets(spark, f"{where}/state", T.StructType([schema[c] for c in columns]), key, buckets)

    def fold(batch: DataFrame, number: int) -> None:
        state.fold(batch.select(*columns), number, lambda rows: last_rows(rows, key, order))

    run = source(spark, path, schema, files_per_batch).writeStream.option("checkpointLocation", f"{where}/progress").trigger(availableNow=True).foreachBatch(fold).start()
    run.awaitTermination()
    done = finished_batches(spark, where)
    return state.read(done[-1]) if done else spark.createDataFrame([], state.schema)  # a source without files has no batch


def finished_batches(spark: SparkSession, where: str) -> list[int]:
    """The numbers of a stream's finished batches, by its log of commits: a file for each of the last batches."""
    try:
        log = spark.read.option("pathGlobFilter", "[0-9]*").text(f"{where}/progress/commits").select("_metadata.file_name").distinct().collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(int(r.file_name) for r in log)


class _Changes(StatefulProcessor):
    """Emits a row wherever a key's event type differs from the one before it; state is the last type."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "event_type string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        part = pd.concat(list(rows)).sort_values(["ts", "event_id"], kind="stable")
        before = self.last.get()[0] if self.last.exists() else None
        previous = part["event_type"].shift(1)
        previous.iloc[0] = before
        changed = part[part["event_type"] != previous]
        self.last.update((part["event_type"].iloc[-1],))
        yield changed[["user_id", "event_id", "event_type"]]

    def close(self) -> None:
        pass


def state_changes(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, where: str | None = None) -> DataFrame:
    """Changes of event type of each user (user_id, event_id, event_type), by a stateful operator."""
    with rocksdb(spark):
        rows = source(spark, path, schema, files_per_batch).select("user_id", "event_id", "ts", "event_type")
        found = rows.groupBy("user_id").transformWithStateInPandas(_Changes(), "user_id long, event_id long, event_type string", "append", "none")
        return finished(found, where or folder(spark, "changes"))


def daily_counts(spark: SparkSession, path: str, schema: T.StructType, late: str = "48 hours", where: str | None = None) -> DataFrame:
    """Events of each UTC day and type; late ones count for two days. In update mode the last count of a day is the whole."""
    rows = source(spark, path, schema).select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    once = rows.withWatermark("ts", late).dropDuplicates(["event_id", "ts"])
    counts = once.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    found = finished(counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n_events"), where or folder(spark, "daily"), "update")
    return found.groupBy("day", "event_type").agg(F.max_by("n_events", "batch").alias("n_events"))


def sessions(stream: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Windows of a key's samples without a gap, with their length in seconds."""
    out = stream.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count(F.lit(1)).alias("n_samples"))
    return out.select(key, (F.col("session_window.end").cast("double") - F.col("session_window.start").cast("double")).alias("seconds"), "n_samples")


def incremental_window(now: Column, watermark: Column, retention: str, overlap: str) -> tuple[Column, Column]:
    """What a run reads again: from the watermark less an overlap, or from the start of what is retained, up to now. Reading the
    overlap twice is harmless, as batches converge by identity."""
    start = now - F.expr(f"interval {retention}")
    return F.greatest(start, F.coalesce(watermark - F.expr(f"interval {overlap}"), start)), now


def bootstrap_windows(now: Column, first: str, whole: str) -> list[tuple[Column, Column]]:
    """The two runs of a bootstrap, newest first: the second ends where the first began."""
    middle = now - F.expr(f"interval {first}")
    return [(middle, now), (now - F.expr(f"interval {whole}"), middle)]


def advanced_watermark(units: DataFrame, old: Column, at: str = "at", done: str = "done") -> DataFrame:
    """One row: the watermark after a set of units; it moves only if all of them are done."""
    complete = F.coalesce(F.bool_and(done), F.lit(False))
    return units.agg(F.when(complete, F.greatest(old, F.max(at))).otherwise(old).alias("watermark"), complete.alias("complete"))


def unread_pages(pages: DataFrame, seen: DataFrame) -> DataFrame:
    """Pages (page, content) that are new or whose content has changed since they were read (page, content_sha256)."""
    hashed = pages.withColumn("content_sha256", F.sha2("content", 256))
    return hashed.join(seen.select("page", "content_sha256"), ["page", "content_sha256"], "left_anti")

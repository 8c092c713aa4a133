"""Replay of a checkpoint and its deltas, at any version, and the changes between two versions.

A log row has a key, a sequence (0: checkpoint) and a rank within it: deletes (0) come before upserts (1). The last row of a key
counts; if it is a delete the key is gone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_rows(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key: one aggregation with map-side combining, so a hot key is no hot task."""
    rest = [c for c in log.columns if c != key]
    last = log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last"))
    return last.select(key, *[F.col(f"last.`{c}`").alias(c) for c in rest])


def replay(log: DataFrame, key: str, order: Sequence[str], deleted: Column, upto: Column | None = None) -> DataFrame:
    """State after the log's rows (those with ``upto``): the last row of each key that is no delete."""
    return last_rows(log if upto is None else log.filter(upto), key, order).filter(~deleted)


def ranked(checkpoint: DataFrame, deltas: DataFrame) -> DataFrame:
    """A log of a checkpoint's records and of deltas (record_id, delta_seq, operation, ...)."""
    first = checkpoint.withColumns({"delta_seq": F.lit(0), "operation": F.lit("snapshot")})
    log = first.unionByName(deltas, allowMissingColumns=True)
    return log.withColumn("op_rank", F.when(F.col("operation") == "delete", 0).otherwise(1))


def changes(log: DataFrame, key: str, order: Sequence[str], deleted: Column) -> DataFrame:
    """The suffix of a log as one change for each key: op is upsert or delete, so that a later change cancels an earlier one."""
    return last_rows(log, key, order).withColumn("op", F.when(deleted, "delete").otherwise("upsert"))


def is_suffix(old: Sequence[str], new: Sequence[str], same_checkpoint: bool) -> bool:
    """Whether the new version only adds deltas to the old one, so that they alone need reading."""
    return same_checkpoint and list(new[: len(old)]) == list(old)


def chronological(deltas: DataFrame, created: str, seq: str) -> DataFrame:
    """Deltas that were created before their predecessor: a list of versions, small at any data size."""
    before = F.lag(created).over(Window.orderBy(seq))
    return deltas.withColumn("before", before).filter(F.col("before") > F.col(created)).drop("before")


def latest_per_id(log: DataFrame, key: str, at: str) -> DataFrame:
    """Newest change of each id, newest first."""
    return log.groupBy(key).agg(F.max(at).alias(at)).orderBy(F.desc(at), F.asc(key))

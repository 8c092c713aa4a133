"""What ages out: records, events, history entries, bounded tables, reservations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def protected_ids(candidates: DataFrame, protecting: DataFrame, key: str, aliases: str) -> DataFrame:
    """Keys of candidates that share an alias with a protecting record: a semi join on exploded aliases, in which Spark can
    split a frequent alias."""
    safe = protecting.select(F.explode(aliases).alias("alias")).distinct()
    return candidates.select(key, F.explode(aliases).alias("alias")).join(safe, "alias", "left_semi").select(key).distinct()


def with_expiry(records: DataFrame, cutoff: Column) -> DataFrame:
    """Records (record_id, kind, kev, aliases, published_at, last_material_event_at) with whether they expire. Resources,
    exploited ones and those that share an alias with one stay; so do rows without dates. Only old rows are looked up."""
    kev = F.coalesce("kev", F.lit(False))
    old = (F.col("kind") != "resource") & ~kev & F.coalesce(F.greatest("published_at", "last_material_event_at") < cutoff, F.lit(False))
    safe = protected_ids(records.filter(old), records.filter(kev), "record_id", "aliases").withColumn("_safe", F.lit(True))
    return records.join(safe, "record_id", "left").withColumn("expired", old & F.col("_safe").isNull()).drop("_safe")


def expire(records: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) records; removed ones leave the state, and are what retention events are made of."""
    judged = with_expiry(records, cutoff)
    return judged.filter("not expired").drop("expired"), judged.filter("expired").drop("expired").withColumn("status", F.lit("retention_removed"))


def cut_events(events: DataFrame, start: Column, at: str = "observed_at") -> DataFrame:
    return events.filter(F.col(at) >= start)


def history_trim(history: DataFrame, key: str, at: str, revision: str, cutoff: Column, ties: Sequence[str] = ()) -> DataFrame:
    """Entries whose revision differs from the one before, without those whose successor is older than the cutoff. Entries of
    one time are ordered by ``ties``, then by revision."""
    w = Window.partitionBy(key).orderBy(at, *ties, revision)
    changed = history.withColumn("_before", F.lag(revision).over(w)).filter(~F.col("_before").eqNullSafe(F.col(revision))).drop("_before")
    return changed.withColumn("_next", F.lead(at).over(w)).filter(F.col("_next").isNull() | (F.col("_next") >= cutoff)).drop("_next")


def bounded(table: DataFrame, part: list[str], newest: list[Column], size: str, most_rows: int, most_bytes: int) -> DataFrame:
    """The newest rows of each part, as many as fit both bounds."""
    w = Window.partitionBy(*part).orderBy(*newest)
    seen = table.withColumns({"_n": F.row_number().over(w), "_b": F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    return seen.filter((F.col("_n") <= most_rows) & (F.col("_b") <= most_bytes)).drop("_n", "_b")


def rollover(reservations: DataFrame, today: Column) -> DataFrame:
    """On a new day only today's rows and what is not settled stay."""
    return reservations.filter((F.col("day") == today) | (F.col("status") != "settled"))


def rotating_cursor(table: DataFrame, key: str, cursor, due: Column, n: int) -> DataFrame:
    """The next n due keys after the cursor, going round; a top-n, which Spark takes from each partition first."""
    behind = F.coalesce(F.col(key) <= F.lit(cursor), F.lit(False)) if cursor is not None else F.lit(False)
    return table.filter(due).orderBy(behind, key).limit(n)


def keyset_page(table: DataFrame, key: str, after, n: int) -> DataFrame:
    """The n rows after a key: how a limited run resumes."""
    return (table if after is None else table.filter(F.col(key) > F.lit(after))).orderBy(key).limit(n)

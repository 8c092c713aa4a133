"""Change capture: merging a batch into the state, deletes by inventory, typed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import event_id


def dedup_batch(batch: DataFrame, key: str, seq: str, merged: Sequence[str] = ()) -> DataFrame:
    """The last row of each key in a batch; arrays in ``merged`` are united over all its rows."""
    rest = [c for c in batch.columns if c not in (key, *merged)]
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in merged]
    out = batch.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("last"), F.min(seq).alias("first_seq"), *united)
    return out.select(key, *[F.col(f"last.`{c}`").alias(c) for c in rest], *merged, "first_seq")


def merge(current: DataFrame, incoming: DataFrame, key: str, content: str, kept: Sequence[str] = (), same: str = "change") -> DataFrame:
    """Full outer merge of a deduplicated batch into the state. Where ``content`` is equal the stored row stays; columns in
    ``kept`` keep their stored value. ``change`` says insert, update, unchanged or absent (not in the batch)."""
    cur = current.select(F.col(key), F.struct(*[c for c in current.columns if c != key]).alias("old"))
    new = incoming.select(F.col(key), F.struct(*[c for c in incoming.columns if c != key]).alias("new"))
    both = cur.join(new, key, "full_outer")
    o, n = F.col("old"), F.col("new")
    change = F.when(o.isNull(), "insert").when(n.isNull(), "absent").when(o[content].eqNullSafe(n[content]), "unchanged").otherwise("update")
    both = both.withColumn(same, change)
    stays = F.col(same).isin("absent", "unchanged")
    columns = [F.when(stays, o[c]).otherwise(F.coalesce(o[c], n[c]) if c in kept else n[c]).alias(c) for c in current.columns if c != key]
    return both.select(key, *columns, same)


def missing(current: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Stored rows that a completed inventory does not list."""
    return current.join(inventory.select(key).distinct(), key, "left_anti")


def authoritative_delete(current: DataFrame, inventory: DataFrame, complete: bool, key: str = "record_id") -> DataFrame:
    """The state after an inventory: rows that it lacks are marked source_deleted, unless they were; an incomplete one says
    nothing."""
    if not complete:
        return current
    seen = inventory.select(key).distinct().withColumn("listed", F.lit(True))
    gone = F.col("listed").isNull() & (F.col("status") != "source_deleted")
    return current.join(seen, key, "left").withColumn("status", F.when(gone, "source_deleted").otherwise(F.col("status"))).drop("listed")


def upserts(prior: DataFrame, current: DataFrame, key: str, line: str) -> DataFrame:
    """Rows that are new, or whose canonical line differs."""
    return current.join(prior.select(key, F.sha2(F.col(line), 256).alias("h")), (current[key] == prior[key]) & (F.sha2(current[line], 256) == F.col("h")), "left_anti")


def deletes(prior: DataFrame, current: DataFrame, key: str) -> DataFrame:
    return prior.select(key).join(current.select(key), key, "left_anti")


def differences(prior: DataFrame, current: DataFrame, key: str, line: str) -> DataFrame:
    """What ``upserts`` and ``deletes`` find, in one join: rows of ``current`` that are new or whose canonical line differs, and keys of
    ``prior`` (each there once) that it lacks, their other columns null; op is upsert or delete."""
    old = prior.select(F.col(key).alias("_k"), F.sha2(F.col(line), 256).alias("_was"), F.lit(True).alias("_old"))
    new = current.withColumn("_new", F.lit(True))
    both = new.join(old, F.col(key) == F.col("_k"), "full_outer")
    moved = both.filter(F.col("_new").isNull() | F.col("_old").isNull() | ~F.coalesce(F.sha2(F.col(line), 256) == F.col("_was"), F.lit(False)))
    rest = [F.when(F.col("_new").isNull(), F.col("_k")).otherwise(F.col(key)).alias(key) if c == key else F.col(c) for c in current.columns]
    return moved.select(*rest, F.when(F.col("_new").isNull(), "delete").otherwise("upsert").alias("op"))


def append_events(prior: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """The log with the new events, one of each id: prior ones win, then the least row, so that the result is the same for any
    partitioning."""
    both = prior.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)))
    rest = [c for c in prior.columns if c != key]
    out = both.groupBy(key).agg(F.min(F.struct("_n", *rest)).alias("r"))
    return out.select(key, *[F.col(f"r.`{c}`").alias(c) for c in rest]).select(*prior.columns)


def same_snapshot(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# Fixed values of the format: events of a status change to, or back from, these; and of the first sight of each kind.
LOST = ["withdrawn", "rejected", "source_deleted", "retention_removed"]
BACK_FROM = ["withdrawn", "rejected", "source_deleted"]
FIRST = {"advisory": "disclosure", "poc": "poc_added", "resource": "template_added"}
CHANGED = {"advisory": "disclosure", "poc": "poc_changed", "resource": "template_logic_changed"}
PROVEN = {"affected": "affected_corrected", "scores": "score_changed", "metrics": "score_changed"}


def _by_kind(kind: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in names.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def event_types(old: str | Column = "old", new: str | Column = "new") -> Column:
    """Sorted event types of a change between two structs (old null: first sight) with the fields kind, source_id, status,
    kev, affected, scores, severity, metrics, assertion_metrics, semantic, requirements, dependencies, sha256 and, of the new
    one, proof (array of changed fields that a bootstrap has proven). Text fields are canonical JSON."""
    old, new = (F.col(x) if isinstance(x, str) else x for x in (old, new))
    o, n = (lambda c: old[c]), (lambda c: new[c])
    differs = lambda *cs: F.lit(False) if not cs else ~_all([o(c).eqNullSafe(n(c)) for c in cs])
    kev = lambda side: F.coalesce(side("kev"), F.lit(False))
    proven = F.transform(n("proof"), lambda f: F.when(f == "status", F.when(n("status") == "rejected", "rejected").when(n("status") == "active", "disclosure").otherwise("withdrawn")).otherwise(_by_kind(f, PROVEN)))
    first = F.when(F.size(n("proof")) > 0, proven).when(kev(n) | (n("source_id") == "kev"), F.array(F.lit("kev_added"))).otherwise(F.array(_by_kind(n("kind"), FIRST)))
    moved = differs("status")
    update = F.array(
        F.when(moved & n("status").isin(LOST), n("status")).when(moved & o("status").isin(BACK_FROM), _by_kind(n("kind"), CHANGED)),
        F.when(differs("kev"), F.when(kev(n), "kev_added").otherwise("kev_removed")),
        F.when(differs("affected"), "affected_corrected"),
        F.when(differs("scores", "severity", "metrics", "assertion_metrics"), "score_changed"),
        F.when((n("kind") == "poc") & differs("semantic"), "poc_changed"),
        F.when((n("kind") == "resource") & differs("requirements", "dependencies"), "template_requirements_changed"),
        F.when((n("kind") == "resource") & differs("sha256"), "template_logic_changed"),
    )
    types = F.when(old.isNull(), first).otherwise(update)
    return F.array_sort(F.array_distinct(F.filter(types, lambda x: x.isNotNull())))


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def events_of(changes: DataFrame, observed_at: Column, revision: Column, policy_version: Column, window: Column | None = None, types: Column | None = None) -> DataFrame:
    """One row for each typed event of ``changes`` (record_id, old, new; structs that also have content_hash, published_at
    and source_modified_at). ``window`` is when a change that a bootstrap has proven may have occurred;
    ``types`` are its event types, if they are known already."""
    each = changes.select("*", F.explode(event_types() if types is None else types).alias("event_type"))
    occurred = F.when(F.size("new.proof") > 0, None).when(F.col("event_type") == "disclosure", F.col("new.published_at")).otherwise(F.col("new.source_modified_at"))
    old_hash, new_hash = F.col("old.content_hash"), F.col("new.content_hash")
    return each.select(
        F.lit("1.0").alias("schema_version"),
        event_id(F.col("record_id"), old_hash, new_hash, F.col("event_type"), revision, policy_version).alias("event_id"),
        "record_id",
        "event_type",
        old_hash.alias("previous_hash"),
        new_hash.alias("content_hash"),
        revision.alias("source_revision"),
        occurred.alias("source_occurred_at"),
        observed_at.alias("observed_at"),
        policy_version.alias("policy_version"),
        *([] if window is None else [window.alias("source_occurrence_window")]),
    )


def material_differs(old: Column, new: Column) -> Column:
    """Whether affected, status or any metric that is not null differ (structs as above)."""
    metrics = lambda x: F.filter(F.coalesce(x["assertion_metrics"], F.array().cast("array<string>")), lambda m: m.isNotNull() & ~m.isin("null", "[]", "{}"))
    return ~(old["affected"].eqNullSafe(new["affected"]) & old["status"].eqNullSafe(new["status"]) & metrics(old).eqNullSafe(metrics(new)))

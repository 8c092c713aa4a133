"""From a feed's batch to state, events, quarantine and source status, in one plan.

The state and the batch are joined once; what became of each record is one cached table, from which all four results are read:
records that don't fit the schema or the size are kept apart with their reasons, unchanged facts leave the stored row alone, changes
become typed events, and what a completed inventory lacks is marked as deleted. One row of counts goes to the driver. A batch with
anything invalid is partial: it keeps the source's old watermark, and its inventory deletes nothing; its valid rows stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest, event_id, json_string, semantic_json
from ..functions.schemas import RECORD, once, violations, with_fields
from .changes import append_events, event_types, events_of

#: A record's canonical line, with its line feed, may have so many bytes.
MOST_BYTES = 256 * 1024
EVENT_COLUMNS = "schema_version string, event_id string, record_id string, event_type string, previous_hash string, content_hash string, source_revision string, source_occurred_at string, observed_at string, policy_version string, source_occurrence_window struct<from: string, to: string, baseline_revision: string>"
STATE_COLUMNS = "record_id string, source_id string, line string"
SOURCE_COLUMNS = "source_id string, revision string, status string, completed_watermark string, continuation string, invalid long, errors array<string>, last_attempt_at string, last_success_at string"


@dataclass(frozen=True)
class Ingested:
    """``state`` (record_id, source_id, line), ``events``, ``quarantine`` (record_id, reasons, bytes, line), ``source`` (a row);
    ``table`` is cached until it is released."""

    state: DataFrame
    events: DataFrame
    quarantine: DataFrame
    source: DataFrame
    table: DataFrame

    def release(self) -> None:
        self.table.unpersist()


def _field(line: str | Column, name: str) -> Column:
    return F.get_json_object(line, f"$.{name}")


def _hash(facts: Column) -> Column:
    return digest(F.concat(facts, F.lit("\n")))


def compared(line: str | Column, facts: Column) -> Column:
    """The struct that ``event_types`` and ``events_of`` compare, of a record's canonical line."""
    text = ["kind", "source_id", "status", "affected", "scores", "severity", "metrics", "requirements", "dependencies", "sha256", "content_hash", "published_at", "source_modified_at"]
    metrics = F.from_json(_field(line, "assertions"), "array<struct<metrics: string>>")
    proof = F.from_json(_field(line, "bootstrap_material_change"), "struct<changed_fields: array<string>, window_start: string, window_end: string, baseline_revision: string>")
    return F.struct(
        *[_field(line, c).alias(c) for c in text],
        (_field(line, "kev") == "true").alias("kev"),
        F.coalesce(F.transform(metrics, lambda a: a["metrics"]), F.array().cast("array<string>")).alias("assertion_metrics"),
        facts.alias("semantic"),
        F.coalesce(proof["changed_fields"], F.array().cast("array<string>")).alias("proof"),
        F.struct(proof["window_start"].alias("from"), proof["window_end"].alias("to"), proof["baseline_revision"].alias("baseline_revision")).alias("window"),
    )


def _judged(schema: dict, most_bytes: int, now: str) -> Column:
    """A struct of what becomes of a row (given, old_line, set_line, facts, old_facts): its new line, bytes, reasons against it, whether
    it is taken, old and new as they are compared, event types and the line after. Each is computed once a row."""
    old_line, facts, no_reasons = F.col("old_line"), F.col("facts"), F.array().cast("array<string>")

    def of_hash(h: Column) -> Column:
        same = F.coalesce(_field(old_line, "content_hash") == h, F.lit(False))
        return once(F.when(F.col("given").isNotNull() & ~same, with_fields(F.col("set_line"), {"content_hash": json_string(h)})), of_line)

    def of_line(line: Column) -> Column:
        too_large = F.when(F.octet_length(line) + 1 > most_bytes, F.array(F.lit("$: too large"))).otherwise(no_reasons)
        unread = F.col("given").isNotNull() & F.col("set_line").isNull()
        reasons = F.when(line.isNotNull(), F.concat(violations(line, schema), too_large)).when(unread, F.array(F.lit("$: not JSON"))).otherwise(no_reasons)
        return once(reasons, lambda r: of_reasons(line, r))

    def of_reasons(line: Column, reasons: Column) -> Column:
        taken = line.isNotNull() & (F.size(reasons) == 0)
        old = F.when(taken & old_line.isNotNull(), compared(old_line, F.col("old_facts")))
        sides = F.struct(taken.alias("taken"), old.alias("old"), F.when(taken, compared(line, facts)).alias("new"))
        return once(sides, lambda s: once(F.when(s["taken"], event_types(s["old"], s["new"])), lambda types: whole(line, reasons, s, types)))

    def whole(line: Column, reasons: Column, s: Column, types: Column) -> Column:
        material = F.when(F.size(types) > 0, json_string(F.lit(now))).otherwise(once(_field(old_line, "last_material_event_at"), json_string))
        after = F.when(s["taken"], with_fields(line, {"last_material_event_at": material})).otherwise(old_line)
        fields = {"after": after, "taken": s["taken"], "types": types, "old": s["old"], "new": s["new"], "reasons": reasons, "bytes": F.octet_length(line) + 1, "new_line": line}
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    return once(_hash(facts), of_hash)


def ingest(
    current: DataFrame,
    batch: DataFrame,
    events: DataFrame,
    source: dict,
    *,
    source_id: str,
    revision: str,
    now: str,
    policy_version: str,
    status: str = "ok",
    inventory: DataFrame | None = None,
    watermark: str | None = None,
    continuation: str | None = None,
    errors: tuple[str, ...] = (),
    schema: dict = RECORD,
    most_bytes: int = MOST_BYTES,
) -> Ingested:
    """Applies ``batch`` (record_id, seq, line: of one id the last seq counts) to ``current`` (record_id, source_id, line) and the
    log ``events``. ``source`` is the source's last status as a dictionary, empty at first; ``inventory`` (record_id) lists all
    that the source has, if the batch is an authoritative whole."""
    incoming = batch.groupBy("record_id").agg(F.max_by("line", "seq").alias("given"))
    both = current.select("record_id", "source_id", F.col("line").alias("old_line")).join(incoming, "record_id", "full_outer")
    first_seen = once(F.coalesce(_field("old_line", "first_seen_at"), F.lit(now)), json_string)
    both = both.withColumn("set_line", with_fields(F.col("given"), {"schema_version": F.lit('"1.0"'), "first_seen_at": first_seen}))
    old_poc = F.when(_field("set_line", "kind") == "poc", F.col("old_line"))
    both = both.withColumns({"facts": semantic_json("set_line"), "old_facts": semantic_json(old_poc)})
    both = both.withColumn("judged", _judged(schema, most_bytes, now)).select("record_id", "source_id", "given", "old_line", "judged.*")
    listed = inventory.select("record_id").distinct().withColumn("listed", F.lit(True)) if inventory is not None else None
    both = both.join(listed, "record_id", "left") if listed is not None else both.withColumn("listed", F.lit(None).cast("boolean"))
    table = both.persist()

    invalid = table.agg(F.count_if(F.size("reasons") > 0)).first()[0]
    whole = inventory is not None and status == "ok" and not invalid
    gone = F.lit(whole) & F.col("old_line").isNotNull() & (F.col("source_id") == source_id) & F.col("listed").isNull() & ~_field("after", "status").eqNullSafe(F.lit("source_deleted"))
    text = lambda x: json_string(F.lit(x))
    fields = {"status": text("source_deleted"), "source_modified_at": text(now), "last_material_event_at": text(now)} | ({"kev": F.lit("false")} if source_id == "kev" else {})
    deleted = table.filter(gone).select("record_id", "source_id", _field("after", "content_hash").alias("previous_hash"), with_fields(F.col("after"), fields).alias("marked"))
    deleted = deleted.withColumn("content_hash", _hash(semantic_json("marked"))).withColumn("line", with_fields(F.col("marked"), {"content_hash": json_string(F.col("content_hash"))}))

    stays = table.filter(F.col("after").isNotNull() & ~F.coalesce(gone, F.lit(False))).select("record_id", F.when(F.col("taken"), _field("after", "source_id")).otherwise(F.col("source_id")).alias("source_id"), F.col("after").alias("line"))
    state = stays.unionByName(deleted.select("record_id", "source_id", "line"))

    shared = (F.lit(now), F.lit(revision), F.lit(policy_version))
    changed = table.filter(F.size("types") > 0)
    window = F.when(F.size("new.proof") > 0, F.col("new.window"))
    typed = events_of(changed, *shared, window, F.col("types"))
    kind = F.lit("kev_removed" if source_id == "kev" else "source_deleted")
    lost = deleted.select(
        F.lit("1.0").alias("schema_version"),
        event_id(F.col("record_id"), F.col("previous_hash"), F.col("content_hash"), kind, shared[1], shared[2]).alias("event_id"),
        "record_id",
        kind.alias("event_type"),
        "previous_hash",
        "content_hash",
        shared[1].alias("source_revision"),
        F.lit(now).alias("source_occurred_at"),
        shared[0].alias("observed_at"),
        shared[2].alias("policy_version"),
        F.lit(None).cast("struct<from: string, to: string, baseline_revision: string>").alias("source_occurrence_window"),
    )
    log = append_events(events, typed.unionByName(lost))
    quarantine = table.filter(F.size("reasons") > 0).select("record_id", "reasons", "bytes", F.coalesce("new_line", "given").alias("line"))

    ok = status == "ok" and not invalid
    kept = source if invalid else {"revision": revision, "completed_watermark": watermark, "continuation": continuation}
    row = (source_id, kept.get("revision"), "partial" if invalid else status, kept.get("completed_watermark"), kept.get("continuation"), invalid, list(errors), now, now if ok else source.get("last_success_at"))
    return Ingested(state, log, quarantine, current.sparkSession.createDataFrame([row], SOURCE_COLUMNS), table)

"""Change detection by record as a stream, with retention: the streaming form of the merge, the typed events and the expiry.

A keyed operator holds of each record its hash, the columns that are compared and its dates, and hands on old and new where the hash
differs; what kind of change that is, column expressions say, the same as in batch. A timer drops the state of a record whose
retention has ended. Whether an exploited record protects it is another record's matter and is looked up in each batch: protected ones
are parked in a table, and come back from there if they are seen again or go once nothing protects them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.hashing import digest, event_id, iso, json_string, semantic_json
from ..functions.schemas import with_fields
from ..operators.changes import LOST, events_of
from ..operators.ingest import compared
from ..operators.retention import protected_ids
from ..sources import paths
from .state import Buckets
from .streams import folder, rocksdb, source

DAY_MS = 86_400_000
#: What a record's state has: its hash, the hash that it would have when retention removes it, what is compared (JSON), the digest of
#: what makes a change material, its dates in milliseconds (null: none), and whether nothing can make it expire.
HELD = ["content_hash", "gone_hash", "compared", "signature", "published", "material", "stays", "aliases"]
STATE = "content_hash string, gone_hash string, compared string, signature string, published long, material long, stays boolean, aliases array<string>"
MOVED = "record_id string, old string, old_hash string, new string, aliases array<string>, at long, gone_hash string, expired boolean"
PARKED = "record_id string, old string, old_hash string, gone_hash string, due long, aliases array<string>"
EXPLOITED = "record_id string, aliases array<string>"


def _millis(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text))


def prepared(rows: DataFrame) -> DataFrame:
    """Rows (record_id, seq long, at timestamp, line) with the columns of the state."""
    rows = rows.withColumn("facts", semantic_json("line"))
    hashed = digest(F.concat(F.col("facts"), F.lit("\n")))
    gone = digest(F.concat(with_fields(F.col("facts"), {"status": F.lit('"retention_removed"')}), F.lit("\n")))
    rows = rows.withColumns({"content_hash": hashed, "gone_hash": gone}).withColumn("new", compared("line", F.col("facts")).withField("content_hash", F.col("content_hash")))
    n, kind = (lambda c: F.col(f"new.{c}")), F.col("new.kind")
    status = F.when(n("status").isin(LOST), n("status"))
    signature = F.to_json(F.struct(
        status.alias("status"), F.coalesce(n("kev"), F.lit(False)).alias("kev"), *[n(c).alias(c) for c in ("affected", "scores", "severity", "metrics", "assertion_metrics")],
        F.when(kind == "poc", n("semantic")).alias("semantic"), *[F.when(kind == "resource", n(c)).alias(c) for c in ("requirements", "dependencies", "sha256")],
    ))
    aliases = F.coalesce(F.from_json(F.get_json_object("line", "$.aliases"), "array<string>"), F.array().cast("array<string>"))
    return rows.select(
        "record_id", "seq", "at", F.unix_millis("at").alias("at_ms"), "content_hash", "gone_hash", F.to_json("new").alias("compared"), F.sha2(signature, 256).alias("signature"),
        _millis(n("published_at")).alias("published"), (F.coalesce(n("kev"), F.lit(False)) | F.coalesce(kind == "resource", F.lit(False))).alias("stays"), aliases.alias("aliases"),
    )


class _Records(StatefulProcessor):
    """Of a key's rows in a batch the last one counts, whatever their number: one is held at a time. It takes and gives rows, not frames:
    a frame for each key costs more than all that is done with it."""

    def __init__(self, retention_ms: int) -> None:
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", STATE)

    def _due(self, row: dict) -> int | None:
        dates = [row[c] for c in ("published", "material") if row[c] is not None]
        return None if row["stays"] or not dates else max(dates) + self.retention_ms

    def _held(self) -> dict | None:
        held = self.held.get()
        return None if held is None else dict(zip(HELD, held, strict=True))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        last = max(rows, key=lambda r: r.seq)
        old = self._held()
        if old is not None and old["content_hash"] == last.content_hash:
            return
        new = {c: last[c] for c in HELD if c != "material"}
        material = old is None or old["signature"] != new["signature"]
        new["material"] = last.at_ms if material else old["material"]
        before, after = (self._due(old) if old else None), self._due(new)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        self.held.update(tuple(new[c] for c in HELD))
        yield self._moved(key[0], old, new["compared"], new["aliases"], last.at_ms, new["gone_hash"], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        old = self._held()
        if old is not None:
            self.held.clear()
            yield self._moved(key[0], old, None, list(old["aliases"]), int(expiredTimerInfo.getExpiryTimeInMs()), old["gone_hash"], True)

    def _moved(self, key: str, old: dict | None, new: str | None, aliases: list[str], at: int, gone: str, expired: bool) -> Row:
        return Row(record_id=key, old=old and old["compared"], old_hash=old and old["content_hash"], new=new, aliases=aliases, at=at, gone_hash=gone, expired=expired)

    def close(self) -> None:
        pass


def _at(ms: Column) -> Column:
    return iso(F.timestamp_millis(ms))


def record_events(spark: SparkSession, path: str, schema: T.StructType, *, retention_days: float, policy_version: str, where: str | None = None, late: str = "0 seconds", files_per_batch: int | None = None, buckets: int = 64) -> DataFrame:
    """Typed events of a stream of records (record_id, seq long, at timestamp, line): all that the folder ``where`` has after this
    run. ``at`` is when a row was taken in; rows later than ``late`` behind the newest are left out by the watermark, by which
    retention is judged. A removal's revision is its cutoff's day, and it is observed when retention ended."""
    where = where or folder(spark, "records")
    frame = T._parse_datatype_string
    exploited = Buckets(spark, f"{where}/exploited", frame(EXPLOITED), "record_id", buckets)
    parked = Buckets(spark, f"{where}/parked", frame(PARKED), "record_id", buckets)
    retention_ms = int(retention_days * DAY_MS)

    def write(batch: DataFrame, number: int) -> None:
        moved = batch.persist()
        try:
            if moved.isEmpty():
                return
            _fold_exploited(exploited, moved, number)
            held = parked.read(number - 1)
            gone = _fold_parked(parked, held, exploited.read(number), moved, number)
            new = moved.filter("not expired")
            back = held.select("record_id", F.col("old").alias("parked"), F.col("old_hash").alias("parked_hash"))
            new = new.join(back, "record_id", "left").withColumns({"old": F.coalesce("old", "parked"), "old_hash": F.coalesce("old_hash", "parked_hash")})
            shape = compared_schema(spark)
            pairs = new.select("record_id", "at", F.from_json("old", shape).alias("old"), F.from_json("new", shape).alias("new")).filter("old is null or old.content_hash <> new.content_hash")
            typed = events_of(pairs, _at(F.col("at")), F.date_format(F.timestamp_millis("at"), "yyyy-MM-dd"), F.lit(policy_version))
            typed.unionByName(_removals(gone, retention_ms, policy_version)).write.mode("overwrite").parquet(f"{where}/out/{number}")
        finally:
            moved.unpersist()

    with rocksdb(spark):
        rows = prepared(source(spark, path, schema, files_per_batch).withWatermark("at", late))
        found = rows.groupBy("record_id").transformWithState(_Records(retention_ms), MOVED, "append", "eventtime")
        found.writeStream.option("checkpointLocation", f"{where}/progress").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    if not paths.exists(spark, f"{where}/out"):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).option("recursiveFileLookup", "true").parquet(f"{where}/out")


EVENTS = "schema_version string, event_id string, record_id string, event_type string, previous_hash string, content_hash string, source_revision string, source_occurred_at string, observed_at string, policy_version string"


def compared_schema(spark: SparkSession) -> T.StructType:
    """The type of what is compared."""
    return spark.range(0).select(F.lit("{}").alias("line")).select(compared("line", F.lit("")).alias("c")).schema["c"].dataType


def _fold_exploited(table: Buckets, moved: DataFrame, number: int) -> None:
    """Exploited records with their aliases; one that is no longer exploited leaves."""
    mark = moved.filter("not expired").select("record_id", "aliases", (F.get_json_object("new", "$.kev") == "true").alias("on"))

    def folded(rows: DataFrame) -> DataFrame:
        last = rows.groupBy("record_id").agg(F.max_by(F.struct("aliases", "on"), "now").alias("r"))
        return last.filter("r.on").select("record_id", "r.aliases")

    rows = lambda old, new: old.withColumns({"on": F.lit(True), "now": F.lit(0)}).unionByName(new.withColumn("now", F.lit(1)))
    table.fold(mark, number, folded, rows)


def _fold_parked(table: Buckets, held: DataFrame, exploited: DataFrame, moved: DataFrame, number: int) -> DataFrame:
    """Parks what has expired but is protected; what comes back or is no longer protected leaves. Gives what is removed for good."""
    due = moved.filter("expired").select("record_id", "old", "old_hash", "gone_hash", F.col("at").alias("due"), "aliases")
    back = moved.filter("not expired").select("record_id")
    candidates = held.join(back, "record_id", "left_anti").unionByName(due)
    safe = protected_ids(candidates, exploited, "record_id", "aliases").withColumn("safe", F.lit(True))
    judged = candidates.join(safe, "record_id", "left").persist()
    leaves = held.select("record_id").join(judged.filter("safe").select("record_id"), "record_id", "left_anti")
    enters = due.join(judged.filter("safe").select("record_id"), "record_id", "left_semi")
    rows = enters.withColumn("leaves", F.lit(False)).unionByName(leaves.withColumn("leaves", F.lit(True)), allowMissingColumns=True)

    def folded(both: DataFrame) -> DataFrame:
        last = both.groupBy("record_id").agg(F.max_by(F.struct(*table.schema.names[1:], "leaves"), "now").alias("r"))
        return last.filter("not r.leaves").select("record_id", "r.*")

    table.fold(rows, number, folded, lambda old, new: old.withColumns({"leaves": F.lit(False), "now": F.lit(0)}).unionByName(new.withColumn("now", F.lit(1))))
    return judged.filter("safe is null").select("record_id", "old_hash", "gone_hash", "due")


def _removals(gone: DataFrame, retention_ms: int, policy_version: str) -> DataFrame:
    kind, version = F.lit("retention_removed"), F.lit(policy_version)
    cutoff = F.date_format(F.timestamp_millis(F.col("due") - retention_ms), "yyyy-MM-dd")
    none = F.lit(None).cast("string")
    return gone.select(
        F.lit("1.0").alias("schema_version"), event_id(F.col("record_id"), F.col("old_hash"), F.col("gone_hash"), kind, cutoff, version).alias("event_id"), "record_id", kind.alias("event_type"),
        F.col("old_hash").alias("previous_hash"), F.col("gone_hash").alias("content_hash"), cutoff.alias("source_revision"), none.alias("source_occurred_at"), _at(F.col("due")).alias("observed_at"), version.alias("policy_version"),
    )

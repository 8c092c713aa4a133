"""Snapshots on plain files: a manifest, a checkpoint's shards and immutable deltas of canonical JSON lines.

Layout under a root: manifest.json, checkpoints/<id>/..., deltas/<run>/... Shards are read with an explicit schema and
verified against the manifest's size, count and digest before any row is used. A reader takes the manifest as a table: descriptors,
deltas, sources and dependencies are frames, and only run ids and folders go to the driver. The manifest is written last.
"""

from __future__ import annotations

import json
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import canonical_json, source_partition
from ..operators import changes, physical, replay, shards
from ..streaming import streams
from .paths import below, decoded, exists, remove, uri

RECORD_SHARD_BYTES, SHARD_BYTES, MOST_DELTAS = 65536, 524288, 168
FORMAT = "checkpoint-delta-v1"
ENVELOPE = "schema_version string, record_id string, source_id string, native_id string, kind string, aliases array<string>, status string, title string, published_at string, source_modified_at string, first_seen_at string, content_hash string"
EVENT = "schema_version string, event_id string, record_id string, event_type string, previous_hash string, content_hash string, source_revision string, source_occurred_at string, observed_at string, policy_version string"
#: A manifest as columns. A source's state is open: its JSON text.
MANIFEST = "created_at string, shards array<struct<path string, kind string, operation string, count long, bytes long, sha256 string>>, storage struct<format string, checkpoint struct<id string, created_at string, shards array<string>>, deltas array<struct<run_id string, created_at string, shards array<string>>>>, sources map<string, string>, dependencies array<struct<repository string, commit_sha string, manifest_sha256 string>>, retention struct<event_start_at string>"
#: Lists of shards are sent to all tasks where the manifest, which holds them, has at most so many bytes.
SMALL_MANIFEST = 8 << 20
#: Bytes of shards that a task reads, where the cores have that much.
TASK_BYTES = 64 << 20


def _gathered(files: DataFrame, size: int) -> DataFrame:
    """A scan of small files, of ``size`` bytes in all, in a few tasks a core. Spark's reader deals out 32 of them to a task, and each
    task writes to every partition of the next shuffle: that grew with the files, not with their bytes."""
    return files.coalesce(max(4 * files.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def read_manifest(spark: SparkSession, root: str) -> dict:
    """The manifest as a dictionary, for who writes the next one or keeps it as a base."""
    row = spark.read.option("wholetext", True).text(f"{root}/manifest.json").first()
    return json.loads(row.value)


def manifest_of(text: DataFrame) -> DataFrame:
    """The text of a manifest (value) as one row of its columns, with its ``size`` in bytes. Text that is no JSON fails."""
    return text.select(F.octet_length("value").alias("size"), F.from_json("value", MANIFEST, {"mode": "FAILFAST"}).alias("m")).select("size", "m.*")


def manifest_at(spark: SparkSession, root: str) -> DataFrame:
    return manifest_of(spark.read.option("wholetext", True).text(f"{root}/manifest.json"))


def described(manifest: DataFrame) -> DataFrame:
    """Shards (path, kind, operation, count, bytes, sha256) with their place in the log: delta_seq is 0 for the checkpoint, else the
    delta's number, shard the place in its list; both are null if nothing refers to the shard."""
    at = lambda path, n, i: F.struct(path.alias("path"), n.alias("delta_seq"), i.alias("shard"))
    first = F.transform("storage.checkpoint.shards", lambda p, i: at(p, F.lit(0), i))
    deltas = F.flatten(F.transform("storage.deltas", lambda d, k: F.transform(d["shards"], lambda p, i: at(p, k + 1, i))))
    alone = F.transform("shards", lambda s, i: at(s["path"], F.lit(0), i))
    places = manifest.select(F.inline(F.when(F.col("storage").isNull(), alone).otherwise(F.concat(first, deltas))))
    return manifest.select(F.inline("shards")).withColumn("operation", F.coalesce("operation", F.lit("snapshot"))).join(places, "path", "left")


def deltas(manifest: DataFrame) -> DataFrame:
    """Deltas in order: delta_seq from 1, run_id, created_at, n_shards."""
    each = manifest.select(F.posexplode("storage.deltas").alias("at", "d"))
    return each.select((F.col("at") + 1).alias("delta_seq"), "d.run_id", "d.created_at", F.size("d.shards").alias("n_shards"))


def sources(manifest: DataFrame) -> DataFrame:
    """State of each source: source_id, status, revision, last_success_at and the whole of it as JSON text (state)."""
    each = manifest.select(F.explode("sources").alias("source_id", "state"))
    return each.select("source_id", *[F.get_json_object("state", f"$.{c}").alias(c) for c in ("status", "revision", "last_success_at")], "state")


def dependencies(manifest: DataFrame) -> DataFrame:
    """Snapshots that this one was made from: repository, commit_sha, manifest_sha256."""
    return manifest.select(F.inline("dependencies"))


def _problems() -> Column:
    """What is wrong with a manifest's storage, as an array: set operations within its one row, before any shard is read."""
    listed, first, later = F.col("shards"), F.col("storage.checkpoint"), F.col("storage.deltas")
    paths = lambda a: F.transform(a, lambda s: s["path"])
    repeats = lambda a: F.size(F.array_distinct(a)) < F.size(a)
    differ = lambda a, b: (F.size(F.array_except(a, b)) > 0) | (F.size(F.array_except(b, a)) > 0)
    below_ = lambda p, kind, ident: p.startswith(F.concat(F.lit(f"{kind}/"), ident, F.lit("/")))
    some = lambda of: F.exists(listed, lambda s: F.coalesce(of(s), F.lit(True)))
    referenced = F.concat(first["shards"], F.flatten(F.transform(later, lambda d: d["shards"])))
    times = F.concat(F.array(first["created_at"]), F.transform(later, lambda d: d["created_at"]))
    known = lambda s: F.when(s["kind"] == "events", s["operation"].isin("snapshot", "append")).otherwise(s["operation"].isin("snapshot", "upsert", "delete"))
    folder = lambda s: F.when(s["operation"] == "upsert", "/records/upserts/").when(s["operation"] == "delete", "/records/deletes/").when(s["operation"] == "append", "/events/").otherwise("/")
    reasons = {
        "unknown storage format": F.col("storage.format") != FORMAT,
        "shards listed and shards referenced differ": repeats(paths(listed)) | differ(paths(listed), referenced),
        "a shard is referenced twice": repeats(referenced),
        "two deltas have one run id": repeats(F.transform(later, lambda d: d["run_id"])),
        "a checkpoint shard lies outside its folder": F.exists(first["shards"], lambda p: ~below_(p, "checkpoints", first["id"])),
        "deltas go back in time": times != F.array_sort(times),
        "a delta shard lies outside its folder": F.exists(later, lambda d: F.exists(d["shards"], lambda p: ~below_(p, "deltas", d["run_id"]))),
        "a shard path with empty or dotted parts": some(lambda s: F.arrays_overlap(F.split(s["path"], "/"), F.array(F.lit(""), F.lit("."), F.lit("..")))),
        "a shard's operation doesn't fit its place": some(lambda s: ~known(s)) | differ(paths(F.filter(listed, lambda s: s["operation"] == "snapshot")), first["shards"]),
        "a shard's operation doesn't fit its path": some(lambda s: ~F.contains(s["path"], folder(s))),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), name) for name, c in reasons.items()]))
    return F.when(F.col("storage").isNull(), F.array().cast("array<string>")).otherwise(F.array_sort(found))


def manifest_problems(manifest: DataFrame) -> list[str]:
    return manifest.select(_problems()).first()[0]


def _head(manifest: DataFrame) -> Row:
    """What the driver needs: problems, size, bytes of all shards, whether there is storage, when events start, the deltas' run ids and the folders of
    shards by kind, of which there are a few a delta."""
    part = lambda s: F.when(s["path"].rlike("^(checkpoints|deltas)/"), F.substring_index(s["path"], "/", 3)).otherwise(F.substring_index(s["path"], "/", 1))
    folders = F.array_distinct(F.transform("shards", lambda s: F.struct(s["kind"].alias("kind"), part(s).alias("folder"))))
    runs = F.coalesce(F.transform("storage.deltas", lambda d: d["run_id"]), F.array().cast("array<string>"))
    stored = F.col("storage").isNotNull().alias("stored")
    return manifest.select(_problems().alias("problems"), "size", F.aggregate("shards", F.lit(0).cast("long"), lambda n, s: n + F.coalesce(s["bytes"], F.lit(0))).alias("bytes"), stored, F.col("retention.event_start_at").alias("event_start_at"), runs.alias("runs"), F.array_sort(folders).alias("folders")).first()


#: What a line of a split or compacted record holds.
MARKS = ('"continuation"', '"record_encoding"')


def _present(spark: SparkSession, root: str, folders: list[str] | None, size: int | None = None) -> DataFrame:
    """Shards that are there: path, count, bytes, sha256, and whether the shard has a mark of a split record (apart). ``size`` is what
    they have in all, if that is known."""
    paths = [root] if folders is None else [f"{root}/{f}" for f in folders if exists(spark, f"{root}/{f}")]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
    files = reader.load(paths) if paths else spark.createDataFrame([], "path string, content binary")
    files = files if size is None else _gathered(files, size)
    text = F.decode("content", "ISO-8859-1")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    apart = text.contains(MARKS[0]) | text.contains(MARKS[1])
    return files.select(below(decoded(F.col("path")), root).alias("path"), lines.cast("long").alias("count"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), apart.alias("apart"))


def _differ(declared: DataFrame, present: DataFrame) -> DataFrame:
    return shards.inventory_check(declared.select("path", "count", "bytes", "sha256"), present, "path", ["bytes", "sha256", "count"])


def shard_problems(spark: SparkSession, root: str, declared: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """Path and reason of shards that are missing, or whose bytes, lines or digest differ from the manifest's. With ``folders``
    those alone are looked at: what no manifest names any more is not read."""
    return _differ(declared, _present(spark, root, folders))


def _log(spark: SparkSession, root: str, folders: list[str], placed: DataFrame, size: int = 0) -> DataFrame:
    """Lines of the shards that ``placed`` (path, shard, delta_seq, operation) names, with their place. Folders of a kind are
    read, not a list of files; files that no place names drop out in the join. A file is one row up to there, as its path is worked
    out once; its size is bounded by the format."""
    if not folders:
        return spark.createDataFrame([], "line string, shard int, delta_seq int, operation string")
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text([f"{root}/{f}" for f in folders], wholetext=True)
    named = _gathered(read.select("value", below(decoded(F.col("_metadata.file_path")), root).alias("path")), size)
    ends = F.split("value", "\r\n|[\r\n]")  # as Spark's reader of lines has them: what comes after the last end is a line if it is not empty
    lines = F.when(F.element_at(ends, -1) == "", F.slice(ends, 1, F.size(ends) - 1)).otherwise(ends)
    return named.join(placed, "path").select(F.explode(lines).alias("line"), "shard", "delta_seq", "operation")


def _logged(spark: SparkSession, root: str, manifest: DataFrame, head: Row, kind: str, after: int, upto: int) -> DataFrame:
    """The log of one kind, from the deltas after one (-1: from the checkpoint) up to one."""
    runs = set(head.runs[max(after, 0) : upto])
    folders = [f.folder for f in head.folders if f.kind == kind and (f.folder.split("/")[1] in runs if f.folder.startswith("deltas/") else after < 0)]
    placed = described(manifest).filter((F.col("kind") == kind) & (F.col("delta_seq") > after) & (F.col("delta_seq") <= upto))
    placed = placed.select("path", "shard", "delta_seq", "operation")
    return _log(spark, root, folders, F.broadcast(placed) if head.size <= SMALL_MANIFEST else placed, head.bytes)


def _records(log: DataFrame, split: bool | None = None) -> DataFrame:
    """A log's logical records: record_id, line, shard, delta_seq, operation. Records that were split are put together within their
    checkpoint or delta; what shows no sign of it is passed on unread. Whether there are any (``split``) is known to who has verified
    the shards; else a first look, which stops at the first of them, says it."""
    apart = (F.col("operation") != "delete") & (F.col("line").contains(MARKS[0]) | F.col("line").contains(MARKS[1]))
    ident = F.get_json_object("line", "$.record_id").alias("record_id")
    if not (split if split is not None else not log.filter(apart).isEmpty()):
        return log.select(ident, "line", "shard", "delta_seq", "operation")
    whole = physical.logical(log.filter(apart).select(ident, "line", "delta_seq"), "delta_seq")
    whole = whole.select("record_id", "line", F.lit(-1).alias("shard"), F.col("place").cast("int").alias("delta_seq"), F.lit("upsert").alias("operation"))
    return log.filter(~apart).select(ident, "line", "shard", "delta_seq", "operation").unionByName(whole)


def _verified(spark: SparkSession, root: str, manifest: DataFrame, head: Row) -> bool:
    """Whether any shard has a mark of a split record; fails if one does not verify. Each file is read once for both."""
    present = _present(spark, root, sorted({f.folder for f in head.folders}), head.bytes).persist()  # one row a file
    try:
        bad = _differ(described(manifest), present).filter("reason <> 'undeclared'").orderBy("path").limit(3).collect()
        if bad:
            raise ValueError("; ".join(f"{r.path}: {r.reason}" for r in bad))
        return present.agg(F.coalesce(F.bool_or("apart"), F.lit(False))).first()[0]
    finally:
        present.unpersist()


def read_version(spark: SparkSession, root: str, upto: str | None = None, verify: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records (record_id, line), events (event_id, observed_at, line)) of a snapshot, after all deltas or those up to a run.
    A manifest or shard that does not verify fails the read."""
    manifest = manifest_at(spark, root)
    head = _head(manifest)
    if head.problems:
        raise ValueError("; ".join(head.problems))
    split = _verified(spark, root, manifest, head) if verify else None
    last = len(head.runs) if upto is None else head.runs.index(upto) + 1

    def log(kind: str) -> DataFrame:
        return _logged(spark, root, manifest, head, kind, -1, last)

    field = lambda name: F.get_json_object("line", f"$.{name}")
    records = _records(log("records"), split).withColumn("op_rank", F.when(F.col("operation") == "delete", 0).otherwise(1))
    state = replay.replay(records, "record_id", ["delta_seq", "op_rank", "shard"], F.col("operation") == "delete").select("record_id", "line")
    events = replay.last_rows(log("events").withColumn("event_id", field("event_id")), "event_id", ["delta_seq", "shard"]).select("event_id", field("observed_at").alias("observed_at"), "line")
    if head.stored:
        events = events.filter(F.col("observed_at").cast("timestamp") >= F.lit(head.event_start_at).cast("timestamp"))
    return state, events


def records_of(lines: DataFrame) -> DataFrame:
    """The envelope of records (line) as typed columns, beside the line; the schema is given, never inferred."""
    return lines.select(F.from_json("line", ENVELOPE).alias("r"), "line").select("r.*", "line")


def events_of(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("line", EVENT).alias("e")).select("e.*")


def logical_bytes(lines: DataFrame) -> DataFrame:
    """Size of a snapshot's canonical lines."""
    return lines.agg(F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0)).alias("bytes"))


def read_changes(spark: SparkSession, root: str, base: dict) -> tuple[str, DataFrame]:
    """(mode, changes (record_id, op, line)) since another version's manifest: unchanged, incremental (only the new deltas are
    read) or full."""
    now = read_manifest(spark, root)
    if now == base:
        return "unchanged", spark.createDataFrame([], "record_id string, op string, line string")
    a, b = base.get("storage"), now.get("storage")
    if a and b and replay.is_suffix(a["deltas"], b["deltas"], a["checkpoint"] == b["checkpoint"]):
        manifest = manifest_at(spark, root)
        log = _records(_logged(spark, root, manifest, _head(manifest), "records", len(a["deltas"]), len(b["deltas"])))
        log = log.withColumn("op_rank", F.when(F.col("operation") == "delete", 0).otherwise(1))
        found = replay.changes(log, "record_id", ["delta_seq", "op_rank", "shard"], F.col("operation") == "delete")
        return "incremental", found.select("record_id", "op", "line")
    state, _ = read_version(spark, root)
    return "full", state.select("record_id", F.lit("upsert").alias("op"), "line")


def _physical(rows: DataFrame) -> DataFrame:
    """``rows`` (record_id, line, ...) as physical lines; nothing is planned for long ones where there are none. All rows are looked
    at in one job."""
    return physical.physical(rows) if rows.agg(F.bool_or(~physical.passes(F.col("line")))).first()[0] else rows


def _write_shards(rows: DataFrame, part: list[str], key: str, root: str, folder: str, limit: int) -> list[dict]:
    """Writes canonical lines as one file for each shard; returns the descriptors. Files are put in place by a Spark job over
    shards, whose size is bounded; descriptors are a list of shards."""
    from pyarrow import fs

    planned = shards.shard_plan(rows.withColumn("_size", F.octet_length("line").cast("long") + 1), part, key, "_size", limit)
    name = F.concat_ws("/", *part, "prefix")
    named = planned.select(F.concat(F.lit(f"{folder}/"), name, F.lit(".jsonl")).alias("path"), F.col(key).alias("key"), "line")
    whole = named.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key", "line"))), lambda x: x["line"]), "\n").alias("body"), F.count(F.lit(1)).alias("count"))

    def put(batches):
        import hashlib

        import pandas as pd

        files, base = fs.FileSystem.from_uri(uri(root))
        for part_ in batches:
            out = []
            for path, body, count in zip(part_["path"], part_["body"], part_["count"], strict=True):
                data = (body + "\n").encode()
                files.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                if files.get_file_info(f"{base}/{path}").type != fs.FileType.NotFound:  # of an attempt before, or of another run
                    with files.open_input_stream(f"{base}/{path}", compression=None) as f:
                        if f.read() != data:
                            raise ValueError(f"{path} is there with other content")
                    out.append((path, int(count), len(data), hashlib.sha256(data).hexdigest()))
                    continue
                with files.open_output_stream(f"{base}/{path}.tmp{hashlib.sha256(data).hexdigest()[:12]}") as f:
                    f.write(data)
                files.move(f"{base}/{path}.tmp{hashlib.sha256(data).hexdigest()[:12]}", f"{base}/{path}")
                out.append((path, int(count), len(data), hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(out, columns=["path", "count", "bytes", "sha256"])

    done = whole.mapInPandas(put, "path string, count long, bytes long, sha256 string").collect()  # Spark's sort would run it twice, once for a sample
    return sorted((r.asDict() for r in done), key=lambda d: d["path"])


def write_version(spark: SparkSession, root: str, records: DataFrame, events: DataFrame, *, now: str, run_id: str, event_start_at: str, force_checkpoint: bool = False, sources: dict[str, dict] | None = None, dependencies: list[dict] | None = None) -> dict:
    """Writes a version: a checkpoint where there is none, too many deltas, or if forced; else a delta of what differs from
    the version that is there. ``records`` has record_id, source_id and line, ``events`` event_id, observed_at and line (canonical
    JSON). States of ``sources`` and the snapshots that this one depends on stay as they were where none are given; if they are all
    that changed, the manifest alone is written. The manifest comes last; a run that breaks off leaves the old version as it was, and so does one with an id that was used."""
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(uri(root))
    old = read_manifest(spark, root) if files.get_file_info(f"{base}/manifest.json").type != fs.FileType.NotFound else None
    checkpoint = force_checkpoint or not old or not old.get("storage") or len(old["storage"]["deltas"]) >= MOST_DELTAS
    spread = records.repartition("record_id")  # a table may be one small file; the delta's join takes them by this key, too
    rows = spread.select("record_id", source_partition(F.col("source_id")).alias("source"), canonical_json(F.col("line")).alias("line"))
    logged = events.select("event_id", F.substring("observed_at", 1, 10).alias("day"), canonical_json(F.col("line")).alias("line"))
    ident = f"{now[:10].replace('-', '')}-{run_id}"
    if old and old.get("storage"):  # before anything is written: what is referenced is never written again
        if run_id in [d["run_id"] for d in old["storage"]["deltas"]]:
            raise ValueError("two deltas have one run id")
        if checkpoint and ident == old["storage"]["checkpoint"]["id"]:
            raise ValueError("two checkpoints have one id")
    kind = lambda found, k, op: [{"path": d["path"], "kind": k, "operation": op, "count": d["count"], "bytes": d["bytes"], "sha256": d["sha256"]} for d in found]
    with ExitStack() as kept:  # shards are planned and written from lines that are made once

        def keep(rows: DataFrame) -> DataFrame:
            folder = streams.folder(spark, "lines")
            kept.callback(remove, spark, folder)
            rows.write.parquet(folder)
            return spark.read.schema(rows.schema).parquet(folder)

        def write_records(rows: DataFrame, folder: str) -> list[dict]:
            lines = _physical(rows)
            return _write_shards(lines if lines is rows else keep(lines), ["source"], "record_id", root, folder, RECORD_SHARD_BYTES)

        if checkpoint:
            made = kind(write_records(keep(rows), f"checkpoints/{ident}/records"), "records", "snapshot")
            made += kind(_write_shards(keep(logged), ["day"], "event_id", root, f"checkpoints/{ident}/events", SHARD_BYTES), "events", "snapshot")
            manifest = {"schema_version": "1.0", "created_at": now, "shards": made, "storage": {"format": FORMAT, "checkpoint": {"id": ident, "created_at": now, "shards": [d["path"] for d in made]}, "deltas": []}}
        else:
            before, before_events = read_version(spark, root)
            moved = keep(changes.differences(before, rows, "record_id", "line"))
            changed = moved.filter("op = 'upsert'").select("record_id", "source", "line")
            gone = moved.filter("op = 'delete'").select("record_id", F.to_json(F.struct("record_id")).alias("line"))
            new = keep(logged.join(before_events.select("event_id"), "event_id", "left_anti"))
            made = kind(write_records(changed, f"deltas/{run_id}/records/upserts"), "records", "upsert")
            made += kind(_write_shards(gone, [], "record_id", root, f"deltas/{run_id}/records/deletes", RECORD_SHARD_BYTES), "records", "delete")
            made += kind(_write_shards(new, ["day"], "event_id", root, f"deltas/{run_id}/events", SHARD_BYTES), "events", "append")
            if not made and sources in (None, old.get("sources")) and dependencies in (None, old.get("dependencies")):
                return old
            manifest = json.loads(json.dumps(old))
            manifest["created_at"] = now
            manifest["shards"] += made
            if made:
                manifest["storage"]["deltas"].append({"run_id": run_id, "created_at": now, "shards": sorted(d["path"] for d in made)})
    manifest["retention"] = {"event_start_at": event_start_at}
    manifest["sources"] = (old or {}).get("sources", {}) if sources is None else sources
    manifest["dependencies"] = (old or {}).get("dependencies", []) if dependencies is None else dependencies
    text = json.dumps(manifest, ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n"
    if problems := manifest_problems(manifest_of(spark.createDataFrame([(text,)], "value string"))):
        raise ValueError("; ".join(problems))
    data = text.encode()
    with files.open_output_stream(f"{base}/manifest.json.tmp") as f:
        f.write(data)
    files.move(f"{base}/manifest.json.tmp", f"{base}/manifest.json")
    return manifest

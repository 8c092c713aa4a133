"""Golden shapes and round trips of snapshots: write, replay, changes, and what must fail."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from factlake.functions import hashing as H
from factlake.sources import snapshots as S


def lines(spark, rows):
    return spark.createDataFrame([(k, "cve", json.dumps({"record_id": k, "source_id": "cve", "v": v})) for k, v in rows], "record_id string, source_id string, line string")


def events(spark, rows):
    return spark.createDataFrame([(k, at, json.dumps({"event_id": k, "observed_at": at})) for k, at in rows], "event_id string, observed_at string, line string")


def state(frame):
    return {r.record_id: json.loads(r.line)["v"] for r in frame.collect()}


@pytest.fixture(scope="module")
def versions(spark):
    root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    kept = []
    sets = [([("cve/a", 1), ("cve/b", 1)], [("e1", "2026-09-01T00:00:00Z")]), ([("cve/b", 2), ("cve/c", 1)], [("e1", "2026-09-01T00:00:00Z"), ("e2", "2026-09-09T00:00:00Z")]), ([], [("e2", "2026-09-09T00:00:00Z")])]
    for i, (rows, logged) in enumerate(sets, 1):
        kept.append(S.write_version(spark, root, lines(spark, rows), events(spark, logged), now=f"2026-09-1{i}T00:00:00Z", run_id=f"r{i}", event_start_at="2026-09-05T00:00:00Z"))
    return root, kept


def test_replay_and_as_of(spark, versions):
    root, _ = versions
    records, logged = S.read_version(spark, root)
    assert state(records) == {}
    assert [r.event_id for r in logged.collect()] == ["e2"]  # e1 is older than the retained window
    assert state(S.read_version(spark, root, upto="r2")[0]) == {"cve/b": 2, "cve/c": 1}


def test_typed_rows(spark, versions):
    records, logged = S.read_version(spark, versions[0], upto="r2")
    assert {(r.record_id, r.source_id) for r in S.records_of(records).collect()} == {("cve/b", "cve"), ("cve/c", "cve")}
    assert [r.observed_at for r in S.events_of(logged).collect()] == ["2026-09-09T00:00:00Z"]
    assert S.logical_bytes(records).first().bytes == sum(len(r.line.encode()) + 1 for r in records.collect())


def test_changes(spark, versions):
    root, kept = versions
    mode, found = S.read_changes(spark, root, kept[1])
    assert mode == "incremental" and {(r.record_id, r.op) for r in found.collect()} == {("cve/b", "delete"), ("cve/c", "delete")}
    mode, found = S.read_changes(spark, root, kept[0])
    assert mode == "incremental" and {(r.record_id, r.op) for r in found.collect()} == {("cve/a", "delete"), ("cve/b", "delete"), ("cve/c", "delete")}
    assert S.read_changes(spark, root, kept[2])[0] == "unchanged"
    assert S.read_changes(spark, root, kept[0] | {"storage": kept[0]["storage"] | {"checkpoint": {}}})[0] == "full"


def test_unchanged_writes_nothing(spark, versions):
    root, kept = versions
    again = S.write_version(spark, root, lines(spark, []), events(spark, [("e2", "2026-09-09T00:00:00Z")]), now="2026-09-20T00:00:00Z", run_id="r9", event_start_at="2026-09-05T00:00:00Z")
    assert again == kept[2]


def test_damaged_shard_fails(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    made = S.write_version(spark, "file://" + root, lines(spark, [("cve/a", 1)]), events(spark, []), now="2026-09-11T00:00:00Z", run_id="r1", event_start_at="2026-09-05T00:00:00Z")
    path = os.path.join(root, made["shards"][0]["path"])
    assert made["shards"][0]["bytes"] == os.path.getsize(path)
    with open(path, "a") as f:
        f.write("{}\n")
    with pytest.raises(ValueError, match="bytes mismatch"):
        S.read_version(spark, "file://" + root)
    os.rename(path, path + ".gone")
    with pytest.raises(ValueError, match="missing"):
        S.read_version(spark, "file://" + root)


def test_manifest_integrity(spark, versions):
    _, kept = versions
    good = kept[2]
    found = lambda m: S.manifest_problems(S.manifest_of(spark.createDataFrame([(json.dumps(m),)], "value string")))
    assert found(good) == [] and found({"shards": good["shards"]}) == []

    def spoilt(change):
        m = json.loads(json.dumps(good))
        change(m)
        return found(m)

    assert "shards listed and shards referenced differ" in spoilt(lambda m: m["shards"].append(dict(m["shards"][0], path="checkpoints/x/extra.jsonl")))
    assert "two deltas have one run id" in spoilt(lambda m: m["storage"]["deltas"][1].update(run_id="r2"))
    assert "deltas go back in time" in spoilt(lambda m: m["storage"]["deltas"][1].update(created_at="2026-01-01T00:00:00Z"))
    assert "a shard's operation doesn't fit its place" in spoilt(lambda m: m["shards"][0].update(operation="upsert"))
    assert "unknown storage format" in spoilt(lambda m: m["storage"].update(format="other"))
    assert "a shard path with empty or dotted parts" in spoilt(lambda m: m["shards"][0].update(path="checkpoints/../x.jsonl"))
    assert "a delta shard lies outside its folder" in spoilt(lambda m: m["storage"]["deltas"][0].update(run_id="other"))
    assert "a shard is referenced twice" in spoilt(lambda m: m["storage"]["deltas"][0]["shards"].append(m["storage"]["checkpoint"]["shards"][0]))


def test_event_identity_and_canonical_json(spark):
    import hashlib

    parts = ["cve/CVE-2026-1 \"q\"", None, "a" * 64, "disclosure", "rev", "2026-09-17.1"]
    row = spark.createDataFrame([tuple(parts)], "a string, b string, c string, d string, e string, f string").select(H.event_id(*[F.col(c) for c in "abcdef"]).alias("x")).first()
    assert row.x == hashlib.sha256((json.dumps(parts, ensure_ascii=False, separators=(",", ":")) + "\n").encode()).hexdigest()
    doc = '{"b": [1, {"z": null, "a": "é"}], "a": 0.1}'
    got = spark.createDataFrame([(doc,)], "d string").select(H.canonical_json(F.col("d")).alias("s"), H.canonical_json_exact("d").alias("e"), H.git_blob_sha1(F.col("d")).alias("g")).first()
    assert got.s == got.e == json.dumps(json.loads(doc), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert got.g == hashlib.sha1(b"blob %d\0" % len(doc.encode()) + doc.encode()).hexdigest()


def test_scalar_helpers(spark):
    row = spark.createDataFrame([("CVE-2024-12345", "a/2024/CVE-2024-12345.json", "a/2023/CVE-2024-12345.json", "we ird", " b, a,,a ")], "cve string, good string, bad string, src string, tags string").select(
        H.cve_path(F.col("cve")).alias("p"), H.id_of_path(F.col("good")).alias("g"), H.id_of_path(F.col("bad")).alias("b"), H.source_partition(F.col("src")).alias("s"), H.tags(F.col("tags")).alias("t"), H.quoted_path(F.lit("a b/ü")).alias("q"), H.iso(H.instant(F.lit("2024-01-02T03:04:05+02:00"))).alias("i")
    ).first()
    assert row.p == "cves/2024/12xxx/CVE-2024-12345.json" and row.g == "CVE-2024-12345" and row.b is None
    assert row.s.startswith("source-") and len(row.s) == 23 and row.t == ["a", "b"] and row.q == "a%20b/%C3%BC" and row.i == "2024-01-02T01:04:05Z"


def test_semantic_projection(spark):
    doc = {"record_id": "r", "content_hash": "x", "source_index_url": "kept", "body": [{"source_commit": "y", "fact": {"fetched_at": 1, "v": 2, "source_index_url": "gone"}}], "provenance": [{"revision": 1, "url": "u", "role": "cna"}, "text"], "assessment": {}, "url": "stays"}
    got = spark.createDataFrame([(json.dumps(doc),), (None,)], "d string").select(H.semantic_json("d").alias("s")).collect()
    assert json.loads(got[0].s) == {"record_id": "r", "source_index_url": "kept", "body": [{"fact": {"v": 2}}], "provenance": [{"role": "cna"}, "text"], "url": "stays"} and got[1].s is None


def test_used_run_id_changes_nothing(spark):
    root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    write = lambda rows, run, **more: S.write_version(spark, root, lines(spark, rows), events(spark, []), now="2026-09-11T00:00:00Z", run_id=run, event_start_at="2026-09-05T00:00:00Z", **more)
    write([("cve/a", 1)], "r1")
    write([("cve/a", 2)], "r2")
    with pytest.raises(ValueError, match="one run id"):
        write([("cve/a", 3), ("cve/b", 3)], "r2")
    with pytest.raises(ValueError, match="one id"):
        write([("cve/a", 3)], "r1", force_checkpoint=True)
    assert state(S.read_version(spark, root)[0]) == {"cve/a": 2}


def test_left_over_shards_are_not_overwritten(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    write = lambda rows, run: S.write_version(spark, "file://" + root, lines(spark, rows), events(spark, []), now="2026-09-11T00:00:00Z", run_id=run, event_start_at="2026-09-05T00:00:00Z")
    write([("cve/a", 1)], "r1")
    path = os.path.join(root, write([("cve/a", 2)], "r2")["storage"]["deltas"][0]["shards"][0])
    lost = path.replace("r2", "r3")  # what a run that broke off has left
    os.makedirs(os.path.dirname(lost))
    with open(path) as a, open(lost, "w") as b:
        b.write(a.read())
    assert "r3" in write([("cve/a", 1)], "r3x")["storage"]["deltas"][-1]["run_id"]
    with pytest.raises(Exception, match="other content"):
        write([("cve/a", 5)], "r3")
    assert state(S.read_version(spark, "file://" + root)[0]) == {"cve/a": 1}


def test_shards_are_found_by_their_whole_path(spark):
    """A path that is the end of another one names its own file alone."""
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for path, v in (("x.jsonl", 1), ("b/x.jsonl", 2)):
        os.makedirs(os.path.dirname(os.path.join(root, path)) or root, exist_ok=True)
        with open(os.path.join(root, path), "w") as f:
            f.write(json.dumps({"v": v}) + "\n")
    for base in (root, "file://" + root, "file:" + root + "/"):
        placed = spark.createDataFrame([("x.jsonl", 0, 0, "snapshot"), ("b/x.jsonl", 1, 0, "snapshot")], "path string, shard int, delta_seq int, operation string")
        log = S._log(spark, base, ["b", "x.jsonl"], placed)
        assert sorted((r.shard, json.loads(r.line)["v"]) for r in log.collect()) == [(0, 1), (1, 2)]
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def whole(k, v, **more):
    return dict(schema_version="1.0", record_id=k, source_id="feed", native_id=k, kind="advisory", status="active", title=v, aliases=[], published_at=None, source_modified_at=None, first_seen_at="2026-01-01T00:00:00Z", content_hash="a" * 64, affected=[], references=[], provenance=[]) | more


def test_long_records_are_stored_in_parts(spark):
    rng, root = random.Random(2), "file://" + tempfile.mkdtemp(prefix="spark- ", dir="/tmp") + "/a b"  # with spaces
    text = lambda n: "".join(rng.choices("abcdefghij", k=n))
    first = {"f/1": text(90000), "f/2": "short", "f/3": text(20000)}
    second = first | {"f/2": text(50000), "f/3": "short"}
    kept = []
    for day, rows in enumerate((first, second, {"f/1": first["f/1"]}), 1):
        frame = spark.createDataFrame([(k, "feed", json.dumps(whole(k, v))) for k, v in rows.items()], "record_id string, source_id string, line string")
        kept.append(S.write_version(spark, root, frame, events(spark, []), now=f"2026-09-1{day}T00:00:00Z", run_id=f"r{day}", event_start_at="2026-09-05T00:00:00Z"))
        got = S.read_version(spark, root)[0].collect()
        assert {r.record_id: json.loads(r.line) for r in got} == {k: whole(k, v) for k, v in rows.items()}
    assert all(s["bytes"] <= S.RECORD_SHARD_BYTES for s in kept[-1]["shards"])
    mode, found = S.read_changes(spark, root, kept[0])
    assert mode == "incremental" and {(r.record_id, r.op) for r in found.collect()} == {("f/2", "delete"), ("f/3", "delete")}


def test_only_what_the_manifest_names_is_read(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for day in (1, 2):
        S.write_version(spark, "file://" + root, lines(spark, [("cve/a", day)]), events(spark, [("e1", "2026-09-09T00:00:00Z")]), now=f"2026-09-1{day}T00:00:00Z", run_id=f"r{day}", event_start_at="2026-09-05T00:00:00Z", force_checkpoint=True)
    old = [os.path.join(d, f) for d, _, names in os.walk(f"{root}/checkpoints/20260911-r1") for f in names if f.endswith(".jsonl")]
    assert old
    for f in old:
        os.chmod(f, 0o644)
        with open(f, "w") as out:
            out.write("not a line of the format")
    records, logged = S.read_version(spark, "file://" + root)
    assert state(records) == {"cve/a": 2} and logged.count() == 1
    plans = [df._jdf.queryExecution().toString() for df in (records, logged)]
    assert all("20260911-r1" not in p for p in plans) and "/events" not in plans[0].split("== Physical Plan ==")[1] and "/records" not in plans[1].split("== Physical Plan ==")[1]


def test_manifest_as_tables(spark):
    root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    dep = {"repository": "a/b", "commit_sha": "0" * 40, "manifest_sha256": "1" * 64}
    ok = {"cve": {"status": "ok", "revision": "r", "coverage_gaps": [], "errors": [], "completed_watermark": {"at": 1}}}
    write = lambda rows, i, **more: S.write_version(spark, root, lines(spark, rows), events(spark, []), now=f"2026-09-1{i}T00:00:00Z", run_id=f"r{i}", event_start_at="2026-09-05T00:00:00Z", **more)
    write([("cve/a", 1)], 1, sources=ok, dependencies=[dep])
    made = write([("cve/a", 2), ("cve/b", 1)], 2)
    again = write([("cve/a", 2), ("cve/b", 1)], 3, sources={"cve": ok["cve"] | {"status": "partial"}})
    assert made["sources"] == ok and again["storage"] == made["storage"] and again["created_at"] > made["created_at"]
    m = S.manifest_at(spark, root)
    (source,) = S.sources(m).collect()
    assert (source.source_id, source.status, json.loads(source.state)["completed_watermark"]) == ("cve", "partial", {"at": 1})
    assert [r.asDict() for r in S.dependencies(m).collect()] == [dep]
    assert [(r.delta_seq, r.run_id, r.n_shards) for r in S.deltas(m).collect()] == [(1, "r2", 2)]  # the prefix of a hash names each
    got = sorted((r.path.split("/")[0], r.delta_seq, r.shard, r.operation) for r in S.described(m).collect())
    assert got == [("checkpoints", 0, 0, "snapshot"), ("deltas", 1, 0, "upsert"), ("deltas", 1, 1, "upsert")]
    assert state(S.read_version(spark, root)[0]) == {"cve/a": 2, "cve/b": 1}


def test_a_manifest_of_many_shards(spark):
    """A hundred thousand descriptors: the driver gets one row of folders, the rest stays a table."""
    paths = [f"checkpoints/c/records/s{i}/x.jsonl" for i in range(100_000)]
    m = {"created_at": "2026-09-01T00:00:00Z", "shards": [{"path": p, "kind": "records", "operation": "snapshot", "count": 1, "bytes": 3, "sha256": "0" * 64} for p in paths], "storage": {"format": S.FORMAT, "checkpoint": {"id": "c", "created_at": "2026-09-01T00:00:00Z", "shards": paths}, "deltas": []}, "retention": {"event_start_at": "2026-09-01T00:00:00Z"}}
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    with open(f"{root}/manifest.json", "w") as f:
        json.dump(m, f)
    head = S._head(S.manifest_at(spark, root))
    assert (head.problems, head.runs, [tuple(f) for f in head.folders]) == ([], [], [("records", "checkpoints/c/records")]) and head.size > S.SMALL_MANIFEST
    found = S.described(S.manifest_at(spark, root)).agg(F.count_distinct("path").alias("n"), F.max("shard").alias("last"), F.max("delta_seq").alias("d")).first()
    assert tuple(found) == (100_000, 99_999, 0)


def test_a_version_makes_its_lines_once(spark):
    """However often shards are counted, planned and written, and whether as a checkpoint or a delta."""
    root, made = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def line(k, v):
        made.add(1)
        return json.dumps({"record_id": k, "source_id": "cve", "v": v})

    for day in (1, 2):
        rows = spark.range(300).select(F.concat(F.lit("cve/"), F.col("id").cast("string")).alias("record_id"), F.lit("cve").alias("source_id"), F.when(F.col("id") % 3 == 0, day).otherwise(0).alias("v"))
        rows = rows.filter(f"record_id <> 'cve/{day}'").select("record_id", "source_id", line("record_id", "v").alias("line"))
        kept = S.write_version(spark, root, rows, events(spark, []), now=f"2026-09-1{day}T00:00:00Z", run_id=f"r{day}", event_start_at="2026-09-05T00:00:00Z")
        assert made.value == 299 * day
    assert state(S.read_version(spark, root)[0]) == {f"cve/{i}": 2 if i % 3 == 0 else 0 for i in range(300) if i != 2}
    assert sum(s["count"] for s in kept["shards"] if s["operation"] == "upsert") == 101 and sum(s["count"] for s in kept["shards"] if s["operation"] == "delete") == 1


def test_many_small_shards_are_read_in_few_tasks(spark):
    root, n = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), 900
    os.makedirs(f"{root}/c")
    for i in range(n):
        with open(f"{root}/c/{i}.jsonl", "w") as f:
            f.write('{"v":%d}\n' % i + '\n{"v":"\\u2028"}\r\n{"v":0}' * (i == 7))
    open(f"{root}/c/empty.jsonl", "w").close()
    placed = spark.createDataFrame([(f"c/{i}.jsonl", i, 0, "snapshot") for i in range(n)] + [("c/empty.jsonl", n, 0, "snapshot")], "path string, shard int, delta_seq int, operation string")
    log = S._log(spark, root, ["c"], F.broadcast(placed))
    assert log.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    got = sorted((r.shard, r.line) for r in log.collect())
    read = spark.read.text(f"{root}/c").collect()  # the same lines as Spark's reader of lines has
    assert sorted(line for _, line in got) == sorted(r.value for r in read) and len(got) == n + 3
    assert [line for shard, line in got if shard == 7] == ["", '{"v":"\\u2028"}', '{"v":0}', '{"v":7}']

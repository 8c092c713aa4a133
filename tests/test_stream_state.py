"""State of streams: buckets that a batch touches, units of a pinned version, records with retention against their batch twin."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake.operators.replay import last_rows
from factlake.streaming import records
from factlake.streaming.state import Buckets, Units


def new_folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_batch_of_one_key_rewrites_one_bucket(spark):
    root = new_folder()
    schema = T.StructType().add("k", "long").add("v", "long")
    table = Buckets(spark, root, schema, "k", 8)
    fold = lambda rows, n: table.fold(spark.createDataFrame(rows, schema), n, lambda r: last_rows(r, "k", ["v"]))
    fold([(k, 0) for k in range(100)], 0)
    before = files(f"{root}/rows")
    fold([(7, 1), (7, 5), (7, 3)], 1)
    after = files(f"{root}/rows")
    assert {p: t for p, t in after.items() if p in before} == before and len({os.path.dirname(p) for p in set(after) - set(before)}) == 1
    assert dict(table.read(1).collect()) == dict.fromkeys(range(100), 0) | {7: 5}
    fold([(7, 1), (7, 6)], 1)  # the same batch again, with another end: it reads what the one before has left
    assert dict(table.read(1).collect())[7] == 6
    replaced = {p for p in before if table.manifest(0) != table.manifest(1) and f"state_bucket={next(b for b, n in table.manifest(1).items() if n == 1)}/" in p}
    fold([(8, 9)], 2)
    assert replaced and not replaced & set(files(f"{root}/rows"))  # what batch 1 replaced goes with batch 2
    assert dict(table.read(2).collect()) == dict.fromkeys(range(100), 0) | {7: 6, 8: 9} and table.batches() == [1, 2]
    with pytest.raises(ValueError, match="8 buckets"):
        Buckets(spark, root, schema, "k", 9).read(2)


def test_a_bucket_whose_keys_have_all_gone(spark):
    schema = T.StructType().add("k", "long").add("v", "long")
    table = Buckets(spark, new_folder(), schema, "k", 4)
    positive = lambda r: last_rows(r, "k", ["v"]).filter("v < 5")
    table.fold(spark.createDataFrame([(1, 0)], schema), 0, positive)
    table.fold(spark.createDataFrame([(1, 9)], schema), 1, positive)
    assert table.read(1).count() == 0 and table.read(None).count() == 0
    table.fold(spark.createDataFrame([], schema), 2, positive)
    table.fold(spark.createDataFrame([(None, 1), (1, 2)], schema), 3, positive)
    assert sorted(table.read(3).collect(), key=str) == [(1, 2), (None, 1)]


def test_units_of_a_pinned_version(spark):
    root = new_folder()
    listing = lambda tag: spark.createDataFrame([(f"u{i}", f"{tag}{i}") for i in range(4)], "unit string, content_sha256 string")
    out = f"{root}/data"
    work = Units(spark, f"{root}/progress")
    assert work.watermark() is None and work.begin("v1") == "v1"
    wrote = []

    def write(name, units, breaks=False):
        def data():
            units.write.mode("overwrite").parquet(f"{out}/{name}")
            wrote.append(name)

        def broken():
            data()
            raise RuntimeError("lost")

        return work.once(name, units, broken if breaks else data)

    first = work.pending(listing("a")).orderBy("unit").limit(2)
    with pytest.raises(RuntimeError):
        write("0", first, breaks=True)
    assert work.pending(listing("a")).count() == 4  # data without progress: the batch is done again and overwrites itself
    assert write("0", work.pending(listing("a")).orderBy("unit").limit(2)) and not write("0", first)
    assert wrote == ["0", "0"] and spark.read.parquet(f"{out}/*").count() == 2
    assert not work.close(listing("a"), "2026-01-01") and work.watermark() is None  # a partial set leaves the watermark
    again = Units(spark, f"{root}/progress")
    assert again.begin("v2") == "v1"  # the upstream has moved on, the run has not
    assert [r.unit for r in again.pending(listing("a")).orderBy("unit").collect()] == ["u2", "u3"]
    changed = listing("a").withColumn("content_sha256", F.when(F.col("unit") == "u0", "new").otherwise(F.col("content_sha256")))
    assert [r.unit for r in again.pending(changed).orderBy("unit").collect()] == ["u0", "u2", "u3"]
    assert write("1", again.pending(listing("a"))) and again.close(listing("a"), "2026-01-01") and again.watermark() == "2026-01-01"
    assert again.begin("v2") == "v2" and again.pending(listing("a")).count() == 4 and again.watermark() == "2026-01-01"


DAYS = [dt.datetime(2026, 1, d, tzinfo=dt.timezone.utc) for d in (1, 5, 12, 20, 31)]


def line(key, price, *, status="active", kev=False, aliases=(), kind="advisory"):
    facts = {"record_id": key, "source_id": "s", "kind": kind, "status": status, "affected": [price], "kev": kev, "aliases": list(aliases), "published_at": "2025-12-01T00:00:00Z", "title": "t"}
    return json.dumps(facts)


def run(spark, batches, **more):
    root, found = new_folder(), []
    schema = spark.createDataFrame([], "record_id string, seq long, at timestamp, line string").schema
    for now, rows in zip(DAYS, batches, strict=False):
        spark.createDataFrame([(k, i, now, text) for i, (k, text) in enumerate(rows)], schema).write.mode("append").parquet(f"{root}/in")
        out = records.record_events(spark, f"{root}/in", schema, retention_days=10.5, policy_version="1", where=f"{root}/run", buckets=4, **more)
        found.append(sorted((r.record_id, r.event_type, r.observed_at[:10]) for r in out.collect()))
    return found, out


def test_records_change_and_expire(spark):
    batches = [
        [("a", line("a", 1)), ("a", line("a", 2)), ("b", line("b", 1)), ("tool", line("tool", 1, kind="resource"))],
        [("a", line("a", 2)), ("b", line("b", 1, status="withdrawn"))],
        [("c", line("c", 1))],
        [("b", line("b", 1)), ("c", line("c", 1))],
        [("b", line("b", 1)), ("a", line("a", 2))],
    ]
    found, out = run(spark, batches)
    first = [("a", "disclosure", "2026-01-01"), ("b", "disclosure", "2026-01-01")]
    tool = ("tool", "template_added", "2026-01-01")
    assert found[0] == [*first, tool]
    assert found[1] == sorted([*found[0], ("b", "withdrawn", "2026-01-05")])  # the same record again is no change
    assert found[2] == sorted([*found[1], ("a", "retention_removed", "2026-01-11"), ("c", "disclosure", "2026-01-12")])
    # b's timer has moved to the 15th with its change and had not fired before its next row, which moves it on
    assert ("b", "disclosure", "2026-01-20") in found[3] and ("b", "retention_removed", "2026-01-15") not in found[3]
    assert sum(x[:2] == ("a", "disclosure") for x in found[4]) == 2  # dropped, hence new again
    assert ("b", "retention_removed", "2026-01-30") in found[4] and ("c", "retention_removed", "2026-01-22") in found[4] and not any(x[:2] == ("tool", "retention_removed") for x in found[4])
    rows = out.collect()
    assert len({r.event_id for r in rows}) == len(rows) and all(r.previous_hash and r.content_hash != r.previous_hash for r in rows if r.event_type == "retention_removed")


def test_exploited_records_protect_theirs(spark):
    batches = [
        [("a", line("a", 1, aliases=["X"])), ("d", line("d", 1, aliases=["X", "Y"])), ("k", line("k", 1, aliases=["X"], kev=True))],
        [],
        [("e", line("e", 1))],  # a and d are due, but protected
        [("a", line("a", 9, aliases=["X"])), ("k", line("k", 1, aliases=["X"]))],  # a is seen again: a change, not new; d is protected no more
    ]
    found, _ = run(spark, batches)
    assert not any(x[1] == "retention_removed" for x in found[2])
    assert sorted(set(found[3]) - set(found[2])) == [("a", "affected_corrected", "2026-01-20"), ("d", "retention_removed", "2026-01-11"), ("k", "kev_removed", "2026-01-20")]


def test_a_key_is_handled_by_rows(spark):
    """The keyed operator takes rows and gives rows: no frame is made for a key, and state is asked for once."""

    class Held:
        value, asked = None, 0

        def get(self):
            self.asked += 1
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        timers = set()
        registerTimer, deleteTimer = timers.add, timers.discard  # noqa: N815

    table = spark.createDataFrame([("a", n, DAYS[n], line("a", n, aliases=["X"])) for n in (0, 2, 1)], "record_id string, seq long, at timestamp, line string")
    rows = records.prepared(table).collect()
    operator = records._Records(1000)
    operator.held, operator.handle = Held(), Handle()
    last = max(rows, key=lambda r: r.seq)
    (moved,) = operator.handleInputRows(("a",), iter(rows), None)
    assert (moved.record_id, moved.old, moved.new, moved.aliases, moved.at) == ("a", None, last.compared, ["X"], last.at_ms)
    assert operator.held.asked == 1 and Handle.timers == {last.at_ms + 1000}
    assert list(operator.handleInputRows(("a",), iter([last]), None)) == []

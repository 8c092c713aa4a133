"""Operators on small operational tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factlake.functions import predicates as P
from factlake.operators import changes, costs, coverage, fragments, reconcile, replay, retention, shards


def day(n, h=0):
    return dt.datetime(2026, 9, n, h)


def test_replay_deletes_before_upserts(spark):
    checkpoint = spark.createDataFrame([("a", 1), ("b", 1)], "record_id string, v int")
    deltas = spark.createDataFrame([("a", None, 1, "delete"), ("a", 2, 1, "upsert"), ("b", None, 2, "delete"), ("c", 1, 1, "upsert")], "record_id string, v int, delta_seq int, operation string")
    log = replay.ranked(checkpoint, deltas)
    state = replay.replay(log, "record_id", ["delta_seq", "op_rank"], F.col("operation") == "delete")
    assert {(r.record_id, r.v) for r in state.collect()} == {("a", 2), ("c", 1)}
    asof = replay.replay(log, "record_id", ["delta_seq", "op_rank"], F.col("operation") == "delete", F.col("delta_seq") <= 0)
    assert {(r.record_id, r.v) for r in asof.collect()} == {("a", 1), ("b", 1)}
    assert replay.is_suffix(["a"], ["a", "b"], True) and not replay.is_suffix(["a"], ["b"], True) and not replay.is_suffix([], ["b"], False)
    late = spark.createDataFrame([(1, day(2)), (2, day(1)), (3, day(3))], "seq int, created_at timestamp")
    assert [r.seq for r in replay.chronological(late, "created_at", "seq").collect()] == [2]
    newest = replay.latest_per_id(spark.createDataFrame([("x", day(1)), ("y", day(2)), ("x", day(2))], "id string, at timestamp"), "id", "at")
    assert [r.id for r in newest.collect()] == ["x", "y"]


STATE = "struct<kind string, source_id string, status string, kev boolean, affected string, scores string, severity string, metrics string, assertion_metrics array<string>, semantic string, requirements string, dependencies string, sha256 string, proof array<string>, content_hash string, published_at string, source_modified_at string>"
BASE = dict(kind="advisory", source_id="cve", status="active", kev=None, affected="[]", scores=None, severity=None, metrics=None, assertion_metrics=["m", None], semantic="{}", requirements=None, dependencies=None, sha256=None, proof=[], content_hash="0" * 64, published_at="p", source_modified_at="m")


@pytest.mark.parametrize(
    ("old", "new", "types"),
    [
        (None, {}, ["disclosure"]),
        (None, {"kind": "poc"}, ["poc_added"]),
        (None, {"kind": "resource"}, ["template_added"]),
        (None, {"kev": True}, ["kev_added"]),
        (None, {"source_id": "kev"}, ["kev_added"]),
        (None, {"proof": ["affected", "scores", "metrics", "other"]}, ["affected_corrected", "score_changed"]),
        (None, {"proof": ["status"], "status": "rejected"}, ["rejected"]),
        ({}, {}, []),
        ({}, {"status": "withdrawn", "affected": "[1]"}, ["affected_corrected", "withdrawn"]),
        ({"status": "rejected"}, {}, ["disclosure"]),
        ({"status": "retention_removed"}, {}, []),
        ({}, {"status": "selection_removed"}, []),
        ({"kev": True}, {}, ["kev_removed"]),
        ({}, {"assertion_metrics": ["m"]}, ["score_changed"]),
        ({"kind": "poc"}, {"kind": "poc", "semantic": "{1}"}, ["poc_changed"]),
        ({"kind": "resource"}, {"kind": "resource", "sha256": "x", "requirements": "r"}, ["template_logic_changed", "template_requirements_changed"]),
    ],
)
def test_event_types(spark, old, new, types):
    frame = spark.createDataFrame([("r", None if old is None else {**BASE, **old}, {**BASE, **new})], f"record_id string, old {STATE}, new {STATE}")
    assert frame.select(changes.event_types().alias("t")).first().t == types


def test_events_of(spark):
    frame = spark.createDataFrame([("r", None, BASE), ("s", None, {**BASE, "proof": ["affected"]})], f"record_id string, old {STATE}, new {STATE}")
    out = changes.events_of(frame, F.lit("now"), F.lit("rev"), F.lit("1"))
    got = {r.record_id: r for r in out.collect()}
    assert got["r"].source_occurred_at == "p" and got["s"].source_occurred_at is None and got["r"].previous_hash is None and len(got["r"].event_id) == 64
    assert out.select(F.size(P.event_reasons()).alias("n")).agg(F.max("n")).first()[0] == 0
    again = changes.append_events(out, out)
    assert again.count() == 2
    assert changes.same_snapshot(out, again)


def test_batch_dedup_and_deletes(spark):
    batch = spark.createDataFrame([("a", 1, ["x"], 0), ("b", 1, ["q"], 1), ("a", 2, ["y"], 2)], "k string, v int, aliases array<string>, seq int")
    got = {r.k: (r.v, r.aliases, r.first_seq) for r in changes.dedup_batch(batch, "k", "seq", ["aliases"]).collect()}
    assert got == {"a": (2, ["x", "y"], 0), "b": (1, ["q"], 1)}
    cur = spark.createDataFrame([("a", "active"), ("b", "source_deleted")], "record_id string, status string")
    inv = spark.createDataFrame([("a",)], "record_id string")
    assert changes.authoritative_delete(cur, inv, False).collect() == cur.collect()
    assert {r.record_id for r in changes.missing(cur, inv, "record_id").collect()} == {"b"}


def test_record_constraints(spark):
    good = ("1.0", "s/n", "poc", "s", "n", ["a"], "active", None, None, None, "t", [], [], [], "a" * 64)
    schema = "schema_version string, record_id string, kind string, source_id string, native_id string, aliases array<string>, status string, title string, published_at string, source_modified_at string, first_seen_at string, affected array<string>, references array<string>, provenance array<string>, content_hash string"
    bad = [good[:2] + ("other",) + good[3:], good[:5] + (["a", "a"],) + good[6:], good[:14] + ("zz",)]
    ok, rest = P.split_valid(spark.createDataFrame([good, *bad], schema), P.record_reasons(10000))
    assert ok.count() == 1 and sorted(r.reasons[0] for r in rest.collect()) == ["aliases", "content_hash", "kind"]
    small, _ = P.split_valid(spark.createDataFrame([good], schema), P.record_reasons(100))
    assert small.count() == 0


def test_retention_and_cursor(spark):
    rows = [("a", "advisory", False, ["x"], day(1), None), ("b", "advisory", True, ["y"], day(1), None), ("c", "poc", None, ["y", "z"], day(1), None), ("d", "resource", None, [], day(1), None), ("e", "poc", None, [], None, None), ("f", "poc", None, [], day(1), day(20))]
    table = spark.createDataFrame([(*r, "active") for r in rows], "record_id string, kind string, kev boolean, aliases array<string>, published_at timestamp, last_material_event_at timestamp, status string")
    kept, removed = retention.expire(table, F.lit(day(10)))
    assert {r.record_id for r in kept.collect()} == {"b", "c", "d", "e", "f"} and [r.status for r in removed.collect()] == ["retention_removed"]
    held = spark.createDataFrame([("j1", day(1).date(), "settled"), ("j2", day(1).date(), "open"), ("j3", day(2).date(), "settled")], "job string, day date, status string")
    assert {r.job for r in retention.rollover(held, F.lit(day(2).date())).collect()} == {"j2", "j3"}
    keys = spark.createDataFrame([(i,) for i in range(6)], "k int")
    assert [r.k for r in retention.rotating_cursor(keys, "k", 3, F.col("k") != 5, 3).collect()] == [4, 0, 1]
    assert [r.k for r in retention.keyset_page(keys, "k", 3, 9).collect()] == [4, 5]
    assert retention.cut_events(spark.createDataFrame([(day(1),), (day(3),)], "observed_at timestamp"), F.lit(day(3))).count() == 1


def test_fragments(spark):
    rows = spark.createDataFrame([("small", "x"), ("big", "é" * 5000), ("empty", "")], "k string, line string")
    parents, parts = fragments.fragment(rows, "k", "line", 100, 64)
    assert fragments.problems(parents, parts, "k").count() == 0
    assert {r.k: r.line for r in fragments.reassemble(parents, parts, "k", "line").collect()} == {"small": "x", "big": "é" * 5000, "empty": ""}
    for broken in (parts.filter("part_index <> 3"), parts.union(parts.filter("part_index = 1")), parts.withColumn("payload", F.when(F.col("part_index") == 2, F.lit(b"?")).otherwise(F.col("payload"))), parts.withColumn("parent", F.lit("other"))):
        assert fragments.problems(parents, broken, "k").count() > 0
        with pytest.raises(Exception, match="damaged fragments"):
            fragments.reassemble(parents, broken, "k", "line").collect()
    z = rows.select("k", fragments.deflated(F.col("line").cast("binary")).alias("z")).select("k", fragments.inflated("z").cast("string").alias("line"))
    assert {r.k: r.line for r in z.collect()}["big"] == "é" * 5000


def test_assertion_ownership(spark):
    rows = [("r", ["i0", "i1", "i2"], [("cna", [0]), ("adp", [1, 0])])]
    frame = spark.createDataFrame(rows, "record_id string, affected array<string>, assertions array<struct<role string, affected_indices array<int>>>")
    items, owners = fragments.normalise_assertions(frame)
    assert owners.count() == 2 and {(r.affected_index, r.claims) for r in fragments.ownership_problems(items).collect()} == {(0, 2), (2, 0)}


def test_templates_and_dependencies(spark):
    stored = spark.createDataFrame([("a", "1", [("d", "9")]), ("b", "1", [("d", "8")]), ("c", "1", [])], "path string, sha string, dependencies array<struct<path string, sha string>>")
    now = spark.createDataFrame([("a", "1", 5, "100644"), ("b", "1", 5, "100644"), ("c", "2", 5, "100644"), ("d", "9", 5, "100644"), ("l", "3", 5, "120000")], "path string, sha string, size long, mode string")
    assert {r.path for r in reconcile.changed_templates(stored, now).collect()} == {"b", "c", "d", "l"}
    wants = spark.createDataFrame([("t", ["d", "gone", "l", "a", "b"])], "path string, dependencies array<string>")
    got = {r.dep_path: r.reason for r in reconcile.resolved_dependencies(wants, now, 15).collect()}
    assert got == {"d": None, "gone": "missing", "l": "not a file", "a": None, "b": "over budget"}


def test_reconciliation(spark):
    prev = spark.createDataFrame([("o1", ["s1"]), ("o2", ["s1", "s2"]), ("o3", ["s3"])], "record_id string, provenance_ids array<string>")
    gone = reconcile.touched_but_unwanted(prev, spark.createDataFrame([("s1",)], "source_record_id string"), spark.createDataFrame([("o2",)], "record_id string"))
    assert [r.record_id for r in gone.collect()] == ["o1"]
    k = lambda *x: spark.createDataFrame([(v,) for v in x], "k string")
    assert [r.k for r in reconcile.late_deletions(k("a", "b", "c"), k("b"), k("a", "b"), "k").collect()] == ["a"]
    state = spark.createDataFrame([("r1", ["a"]), ("r2", ["b"])], "record_id string, aliases array<string>")
    changed = spark.createDataFrame([("r2", ["c", "c"], "active"), ("r3", ["d"], "rejected")], "record_id string, aliases array<string>, status string")
    now = reconcile.maintained_aliases(state, changed, spark.createDataFrame([("r1",)], "record_id string"))
    assert {(r.record_id, tuple(r.aliases)) for r in now.collect()} == {("r2", ("c",))}
    entries = spark.createDataFrame([("k1", "h1"), ("k2", "h2")], "key string, url_sha256 string")
    assert reconcile.carried_over(entries, spark.createDataFrame([("k1", "h1"), ("k2", "other")], "key string, url_sha256 string")).count() == 1
    out = reconcile.excluded_references(spark.createDataFrame([("r", 0, "u", "x"), ("r", 0, "u", "x"), ("r", 1, None, "y")], "record_id string, reference_index int, url string, reason string"))
    assert out.count() == 2
    m = spark.sql("select map('a', 1, 'b', 2) as m, map('b', 3, 'c', 4) as u").select(reconcile.without(F.col("m"), F.array(F.lit("a"))).alias("x"), reconcile.with_entries(F.col("m"), F.col("u")).alias("y")).first()
    assert m.x == {"b": 2} and m.y == {"a": 1, "b": 3, "c": 4}
    cand = spark.createDataFrame([("a", True, False, None, "active", "same"), ("b", False, False, None, "active", "same"), ("c", False, False, None, "rejected", "absent"), ("d", False, False, None, "active", "absent"), ("e", False, False, None, "active", "changed"), ("f", False, False, day(9), "active", "changed"), ("g", False, False, None, "active", "changed")], "k string, has_watermark boolean, stored boolean, published_at timestamp, status string, baseline string")
    proof = spark.createDataFrame([("e", day(8))], "k string, changed_at timestamp")
    assert {r.k: r.verdict for r in reconcile.admission(cand, proof, "k", F.lit(day(5))).collect()} == {"a": "admit", "b": "drop", "c": "admit", "d": "pending", "e": "admit", "f": "admit", "g": "pending"}


def test_runs_and_availability(spark):
    runs = spark.createDataFrame(
        [("r", 1, "workflow_dispatch", "completed", "success", day(2), day(2), day(2), day(3)), ("r", 2, "schedule", "completed", "failure", day(2), day(2), day(2), day(3)), ("r", 3, "schedule", "queued", None, day(2), day(1), day(2), day(3)), ("q", 4, "schedule", "completed", "success", day(9), day(9), day(9), day(9))],
        "repository string, id int, event string, status string, conclusion string, created_at timestamp, run_started_at timestamp, updated_at timestamp, sampled_at timestamp",
    )
    got = {r.repository: r for r in coverage.window_successes(runs).collect()}
    assert got["r"].manual and not got["r"].scheduled and got["r"].failed == [2] and got["r"].pending == [3] and got["q"].scheduled
    assert {r.id for r in runs.filter(coverage.run_in_window(F.lit(day(1)), F.lit(day(5)))).collect()} == {1, 2}
    assert coverage.listing_complete(runs, 4, F.lit(day(1)), F.lit(day(9))).first().complete and not coverage.listing_complete(runs, 5, F.lit(day(1)), F.lit(day(9))).first().complete
    entries = spark.createDataFrame([("k1", day(5)), ("k2", day(1))], "key string, next_check_at timestamp")
    row = coverage.availability(entries, 3, 1, F.lit(day(2))).first()
    assert (row.retained, row.fresh, row.due, row.coverage) == (2, 1, 2, "partial")


def test_observation_window(spark):
    t0 = dt.datetime(2026, 9, 1)
    at = lambda k, *minutes: [(k, t0 + dt.timedelta(minutes=m), bad) for m, bad in minutes]
    rows = at("good", (0, False), (15, False), (30, False)) + at("gap", (0, False), (15, False), (60, False), (75, False)) + at("bad", (0, False), (15, True), (30, False)) + at("first", (0, True), (15, False))
    frame = spark.createDataFrame(rows, "k string, at timestamp, bad boolean")
    got = {r.k: (r.status, r.qualified_seconds, r.seconds_before_break) for r in coverage.qualification(frame, "k", "at", F.col("bad"), 960, 1800).collect()}
    assert got == {"good": ("review_required", 1800.0, 0.0), "gap": ("invalid", 0.0, 900.0), "bad": ("invalid", 0.0, 0.0), "first": ("start_rejected", 0.0, 0.0)}


def test_costs(spark):
    rows = spark.createDataFrame([("j1", 61), ("j2", 1)], "job_id string, seconds int")
    held = spark.createDataFrame([("j1", 9), ("j3", 5)], "job_id string, reserved_minutes long")
    assert {r.job_id: r.minutes for r in costs.settled_minutes(held, rows).collect()} == {"j1": 2, "j3": 5}
    heads = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "branch string, sha string")
    got = costs.reference_accounting(heads, spark.createDataFrame([("a", "1"), ("b", "0")], "branch string, sha string"), spark.createDataFrame([("b", "2")], "branch string, sha string"))
    assert {r.branch: r.status for r in got.collect()} == {"a": "accounted", "b": "recovered", "c": "unaccounted"}
    commits = spark.createDataFrame([("t", ["zz"]), ("x", ["t", "u"]), ("r", [])], "sha string, parents array<string>")
    tips = spark.createDataFrame([("t",)], "sha string")
    assert [(r.sha, r.parent) for r in costs.unknown_parents(commits, tips).collect()] == [("x", "u")]
    steps = spark.createDataFrame([(1, "a", "1"), (2, "b", "2"), (3, "a", "3")], "n int, branch string, sha string")
    assert [(r.tip_a, r.tip_b) for r in costs.tips_after(steps, ["a", "b"], "n", "branch", "sha").orderBy("n").collect()] == [("1", None), ("1", "2"), ("3", "2")]
    assert [r.p for r in spark.createDataFrame([(day(1),), (day(3),)], "at timestamp").select(costs.phase(F.col("at"), F.lit(day(2))).alias("p")).collect()] == ["initialization", "steady"]


def test_chain_replay_equals_heap_merge(spark):
    import heapq
    import random

    random.seed(4)
    for _ in range(3):
        chains = {c: [(random.randint(1, 9), f"{c}{i}") for i in range(random.randint(1, 8))] for c in "abc"}
        heap, expected = [(v[0][0], c, v[0][1], 0) for c, v in chains.items()], []
        heapq.heapify(heap)
        while heap:
            _, c, sha, i = heapq.heappop(heap)
            expected.append(sha)
            if i + 1 < len(chains[c]):
                heapq.heappush(heap, (chains[c][i + 1][0], c, chains[c][i + 1][1], i + 1))
        frame = spark.createDataFrame([(c, i, t, s) for c, v in chains.items() for i, (t, s) in enumerate(v)], "branch string, pos int, ts int, sha string")
        got = [r.sha for r in costs.chain_order(frame, "branch", "pos", "ts", "sha").orderBy("replay_key", "pos").collect()]
        assert got == expected


def test_shard_plan_is_the_recursive_one(spark):
    import hashlib

    rows = [(f"k{i}", "s1" if i % 3 else "s2", 10 + i % 7) for i in range(400)]
    plan = {r.k: r.prefix for r in shards.shard_plan(spark.createDataFrame(rows, "k string, part string, size int"), ["part"], "k", "size", 40).collect()}

    def split(members, depth):
        groups = {}
        for k, p, s in members:
            groups.setdefault((p, hashlib.sha256(k.encode()).hexdigest()[:depth]), []).append((k, p, s))
        for (_, prefix), own in groups.items():
            if len(own) == 1 or sum(x[2] for x in own) <= 40:
                yield from ((x[0], prefix) for x in own)
            else:
                yield from split(own, depth + 1)

    assert plan == dict(split(rows, 2))
    a = spark.createDataFrame([(i, f"h{i}") for i in range(50)], "k int, h string")
    assert shards.snapshot_digest(a, "k", "h").first() == shards.snapshot_digest(a.repartition(7), "k", "h").first()
    old = spark.createDataFrame([("p", "1", 5), ("q", "2", 7)], "path string, sha256 string, bytes long")
    new = spark.createDataFrame([("p", "1", 5), ("q", "3", 8), ("r", "4", 2)], "path string, sha256 string, bytes long")
    assert shards.changed_bytes(old, new).first().changed_bytes == 10


def test_material_difference(spark):
    frame = spark.createDataFrame([({**BASE}, {**BASE, "assertion_metrics": ["m"]}), ({**BASE}, {**BASE, "assertion_metrics": ["n"]}), ({**BASE}, {**BASE, "status": "x"})], f"old {STATE}, new {STATE}")
    assert [r.d for r in frame.select(changes.material_differs(F.col("old"), F.col("new")).alias("d")).collect()] == [False, True, True]


def test_shard_plan_joins_by_equality(spark):
    rows = spark.createDataFrame([(None if i % 3 == 0 else "p", f"k{i}", 100) for i in range(3000)], "part string, k string, size long")
    planned = shards.shard_plan(rows, ["part"], "k", "size", 1000)
    got = planned.collect()
    import collections
    import hashlib

    sums = collections.Counter((r.part, r.prefix) for r in got)
    assert len(got) == 3000 and all(hashlib.sha256(r.k.encode()).hexdigest().startswith(r.prefix) for r in got)
    assert max(sums.values()) <= 10 and len({len(p) for _, p in sums}) > 1
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" not in plan and "NestedLoop" not in plan


def test_shard_plan_of_few_and_of_many_digits(spark):
    """Groups that fit at two to four digits, and groups that need more, in one plan; whether these are sent to all tasks or not."""
    import hashlib

    rows = [(f"k{i}", None if i % 2 else "p", 1 if i % 7 else 1000) for i in range(6000)]
    frame = spark.createDataFrame(rows, "k string, part string, size int")

    def split(members, depth):
        groups = {}
        for k, p, s in members:
            groups.setdefault((p, hashlib.sha256(k.encode()).hexdigest()[:depth]), []).append((k, p, s))
        for (_, prefix), own in groups.items():
            if len(own) == 1 or sum(x[2] for x in own) <= 10:
                yield from ((x[0], prefix) for x in own)
            else:
                yield from split(own, depth + 1)

    expected = dict(split(rows, 2))
    assert {len(p) for p in expected.values()} >= {2, 3, 4, 5}
    sent = shards.MOST_SENT
    try:
        for shards.MOST_SENT in (sent, 0):
            planned = shards.shard_plan(frame, ["part"], "k", "size", 10)
            assert {r.k: r.prefix for r in planned.collect()} == expected
    finally:
        shards.MOST_SENT = sent
    assert shards.shard_plan(frame.limit(0), ["part"], "k", "size", 10).collect() == []
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_differences_are_upserts_and_deletes(spark):
    prior = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), (None, "1"), ("n", None)], "k string, line string")
    cur = spark.createDataFrame([("x", "a", "1"), ("x", "b", "2"), ("y", "b", "1"), ("y", "d", "1"), ("y", "d", "2"), ("z", None, "1"), ("z", "n", None)], "source string, k string, line string")
    got = sorted(map(str, changes.differences(prior, cur, "k", "line").collect()))
    ups = changes.upserts(prior, cur, "k", "line").withColumn("op", F.lit("upsert"))
    gone = changes.deletes(prior, cur, "k").select(F.lit(None).cast("string").alias("source"), "k", F.lit(None).cast("string").alias("line"), F.lit("delete").alias("op"))
    assert got == sorted(map(str, ups.union(gone).collect())) and len(got) == 7


def test_snapshot_digest_of_more_digits(spark):
    import hashlib

    rows = [(i, f"h{i}") for i in range(500)]
    frame = spark.createDataFrame(rows, "k long, h string")
    got = shards.snapshot_digest(frame, "k", "h", 4).first()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    level = {}
    for k, h in rows:
        level.setdefault(sha(str(k))[:4], []).append(f"{k}:{h}")
    level = {b: sha(",".join(sorted(p))) for b, p in level.items()}
    up = {}
    for b in sorted(level):
        up.setdefault(b[:2], []).append(level[b])
    assert got.digest == sha(",".join(sha(",".join(up[b])) for b in sorted(up))) and got.n_rows == 500
    assert shards.snapshot_digest(frame.repartition(5), "k", "h", 4).first() == got


def test_chain_order_in_blocks(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = [(c, p, rng.randint(0, 50), f"{c}{p}") for c in ("a", "b", None) for p in rng.sample(range(1000), 60)]
    frame = spark.createDataFrame(rows, "branch string, pos long, ts long, sha string").repartition(4)
    whole = {r.sha: tuple(r.replay_key) for r in costs.chain_order(frame, "branch", "pos", "ts", "sha").collect()}
    monkeypatch.setattr(costs, "BLOCK_ROWS", 7)
    blocks = {r.sha: tuple(r.replay_key) for r in costs.chain_order(frame, "branch", "pos", "ts", "sha").collect()}
    expected = {sha: max(((t, c or "", s) for c2, p2, t, s in rows for c in [c2] if c2 == chain and p2 <= pos)) for chain, pos, _, sha in rows}
    assert whole == blocks and {s: (k[0], k[1] or "", k[2]) for s, k in blocks.items()} == expected


def test_events_of_one_id_are_the_same_however_dealt(spark):
    prior = spark.createDataFrame([("e1", 9)], "event_id string, v int")
    new = spark.createDataFrame([("e1", 1), ("e2", 5), ("e2", 3), ("e2", 4)], "event_id string, v int")
    for n in (1, 4):
        assert sorted(map(tuple, changes.append_events(prior, new.repartition(n)).collect())) == [("e1", 9), ("e2", 3)]


def test_addresses_that_are_global(spark):
    import ipaddress

    hosts = ["224.0.0.1", "239.255.255.250", "240.0.0.1", "255.255.255.255", "192.0.0.8", "192.0.0.9", "192.0.0.10", "192.0.2.1", "100.64.0.1", "100.128.0.1", "172.32.0.1", "198.20.0.1", "8.8.8.8", "169.254.1.1", "203.0.113.9"]
    frame = spark.createDataFrame([(f"https://{h}/x", h) for h in hosts], "url string, h string")
    got = {r.h: r.reason for r in frame.select("h", P.official_reference_reason(F.col("url")).alias("reason")).collect()}
    assert got == {h: None if ipaddress.ip_address(h).is_global else "non_public_url_host" for h in hosts}


def test_baseline_and_active_ids(spark):
    versions = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 9, "z"), ("b", 9, "late"), ("c", 4, None)], "k string, at int, v string")
    got = reconcile.baseline(versions, "k", "at", F.lit(5)).collect()
    assert sorted((r.k, r.at, r.v or "") for r in got) == [("a", 3, "y"), ("c", 4, "")]
    records = spark.createDataFrame([("active", ["x", "y"]), ("active", ["y"]), ("withdrawn", ["z"]), ("active", []), ("active", None)], "status string, aliases array<string>")
    assert sorted(r.alias for r in reconcile.active_ids(records).collect()) == ["x", "y"]


def test_public_urls_and_truncation(spark):
    from factlake.functions.hashing import truncated
    from factlake.functions.predicates import public_url

    cases = {"https://a.example/x": True, "https://@host/": True, "https://:@host/": True, "http://user@host/": False, "https://:secret@host/": False, "https:///x": False, "https://@/": False, "ftp://a/": False, "https://:80/": False, "HTTPS://a": True}
    got = {r.u: r.ok for r in spark.createDataFrame([(u,) for u in cases], "u string").select("u", public_url(F.col("u")).alias("ok")).collect()}
    assert got == cases
    assert spark.createDataFrame([("éabc",), (None,)], "t string").select(truncated(F.col("t"), 2)).collect() == [("éa",), (None,)]


def test_metrics_are_taken_while_rows_are_written(spark):
    import tempfile

    from pyspark.sql import functions as F

    from factlake.operators import coverage

    root, names = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), ["a", "b", "none"]
    table = spark.createDataFrame([("a", 3), ("a", 4), ("b", None), ("c", 5), (None, 1)], "source string, size long")
    rows, seen = coverage.measured(table, coverage.health_metrics("source", "size", names))
    rows.write.parquet(f"{root}/t")
    assert spark.read.parquet(f"{root}/t").count() == 5
    got = sorted(map(tuple, coverage.measured_health(spark, seen, "source", names).collect()), key=str)
    assert got == sorted([("a", 2, 7), ("b", 1, 0), (None, 2, 6)], key=str)
    assert {r.metric: (r.observed, r.exceeded) for r in coverage.measured_thresholds(spark, seen, {"n_rows": 4, "bytes": 100}).collect()} == {"n_rows": (5.0, True), "bytes": (13.0, False)}
    assert "Aggregate" not in rows._jdf.queryExecution().executedPlan().toString()  # one scan, no shuffle
    empty, seen = coverage.measured(table.limit(0), {"longest": F.max("size")} | coverage.health_metrics("source", "size", names))
    empty.write.parquet(f"{root}/e")
    assert coverage.measured_health(spark, seen, "source", names).count() == 0
    (row,) = coverage.measured_thresholds(spark, seen, {"longest": 1}).collect()
    assert row.observed is None and row.exceeded is False

"""Feed batches into state, events, quarantine and source status; and the schema checks that they rest on."""

import json

import pytest
from pyspark.sql import functions as F

from factlake.functions.schemas import EVENT, RECORD, violations, with_fields
from factlake.operators import ingest as I
from factlake.plans import ingest_queries

NOW, LATER = "2026-01-02T00:00:00Z", "2026-01-03T00:00:00Z"
ROW = {
    "record_id": "feed/A-1", "source_id": "feed", "native_id": "A-1", "kind": "advisory", "aliases": ["CVE-2020-1234"], "status": "active", "title": "one", "published_at": "2026-01-01T00:00:00Z",
    "source_modified_at": "2026-01-01T00:00:00Z", "affected": [{"ranges": "<1"}], "references": [], "provenance": [{"source_id": "feed", "revision": "r1", "url": "u1"}],
}


class Lake:
    """State, log and source rows from batch to batch."""

    def __init__(self, spark):
        self.spark, self.sources = spark, {}
        self.state, self.log = spark.createDataFrame([], I.STATE_COLUMNS), spark.createDataFrame([], I.EVENT_COLUMNS)

    def apply(self, *rows, inventory=None, now=NOW, source_id="feed", **more):
        batch = self.spark.createDataFrame([(r["record_id"], i, r["line"] if "line" in r else json.dumps(r)) for i, r in enumerate(rows)], "record_id string, seq int, line string")
        listed = None if inventory is None else self.spark.createDataFrame([(x,) for x in inventory], "record_id string")
        done = I.ingest(self.state, batch, self.log, self.sources.get(source_id, {}), source_id=source_id, revision=more.pop("revision", "rev"), now=now, policy_version="1", inventory=listed, **more)
        state, log = done.state.collect(), done.events.collect()
        self.bad = {r.record_id: r.reasons for r in done.quarantine.collect()}
        self.sources[source_id] = done.source.first().asDict()
        done.release()
        self.state, self.log = self.spark.createDataFrame(state, I.STATE_COLUMNS), self.spark.createDataFrame(log, I.EVENT_COLUMNS)
        self.records, self.events = {r.record_id: json.loads(r.line) for r in state}, log
        return sorted(e.event_type for e in log)


@pytest.fixture
def lake(spark):
    return Lake(spark)


def test_the_same_batch_twice_changes_nothing(lake):
    assert lake.apply(ROW) == ["disclosure"]
    first = lake.records
    assert lake.apply(ROW, now=LATER) == ["disclosure"] and lake.records == first
    assert first["feed/A-1"]["first_seen_at"] == first["feed/A-1"]["last_material_event_at"] == NOW


def test_revisions_of_a_collection_are_no_change(lake):
    lake.apply(ROW | {"mapping_history": {"x": {"reason": "mapped", "source_revision": "a"}}})
    first = lake.records
    polled = ROW | {"source_modified_at": LATER, "provenance": [{"source_id": "feed", "revision": "r2", "url": "u2"}], "mapping_history": {"x": {"reason": "mapped", "source_revision": "b"}}, "assessment": {"level": "high"}}
    assert lake.apply(polled, now=LATER) == ["disclosure"] and lake.records == first


def test_changes_become_typed_events_and_a_silent_one_keeps_its_date(lake):
    lake.apply(ROW)
    assert lake.apply(ROW | {"affected": []}, now=LATER) == ["affected_corrected", "disclosure"]
    assert lake.records["feed/A-1"]["last_material_event_at"] == LATER and lake.records["feed/A-1"]["first_seen_at"] == NOW
    before = lake.records["feed/A-1"]["content_hash"]
    assert lake.apply(ROW | {"affected": [], "title": "two"}, now="2026-01-09T00:00:00Z") == ["affected_corrected", "disclosure"]
    row = lake.records["feed/A-1"]
    assert row["title"] == "two" and row["content_hash"] != before and row["last_material_event_at"] == LATER
    assert lake.apply(ROW | {"affected": [], "metrics": {"score": 9.8}, "status": "withdrawn"}) == ["affected_corrected", "disclosure", "score_changed", "withdrawn"]


def test_a_proven_bootstrap_change_has_a_window(lake):
    proof = {"changed_fields": ["status"], "window_start": "2025-12-01T00:00:00Z", "window_end": NOW, "baseline_revision": "b"}
    assert lake.apply(ROW | {"bootstrap_material_change": proof}) == ["disclosure"]
    event = lake.events[0]
    assert event.source_occurred_at is None and event.source_occurrence_window.asDict() == {"from": proof["window_start"], "to": NOW, "baseline_revision": "b"}


def test_only_a_whole_inventory_deletes(lake):
    lake.apply(ROW, ROW | {"record_id": "feed/A-2", "native_id": "A-2"})
    lake.apply(inventory=[], status="partial")
    assert lake.records["feed/A-1"]["status"] == "active"
    lake.apply(ROW | {"title": 7}, inventory=[])  # something invalid
    assert lake.records["feed/A-2"]["status"] == "active" and lake.sources["feed"]["status"] == "partial"
    assert lake.apply(inventory=["feed/A-1"], now=LATER) == ["disclosure", "disclosure", "source_deleted"]
    gone = lake.records["feed/A-2"]
    assert gone["status"] == "source_deleted" and gone["last_material_event_at"] == LATER and lake.records["feed/A-1"]["status"] == "active"
    assert lake.apply(inventory=["feed/A-1"], now=NOW) == ["disclosure", "disclosure", "source_deleted"]  # it is gone already
    assert lake.apply(ROW | {"record_id": "feed/A-2", "native_id": "A-2"}) == ["disclosure", "disclosure", "disclosure", "source_deleted"]


def test_a_removed_flag_has_an_event_of_its_own(lake):
    row = ROW | {"record_id": "kev/1", "source_id": "kev", "kev": True}
    assert lake.apply(row, source_id="kev", inventory=["kev/1"]) == ["kev_added"]
    assert lake.apply(source_id="kev", inventory=[]) == ["kev_added", "kev_removed"] and lake.records["kev/1"]["kev"] is False


def test_sources_keep_apart(lake):
    lake.apply(ROW)
    lake.apply(ROW | {"record_id": "other/A-1", "source_id": "other"}, source_id="other", inventory=["other/A-1"])
    assert {r["status"] for r in lake.records.values()} == {"active"} and len(lake.records) == 2


def test_watermarks_move_only_with_whole_batches(lake):
    lake.apply(ROW, watermark="old", revision="r1")
    lake.apply(ROW | {"title": "new"}, status="partial", watermark="old", continuation="page 2", revision="r2")
    source = lake.sources["feed"]
    assert (source["completed_watermark"], source["continuation"], source["revision"], source["last_success_at"]) == ("old", "page 2", "r2", NOW)
    for bad in ({"affected": [{"x": "y" * 300000}]}, {"affected": "none"}, {"aliases": ["a", "a"]}, {"content": 1, "title": 3}):
        lake.apply(ROW | bad, ROW | {"record_id": "feed/good", "title": str(bad)[:9]}, watermark="new", revision="r3", now=LATER)
        source = lake.sources["feed"]
        assert source["status"] == "partial" and source["completed_watermark"] == "old" and source["continuation"] == "page 2" and source["revision"] == "r2" and source["invalid"] == 1
        assert list(lake.bad) == ["feed/A-1"] and "feed/good" in lake.records and lake.records["feed/A-1"]["title"] == "new"
    lake.apply({"record_id": "feed/broken", "line": "{"}, watermark="new")
    assert lake.bad == {"feed/broken": ["$: not JSON"]} and "feed/broken" not in lake.records


def test_the_last_of_a_repeated_id_counts(lake):
    lake.apply(ROW | {"title": "a"}, ROW | {"title": "b"})
    assert lake.records["feed/A-1"]["title"] == "b" and len(lake.events) == 1


def test_violations(spark):
    schema = {
        "type": "object", "required": ["a", "b c"], "additionalProperties": False, "maxProperties": 4, "propertyNames": {"maxLength": 3},
        "properties": {
            "a": {"type": ["integer", "null"], "minimum": 1, "exclusiveMaximum": 5}, "b c": {"type": "array", "minItems": 1, "maxItems": 2, "uniqueItems": True, "items": {"type": "object", "required": ["x"], "properties": {"x": {"enum": [1, "y", None]}}}},
            "d": {"anyOf": [{"type": "string", "pattern": "^[a-z]+$", "minLength": 2}, {"const": {"k": [1, 2]}}]}, "e": {"not": {"type": "boolean"}},
        },
    }
    cases = [
        ('{"a":1,"b c":[{"x":1}]}', []),
        ('{"a":null,"b c":[{"x":"y"},{"x":null}],"d":"ab","e":1}', []),
        ('{"a":2.0,"b c":[{"x":1}],"d":{"k":[1,2]}}', []),
        ('{"a":5,"b c":[]}', ["$.a: breaks exclusiveMaximum 5", "$.b c: too few items"]),
        ('{"a":"1","b c":[{"x":2},{"x":2},3]}', ["$.a: not of type integer or null", "$.b c: items repeat", "$.b c: too many items", "$.b c[0].x: not one of the values", "$.b c[1].x: not one of the values", "$.b c[2]: not of type object"]),
        ('{"b c":[{}],"d":"A","e":true,"long":1}', ["$.b c[0]: lacks x", "$.d: fits none of anyOf", "$.e: fits what it must not", "$.long: not allowed", "$.long: too long", "$: lacks a"]),
        ("[1]", ["$: not of type object"]),
        ("nothing", ["$: not JSON"]),
        (None, ["$: not JSON"]),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", violations(F.col("t"), schema).alias("v")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
    with pytest.raises(ValueError, match="dependentRequired"):
        violations(F.col("t"), {"dependentRequired": {}})


def test_formats(spark):
    row = ROW | {"schema_version": "1.0", "first_seen_at": NOW, "content_hash": "a" * 64}
    event = dict(schema_version="1.0", event_id="b" * 64, record_id="r", event_type="disclosure", previous_hash=None, content_hash="c", source_revision=None, source_occurred_at=None, observed_at=NOW, policy_version="1")
    cases = [(row, RECORD, 0), (row | {"content_hash": "A" * 64}, RECORD, 1), (row | {"kind": "x", "aliases": ["a", "a", 1]}, RECORD, 3), (event, EVENT, 0), (event | {"event_id": "", "event_type": "x"}, EVENT, 2)]
    for value, schema, n in cases:
        assert len(spark.createDataFrame([(json.dumps(value),)], "t string").select(violations(F.col("t"), schema)).first()[0]) == n
    del event["policy_version"]
    assert spark.createDataFrame([(json.dumps(event),)], "t string").select(violations(F.col("t"), EVENT)).first()[0] == ["$: lacks policy_version"]


def test_with_fields(spark):
    df = spark.createDataFrame([('{"b":[1,{"x":null}],"a":1,"q":"é\\""}',), (None,)], "t string")
    got = [r[0] for r in df.select(with_fields(F.col("t"), {"a": F.lit('"new"'), "z": F.lit("null")})).collect()]
    assert got == ['{"a":"new","b":[1,{"x":null}],"q":"é\\"","z":null}', None]


def test_each_step_is_computed_once(spark):
    """What an expression names several times is parsed, hashed and checked once a row, nested values too."""
    checks = str(violations(F.col("line"), RECORD))
    assert checks.count("try_parse_json(") == 1
    judged = str(I._judged(RECORD, I.MOST_BYTES, NOW))
    assert judged.count("try_parse_json(") == 1 and judged.count("sha2(") == 1


def test_a_value_is_typed_once(spark):
    """However many keywords look at a value, its type is named once, at each depth."""
    schema = {"type": "object", "required": ["a", "b", "c"], "maxProperties": 3, "properties": {"a": {"type": ["string", "null"], "minLength": 2, "maxLength": 3, "pattern": "^x"}}}
    assert str(violations(F.col("t"), schema)).count("schema_of_variant(") == 2


def test_reasons_are_found_once(spark):
    """No filter on the reasons makes a document be parsed and judged twice."""
    found = ingest_queries.schema_quarantine(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan
    assert {"doc_id", "reasons"} == set(found.columns) and found.filter("reasons is null or reasons = ''").isEmpty()

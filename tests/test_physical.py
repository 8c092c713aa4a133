"""Physical lines of long records: golden files, every form there and back, and damage of every kind."""

import base64
import copy
import hashlib
import json
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from factlake.operators import physical as P
from factlake.plans import queries as core

DATA = os.path.join(os.path.dirname(__file__), "data")
text = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def base(ident="feed/1", **more):
    source, native = ident.split("/")
    return dict(schema_version="1.0", record_id=ident, source_id=source, native_id=native, kind="advisory", status="active", title="t", aliases=[], published_at=None, source_modified_at=None, first_seen_at="2026-01-01T00:00:00Z", content_hash="a" * 64, affected=[], references=[], provenance=[]) | more


def noise(n, seed=1):
    return base64.b64encode(random.Random(seed).randbytes(n)).decode()


def owned(n=300, assertions=2, **more):
    """A record whose affected items repeat what its assertions say."""
    says = [{"role": "cna" if a == 0 else "adp", "provider": {"orgId": f"org{a}", "shortName": "名" * 20, "dateUpdated": "2026"}, "affected_indices": list(range(a, n, assertions)), "descriptions": [{"value": "d" * 50}]} for a in range(assertions)]
    items = [{"product": f"p{i}", "assertion_role": says[i % assertions]["role"], "provider": {k: v for k, v in says[i % assertions]["provider"].items() if k != "dateUpdated"}} for i in range(n)]
    sources = [{"source_id": "cve", "revision": "r"}, *[{"source_id": "cve", "role": s["role"], "provider": s["provider"], "independent_evidence": s["role"] == "cna"} for s in says]]
    return base("cve/C-1", affected=items, assertions=says, provenance=sources, descriptions=[{"value": "d" * 50}]) | more


def lines(spark, *rows):
    return spark.createDataFrame([(r["record_id"], text(r)) for r in rows], "record_id string, line string")


def split(spark, *rows):
    return [json.loads(r.line) for r in P.physical(lines(spark, *rows)).orderBy("record_id").collect()]


def back(spark, rows):
    return [json.loads(r.line) for r in P.logical(lines(spark, *rows).repartition(3)).orderBy("record_id").collect()]


def test_golden_files(spark):
    golden, record = (json.load(open(f"{DATA}/{f}.json")) for f in ("physical_lines", "logical_record"))
    made = P.physical(lines(spark, record)).orderBy("record_id").collect()
    assert [r.line for r in made] == [text(g) for g in golden]
    assert back(spark, golden) == [record]


FORMS = {
    "inline": base(title="short"),
    "plain": base(title=noise(30000)),
    "json-zlib-v3": base("cve/2", title="x" * 30000),
    "json-affected-v2": base(affected=[{"product": noise(300, i)} for i in range(700)]),
    "json-zlib-affected-v2": base("cve/3", affected=[{"product": f"product {i} " * 12} for i in range(2712)]),
    "json-affected-ranges-v4": base(affected=[{"product": "p", "original_ranges": [{"version": noise(300, i)} for i in range(700)]}]),
    "json-zlib-affected-ranges-v4": base("cve/4", affected=[{"product": "p", "original_ranges": [{"version": str(i), "expression": "x" * 50} for i in range(5000)]}]),
}


def test_every_form_there_and_back(spark):
    rows = list(FORMS.values())
    for i, r in enumerate(rows):
        r["record_id"] = f"{r['source_id']}/{i}"
        r["native_id"] = str(i)
    made = split(spark, *rows)
    forms = {r["record_id"]: r["continuation"]["format"] for r in made if "continuation" in r}
    names = {"plain": "json-utf8-v1", "json-zlib-affected-v2": "json-zlib-affected-v3"}
    assert forms == {r["record_id"]: names.get(k, k) for k, r in FORMS.items() if k != "inline"}
    assert all(len(text(r).encode()) < 16384 for r in made) and len(made) > 60
    random.Random(0).shuffle(made)
    assert back(spark, made) == sorted(rows, key=lambda r: r["record_id"])


def test_repeated_owners_are_left_out_only_if_they_can_be_rebuilt(spark):
    good = owned()
    cases = [good, owned(assertions=1), owned(descriptions=[{"value": "other"}]), owned(source_id="feed")]
    for change in (lambda r: r["affected"][3].update(assertion_role="x"), lambda r: r["affected"][4]["provider"].update(more=1), lambda r: r["assertions"][0]["affected_indices"].append(1), lambda r: r["provenance"].pop(), lambda r: r["assertions"][1].pop("role")):
        cases.append(copy.deepcopy(good))
        change(cases[-1])
    without = owned()
    del without["descriptions"]
    cases.append(without)
    df = spark.createDataFrame([(i, text(r)) for i, r in enumerate(cases)], "i int, line string")
    got = df.select("i", P.compacted(F.col("line")).alias("short"), "line").withColumn("back", P.expanded(F.col("short"))).orderBy("i").collect()
    assert [len(r.short) < len(r.line) for r in got] == [True, True, False, False, False, False, False, False, False, True]
    assert all(r.back == r.line for r in got)
    short = json.loads(got[0].short)
    assert "provider" not in short["affected"][0] and short["provenance"][1] == {"source_id": "cve", "assertion_index": 0, "independent_evidence": True} and "descriptions" not in short
    for change in (lambda r: r["affected"][0].update(product="q"), lambda r: r["assertions"][0]["affected_indices"].pop(), lambda r: r["record_encoding"].update(expanded_bytes=9), lambda r: r["record_encoding"].update(top_descriptions_assertion_index=7), lambda r: r["affected"][0].update(provider={}), lambda r: r["provenance"][1].update(assertion_index=1)):
        bad = copy.deepcopy(short)
        change(bad)
        with pytest.raises(Exception, match="can't be rebuilt"):
            spark.createDataFrame([(text(bad),)], "line string").select(P.expanded(F.col("line"))).collect()


def test_what_fits_no_form_fails(spark):
    huge = {"x": "y" * 300000}
    for bad in (base(title="x" * 300000), base(affected=[huge]), base(affected=[{"product": "p", "original_ranges": [huge]}]), base(affected=["x" * 100] * 3000), base(kind="poc", affected=[{"p": "x" * 90}] * 4000), base(affected=[{"p": noise(2000, i)} for i in range(900)])):
        with pytest.raises(Exception, match="fits no physical form"):
            split(spark, bad)


def test_damage_fails_the_read(spark):
    rows = split(spark, base("cve/9", title=noise(40000), references=["z" * 20000]), base("feed/8", title=noise(30000)))
    assert len(rows) > 8

    def changed(at, **fields):
        out = copy.deepcopy(rows)
        out[at].update(fields)
        return out

    def told(at=0, **fields):
        return changed(at, continuation=rows[at]["continuation"] | fields)

    payload = base64.b64decode(rows[1]["payload_base64"])
    other = payload[:-1] + b"?"
    sha = hashlib.sha256(other).hexdigest()
    bad = [
        rows[1:],  # no stub
        rows[:2] + rows[3:],  # a part is missing
        [*rows, rows[2]],  # twice
        [*rows, rows[0]],
        changed(2, part_index=5),
        changed(2, parent_record_id="feed/8"),
        changed(2, payload_base64=base64.b64encode(other).decode()),
        changed(1, payload_base64=base64.b64encode(other).decode(), chunk_sha256=sha, content_hash=sha),
        changed(1, title="other"),
        changed(0, content_hash="b" * 64),
        changed(0, title="other"),
        told(bytes=rows[0]["continuation"]["bytes"] + 1),
        told(sha256="0" * 64),
        told(format="json-utf8-v2"),
        told(compressed_sha256="0" * 64),
        told(compression="lzma"),
        told(parts=rows[0]["continuation"]["parts"][:-1]),
        told(more=1),
        told(requires_reassembly=False),
        told(format="json-zlib-affected-v3", affected_count=1),
    ]
    for i, case in enumerate(bad):
        with pytest.raises(Exception, match="damaged record|a part without its record|fits no|doesn't fit"):
            print(i)
            back(spark, case)


def one_part(data: bytes, payload: bytes, size: int):
    """Physical rows of a compressed record, whatever its payload."""
    record = json.loads(data)
    sha = hashlib.sha256(payload).hexdigest()
    ident = record["record_id"]
    stub = {k: record[k] for k in P.STUB} | {"title": record["native_id"], "aliases": [], "affected": [], "references": [], "provenance": []}
    stub["continuation"] = dict(format="json-zlib-v3", parts=[f"{ident}/part/000"], bytes=size, sha256=hashlib.sha256(data).hexdigest(), requires_reassembly=True, compression="zlib", compression_level=6, compressed_bytes=len(payload), compressed_sha256=sha)
    part = base(ident, kind="continuation", status="fragment", record_id=f"{ident}/part/000", native_id=f"{record['native_id']}/part/000", title=f"{ident}/part/000", content_hash=sha, chunk_sha256=sha, parent_record_id=ident, part_index=0, total_parts=1, payload_base64=base64.b64encode(payload).decode())
    return [stub, part]


def test_bombs_and_trailing_bytes_are_refused(spark):
    data = (text(base("cve/7", title="x" * 60000)) + "\n").encode()
    packed = zlib.compress(data, 6)
    assert back(spark, one_part(data, packed, len(data))) == [json.loads(data)]
    for payload, size in ((zlib.compress(data * 1000, 6)[:8000], len(data)), (zlib.compress(data + b" " * 10**7, 6)[:8190], len(data)), (packed + b"more", len(data)), (packed[:-3], len(data)), (b"no zlib at all", len(data)), (packed, 100)):
        with pytest.raises(Exception, match="damaged record"):
            back(spark, one_part(data, payload, size))


def test_places_keep_apart(spark):
    a, b = base("feed/5", title=noise(30000, 1)), base("feed/5", title=noise(20000, 2))
    rows = P.physical(spark.createDataFrame([("feed/5", 0, text(a)), ("feed/5", 1, text(b))], "record_id string, n int, line string"))
    got = P.logical(rows.repartition(2), "n").orderBy("place").collect()
    assert [json.loads(r.line) for r in got] == [a, b]
    with pytest.raises(Exception, match="without its record|damaged record"):
        P.logical(rows.withColumn("n", F.coalesce("part_index", "n")), "n").collect()


def test_no_rows(spark):
    assert split(spark) == [] and back(spark, []) == []


def test_the_round_trip_makes_its_lines_once(spark):
    back = core.QUERIES["physical_roundtrip"](spark, "/root/testdata/sf0.001")
    assert back.inputFiles() and not [f for f in back.inputFiles() if "documents.parquet" in f]


def test_what_spares_parsing_leaves_no_line_out(spark):
    """Lines without a kind are records; escaped words count as written out."""
    lines = [("a", '{"record_id":"a"}'), ("b", '{"record_id":"b","title":"\\u0001 no continuation"}')]
    read = lambda rows: sorted((r.record_id, r.line) for r in P.logical(spark.createDataFrame(rows, "record_id string, line string")).collect())
    assert read(lines) == lines
    with pytest.raises(Exception, match="a part without its record"):
        read([("c/part/000", '{"kind":"continu\\u0061tion","parent_record_id":"c","part_index":0}')])

"""Feed jobs on small upstream documents."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from factlake.functions import predicates as P
from factlake.sources import feeds

CVE = {
    "dataType": "CVE_RECORD", "dataVersion": "5.1", "cveMetadata": {"cveId": "CVE-2026-1001", "state": "PUBLISHED", "datePublished": "2026-09-01T00:00:00", "dateUpdated": "2026-09-02T10:00:00.000Z"},
    "containers": {
        "cna": {"providerMetadata": {"orgId": "o1", "dateUpdated": "x"}, "title": "T", "affected": [{"product": "p", "versions": [{"version": "1", "status": "affected"}]}], "references": [{"url": "https://a.example/x"}], "metrics": [{"m": 1}]},
        "adp": [{"providerMetadata": {"orgId": "o2"}, "affected": [{"product": "q"}, {"product": "r", "versions": []}]}],
    },
}


def docs(spark, *values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "doc string")


def test_cve(spark):
    bad = [dict(CVE, dataVersion="4.0"), dict(CVE, cveMetadata=dict(CVE["cveMetadata"], state="DRAFT")), dict(CVE, cveMetadata=dict(CVE["cveMetadata"], cveId="x"))]
    frame = docs(spark, CVE, *bad)
    (row,) = feeds.cve_records(frame, "rev").collect()
    assert (row.record_id, row.status, row.title, row.aliases) == ("cve/CVE-2026-1001", "active", "T", ["CVE-2026-1001"])
    assert (row.published_at, row.source_modified_at) == ("2026-09-01T00:00:00Z", "2026-09-02T10:00:00Z")
    affected = [json.loads(x) for x in row.affected]
    assert [a["product"] for a in affected] == ["p", "q", "r"] and [a["assertion_role"] for a in affected] == ["cna", "adp", "adp"]
    assert affected[0]["provider"] == {"orgId": "o1"} and affected[0]["original_ranges"] == [{"version": "1", "status": "affected"}] and affected[1]["original_ranges"] == [] and "versions" not in affected[0]
    body = json.loads(row.body)
    assert [a["affected_indices"] for a in body["assertions"]] == [[0], [1, 2]] and body["assertions"][0]["metrics"] == [{"m": 1}] and body["assertions"][0]["provider"]["dateUpdated"] == "x"
    assert json.loads(row.references[0])["assertion_role"] == "cna" and len(row.provenance) == 3 and json.loads(row.provenance[1])["independent_evidence"] is True
    assert sorted(r.reason for r in feeds.cve_rejected(frame).collect()) == ["not a CVE id", "record version not read", "state not read"]


def test_ghsa(spark):
    base = {"ghsa_id": "GHSA-2222-3333-4444", "type": "reviewed", "cve_id": "CVE-2026-1", "summary": "s", "updated_at": "2026-09-02T00:00:00Z", "published_at": "2026-09-01T00:00:00Z", "identifiers": [{"value": "X", "type": "T"}, {"type": "T"}], "references": ["https://a.example/"], "vulnerabilities": [{"package": {"ecosystem": "npm", "name": "n"}, "vulnerable_version_range": "< 2"}]}
    rows = feeds.ghsa_records(docs(spark, base, dict(base, ghsa_id="GHSA-2222-3333-5555", withdrawn_at="2026-09-03T00:00:00Z"), dict(base, ghsa_id="GHSA-2222-3333-6666", type="unreviewed"), dict(base, ghsa_id="bad"))).collect()
    assert {r.native_id: r.status for r in rows} == {"GHSA-2222-3333-4444": "active", "GHSA-2222-3333-5555": "withdrawn", "GHSA-2222-3333-6666": "unreviewed"}
    first = next(r for r in rows if r.status == "active")
    assert first.aliases == ["CVE-2026-1", "GHSA-2222-3333-4444", "X"] and json.loads(first.affected[0])["original_ranges"] == "< 2" and json.loads(first.affected[0])["name"] == "n"
    assert json.loads(first.provenance[0])["revision"] == "2026-09-02T00:00:00Z"


def test_kev_catalogue(spark):
    entry = {"cveID": "CVE-2026-0007", "vulnerabilityName": "N", "dateAdded": "2026-09-01", "vendorProject": "v", "product": "p"}
    rows, complete = feeds.catalogue(docs(spark, {"count": 2, "vulnerabilities": [entry]}))
    assert complete.first().authoritative is False
    (row,) = feeds.kev_records(rows, "rev").collect()
    body = json.loads(row.body)
    assert body["kev"] is True and body["kev_metadata"] == entry and json.loads(row.affected[0]) == {"vendor": "v", "product": "p", "original_ranges": None}


def test_poc_index_files(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    os.makedirs(f"{root}/2026")
    for name, value in (("CVE-2026-1001", [{"id": 5, "html_url": "https://github.com/a/b", "full_name": "a/b", "owner": {"login": "a"}, "created_at": "2026-09-01T00:00:00Z"}, {"html_url": "https://h.example/x"}]), ("CVE-2026-1002", [])):
        with open(f"{root}/2026/{name}.json", "w") as f:
            json.dump(value, f)
    wanted = spark.createDataFrame([("CVE-2026-1001",), ("CVE-2026-1002",), ("CVE-2026-1003",)], "alias string")
    rows, present = feeds.index_files(spark, root, wanted)
    assert {r.cve: r.exists for r in present.collect()} == {"CVE-2026-1001": True, "CVE-2026-1002": True, "CVE-2026-1003": False}
    got = {r.native_id: r for r in feeds.poc_records(rows, "rev", "sha").collect()}
    assert got["5"].title == "a/b" and len(got) == 2 and all(len(k) in (1, 64) for k in got)


def test_exploit_index(spark):
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/i.csv"
    with open(root, "w", encoding="utf-8-sig") as f:
        f.write('id,description,codes,date_published,verified\n1,"old, but named",CVE-2026-1001;CVE-2026-1001,2020-01-01,1\n2,old,CVE-2020-1234,2020-01-01,0\n3,new,,2026-09-05,0\n')
    active = spark.createDataFrame([("CVE-2026-1001",)], "alias string")
    got = {r.native_id: r for r in feeds.exploit_records(feeds.exploit_index(spark, root), active, "2026-08-20", "rev", "sha").collect()}
    assert set(got) == {"1", "3"} and got["1"].aliases == ["CVE-2026-1001"] and json.loads(got["3"].body)["mapping_confidence"] == "unknown" and json.loads(got["1"].body)["verification"]["upstream_verified"] is True
    with open(root, "w") as f:
        f.write("id,description\n1,x\n")
    with pytest.raises(ValueError, match="codes"):
        feeds.exploit_index(spark, root)


def test_official_references(spark):
    refs = ['{"url":"https://vendor.example/a","name":"A"}', '"text"', '{"name":"no url"}', '{"url":"http://10.0.0.1/"}', '{"url":5}']
    adv = spark.createDataFrame([("cve/CVE-2026-1", ["CVE-2026-1"], "2026-09-01T00:00:00Z", None, refs)], "record_id string, aliases array<string>, published_at string, source_modified_at string, references array<string>")
    records, excluded = feeds.official_references(adv, "sha")
    import hashlib

    (row,) = records.collect()
    assert row.native_id == hashlib.sha256(b"cve/CVE-2026-1\x00https://vendor.example/a").hexdigest() and row.title == "A" and json.loads(row.provenance[1])["source_record_id"] == "cve/CVE-2026-1"
    assert {r.reference_index: r.reason for r in excluded.collect()}.items() >= {1: "reference_not_object", 2: "missing_reference_url", 3: "non_public_url_host"}.items()


def test_reference_reasons(spark):
    cases = {
        "https://a.example/x": None, "https://a.example:8443/": None, "http://8.8.8.8/": None, "https://[2606:4700::1111]/": None, "https://bücher.example/": None,
        "": "url_contains_whitespace_or_control", "https://a.example/ x": "url_contains_whitespace_or_control", "https://a.example\\x": "url_contains_backslash", "https://a.example:99999/": "malformed_url",
        "https://a.example:x/": "malformed_url", "ftp://a.example/": "unsupported_url_scheme", "mailto:x": "unsupported_url_scheme", "https:///x": "missing_url_host", "https://u:p@a.example/": "url_contains_credentials",
        "https://a.example:0/": "invalid_url_port", "https://a.example:/": "invalid_url_port", "https://localhost/": "invalid_url_host", "https://-a.example/": "invalid_url_host", "https://db.internal/": "non_public_url_host",
        "https://127.0.0.1/": "non_public_url_host", "https://[::1]/": "non_public_url_host", "https://192.168.4.4/": "non_public_url_host", "https://172.32.0.1/": None,
    }
    got = {r.u: r.x for r in spark.createDataFrame([(u,) for u in cases], "u string").select("u", P.official_reference_reason(F.col("u")).alias("x")).collect()}
    assert got == cases
    allowed = {"https://github.com/a/b": True, "https://github.com/a-/b": False, "https://github.com/a/b.git": False, "https://github.com/about/b": False, "https://github.com/a/b/c": False, "https://www.exploit-db.com/exploits/12": True, "https://www.exploit-db.com/exploits/012": False}
    got = {r.u: r.x for r in spark.createDataFrame([(u,) for u in allowed], "u string").select("u", P.reference_allowed(F.col("u")).alias("x")).collect()}
    assert got == allowed
    paths = {"a/b": True, "/a": False, "a/../b": False, "a%2f": False, "c:x": False, "": False}
    assert {r.u: r.x for r in spark.createDataFrame([(u,) for u in paths], "u string").select("u", P.safe_path(F.col("u")).alias("x")).collect()} == paths


def test_change_log(spark):
    log = [{"fetchTime": "2026-09-01T00:00:00Z", "new": [{"cveId": "CVE-2026-1001"}], "updated": []}, {"fetchTime": "2026-09-03T00:00:00Z", "updated": [{"cveId": "CVE-2026-1001"}, {"cveId": "CVE-2026-1002"}]}, {"fetchTime": "2026-09-09T00:00:00Z", "error": ["x"], "new": []}]
    at = lambda x: F.lit(x).cast("timestamp")
    ids, span = feeds.change_log(docs(spark, log), at("2026-09-01 00:00:00"), at("2026-09-05 00:00:00"))
    assert {r.id: r.fetched_at.day for r in ids.collect()} == {"CVE-2026-1001": 3, "CVE-2026-1002": 3}
    assert span.first().last_at.day == 9
    with pytest.raises(Exception, match="upstream errors"):
        feeds.change_log(docs(spark, [dict(log[2], new=[{"cveId": "CVE-2026-1001"}])]), at("2026-09-01 00:00:00"), at("2026-09-10 00:00:00"))[0].collect()


def test_tree_and_pages(spark):
    listing = {"tree": [{"path": "http/a.yaml", "type": "blob", "sha": "1", "size": 3, "mode": "100644"}, {"path": "http", "type": "tree", "sha": "2"}, {"path": "docs/x", "type": "blob", "sha": "3", "size": 1, "mode": "100644"}]}
    assert [(r.path, r["size"]) for r in feeds.tree(docs(spark, listing), ["http"]).collect()] == [("http/a.yaml", 3)]
    assert feeds.advisory_pages(docs(spark, [{"a": 1}, {"a": 2}]), docs(spark, [{"a": 3}])).count() == 3


def test_templates(spark):
    pytest.importorskip("yaml")
    good = b"id: t1\ninfo:\n  name: N\n  tags: cve2026,auth, x\n  reference:\n    - https://a.example/\n    - see GHSA-2222-3333-4444\n  classification:\n    cve-id: cve-2026-1001\n  metadata: {vendor: v, other: 1}\nhttp:\n  - payloads: {u: helpers/users.txt}\n    path: ['{{interactsh-url}}']\n"
    files = spark.createDataFrame([("http/a.yaml", bytearray(good)), ("b.yaml", bytearray(b"a: b\nc: d\n")), ("c.yaml", bytearray(b"[1]"))], "path string, content binary")
    records, rejected = feeds.template_records(files, "rev", "o/r")
    (row,) = records.collect()
    body = json.loads(row.body)
    assert row.aliases == ["CVE-2026-1001", "GHSA-2222-3333-4444"] and body["tags"] == ["auth", "cve2026", "x"] and body["protocols"] == ["http"]
    assert body["requirements"] == {"authentication": "required", "browser": False, "out_of_band": True, "code": False, "configuration": None} and body["dependencies"][0]["path"] == "helpers/users.txt"
    assert [json.loads(x) for x in row.references] == [{"url": "https://a.example/"}, {"text": "see GHSA-2222-3333-4444", "relationship": "upstream-reference", "retrievable": False}]
    assert {r.path: r.error for r in rejected.collect()} == {"b.yaml": "auxiliary mapping", "c.yaml": "no id or info"}
    assert body["resource_id"] == "nuclei/http/a.yaml" and body["products"] == {"vendor": "v"}
    assert [(w["code"], w["reference_index"]) for w in body["warnings"]] == [("non_url_reference", 1)]
    assert row.assessment.relevance == "unknown" and row.assessment.reasons == [] and row.assessment.product_class is None
    plain = good.replace(b"    - see GHSA-2222-3333-4444\n", b"").replace(b"  metadata: {vendor: v, other: 1}\n", b"  metadata: {cpe: ['c', {a: 1}]}\n")
    big = good + b"#" * feeds.MOST_TEMPLATE_BYTES
    more = spark.createDataFrame([("p.yaml", bytearray(plain)), ("big.yaml", bytearray(big)), ("../x.yaml", bytearray(plain))], "path string, content binary")
    records, rejected = feeds.template_records(more, "rev", "o/r")
    body = json.loads(records.first().body)
    assert body["products"] == {"cpe": ["c", {"a": 1}]} and "warnings" not in body
    assert {r.path: r.error for r in rejected.collect()} == {"big.yaml": "over the size", "../x.yaml": "a path that leaves its folder"}


def test_signature_blocks(spark):
    block = ["      - type: dsl", "        name: NAME", "        dsl:", "          - 'regex(\"/plugins/SLUG/\", body)'", "          - 'status_code == 200'", "        condition: and"]
    lines = [x.replace("NAME", n).replace("SLUG", s) for n, s in (("a", "a"), ("b", "b"), ("c", "x")) for x in block] + ["", "# digest: 0a:1b"]
    frame = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "path string, line_number int, line string")
    import hashlib

    (row,) = feeds.signature_blocks(frame).collect()
    assert (row.matcher_count, row.odd_lines) == (2, 6) and row.matcher_blocks_sha256 == hashlib.sha256(("\n".join(lines[:12]) + "\n").encode()).hexdigest()


def test_corpus_names_files_below_its_folder(spark):
    root = tempfile.mkdtemp(prefix="spark-a.b+", dir="/tmp")  # characters that mean something in a pattern
    for name in ("x.yaml", "b/c/y.yaml", "b/z.txt"):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(name)
    for base in (root, root + "/", "file://" + root):
        assert sorted((r.path, bytes(r.content).decode()) for r in feeds.corpus(spark, base).collect()) == [("b/c/y.yaml", "b/c/y.yaml"), ("x.yaml", "x.yaml")]


def test_active_projection(spark):
    columns = ["record_id", "source_id", "native_id", "kind", "aliases", "status", "title", "references", "published_at", "source_modified_at"]
    rows = spark.createDataFrame([(*["r"] * 5, s, *["x"] * 4, "hidden") for s in ("active", "withdrawn")], [*columns, "assessment"])
    got = feeds.active_projection(rows).collect()
    assert len(got) == 1 and got[0].status == "active" and list(got[0].asDict()) == columns

"""Feeds to records: one DataFrame job for each kind of upstream document.

A document is a row with ``doc``, its JSON text. A record has the envelope as typed columns, open arrays as canonical JSON
elements, and everything else of the source in ``body``, canonical JSON. Documents of another version or state are not records:
each job's ``rejected`` twin tells why.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import predicates as P
from .paths import below

CVE_VERSIONS = ["5.0", "5.1", "5.1.1", "5.2"]
CVE_STATES = ["PUBLISHED", "REJECTED"]
# Fixed values of the formats.
ASSERTION_FIELDS = ["metrics", "problemTypes", "descriptions", "configurations", "rejectedReasons", "replacedBy", "datePublic", "title"]
ASSESSMENT = "named_struct('relevance', 'unknown', 'confidence', 'unknown', 'product_class', cast(null as string), 'entry_protocol', cast(null as string), 'authentication', cast(null as string), 'configuration', cast(null as string), 'reasons', cast(array() as array<string>), 'classifier_version', '1.0')"
PRODUCT_FIELDS = ["vendor", "product", "cpe"]
MOST_TEMPLATE_BYTES = 2 << 20
PROTOCOLS = ["http", "requests", "tcp", "network", "headless", "code", "file", "dns", "ssl", "javascript"]
REQUEST_PROTOCOLS = ["http", "requests", "tcp", "network"]


def text_at(doc: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), f"$.{path}", "string")


def json_at(doc: Column, path: str) -> Column:
    """Canonical JSON at a path; null where there is none, or a JSON null."""
    v = F.try_variant_get(F.try_parse_json(doc), f"$.{path}", "variant")
    return F.when(~F.is_variant_null(v), F.to_json(v))


def items(doc: Column) -> Column:
    """Elements of a JSON array, each as canonical JSON; null is an empty one."""
    return F.transform(F.coalesce(F.from_json(doc, "array<variant>"), F.array().cast("array<variant>")), lambda x: F.to_json(x))


def fields(doc: Column) -> Column:
    """A JSON object as a map to variants."""
    return F.coalesce(F.from_json(doc, "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))


def object_of(**values: Column) -> Column:
    """A map to variants from JSON texts; a null text is a JSON null."""
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[F.parse_json(F.coalesce(v, F.lit("null"))) for v in values.values()]))


def canonical(mapping: Column) -> Column:
    return H.canonical_json(F.to_json(mapping))


def merged(a: Column, b: Column) -> Column:
    """Two maps as one; entries of b win."""
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k)), b)


def quoted(value: Column) -> Column:
    return H.json_string(value)


def record(source: str, native: Column, kind: str, *, title: Column, aliases: Column, published: Column, modified: Column, revision: Column, url: Column, status: Column | None = None, affected: Column | None = None, references: Column | None = None, provenance: Column | None = None, body: Column | None = None) -> list[Column]:
    """The columns of a record."""
    none = F.array().cast("array<string>")
    own = canonical(object_of(source_id=F.lit(f'"{source}"'), revision=quoted(revision), url=quoted(url)))
    iso = lambda x: H.iso(H.instant(x))
    return [
        F.lit("1.0").alias("schema_version"),
        F.concat(F.lit(f"{source}/"), native).alias("record_id"),
        F.lit(source).alias("source_id"),
        native.alias("native_id"),
        F.lit(kind).alias("kind"),
        F.array_sort(F.array_distinct(F.array_compact(aliases))).alias("aliases"),
        (F.lit("active") if status is None else status).alias("status"),
        F.coalesce(F.when(title != "", title), native).alias("title"),
        iso(published).alias("published_at"),
        iso(modified).alias("source_modified_at"),
        F.lit(None).cast("string").alias("first_seen_at"),
        (none if affected is None else affected).alias("affected"),
        (none if references is None else references).alias("references"),
        F.concat(F.array(own), none if provenance is None else provenance).alias("provenance"),
        F.expr(ASSESSMENT).alias("assessment"),
        (F.lit("{}") if body is None else body).alias("body"),
    ]


def _cve_reason() -> Column:
    d = F.col("doc")
    return (
        F.when((text_at(d, "dataType") != "CVE_RECORD") | ~F.coalesce(text_at(d, "dataVersion").isin(CVE_VERSIONS), F.lit(False)), "record version not read")
        .when(~F.coalesce(text_at(d, "cveMetadata.cveId").rlike(f"^{H.CVE}$"), F.lit(False)), "not a CVE id")
        .when(~F.coalesce(text_at(d, "cveMetadata.state").isin(CVE_STATES), F.lit(False)), "state not read")
    )


def cve_rejected(docs: DataFrame) -> DataFrame:
    return docs.withColumn("reason", _cve_reason()).filter("reason is not null")


def cve_records(docs: DataFrame, revision: str) -> DataFrame:
    """One record for each CVE document: assertions of the CNA and of each ADP container stay apart, and each affected item
    knows its own."""
    d = F.col("doc")
    good = docs.filter(_cve_reason().isNull())
    role = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("c"))
    containers = F.concat(F.array(role("cna", F.coalesce(json_at(d, "containers.cna"), F.lit("{}")))), F.transform(items(json_at(d, "containers.adp")), lambda c: role("adp", c)))
    good = good.withColumn("parts", containers)

    def provider(c: Column) -> Column:
        return F.coalesce(json_at(c, "providerMetadata"), F.lit("{}"))

    def affected(p: Column) -> Column:
        dated = canonical(F.map_filter(fields(provider(p["c"])), lambda k, _: k != "dateUpdated"))
        return F.transform(
            items(json_at(p["c"], "affected")),
            lambda a: canonical(merged(F.map_filter(fields(a), lambda k, _: k != "versions"), object_of(assertion_role=quoted(p["role"]), provider=dated, original_ranges=F.coalesce(json_at(a, "versions"), F.lit("[]"))))),
        )

    def references(p: Column) -> Column:
        return F.transform(items(json_at(p["c"], "references")), lambda r: canonical(merged(fields(r), object_of(assertion_role=quoted(p["role"]), provider=provider(p["c"])))))

    count = lambda p: F.size(items(json_at(p["c"], "affected")))
    parts = F.col("parts")
    before = lambda i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda s, p: s + count(p))

    def assertion(p: Column, i: Column) -> Column:
        own = F.map_filter(fields(p["c"]), lambda k, _: k.isin(ASSERTION_FIELDS))
        indices = F.when(count(p) > 0, F.to_json(F.transform(F.sequence(F.lit(0), F.greatest(count(p) - 1, F.lit(0))), lambda k: k + before(i)))).otherwise("[]")
        return canonical(merged(own, object_of(role=quoted(p["role"]), provider=provider(p["c"]), affected_indices=indices)))

    identifier = text_at(d, "cveMetadata.cveId")
    cna = F.get(parts, F.lit(0))["c"]
    assertions = F.concat(F.lit("["), F.array_join(F.transform(parts, assertion), ","), F.lit("]"))
    provenance = F.transform(parts, lambda p: canonical(object_of(source_id=F.lit('"cve"'), role=quoted(p["role"]), provider=provider(p["c"]), independent_evidence=F.when(p["role"] == "cna", "true").otherwise("false"))))
    descriptions = F.coalesce(json_at(cna, "descriptions"), json_at(cna, "rejectedReasons"), F.lit("[]"))
    return good.select(
        *record(
            "cve", identifier, "advisory", title=text_at(cna, "title"), aliases=F.array(identifier), published=text_at(d, "cveMetadata.datePublished"), modified=text_at(d, "cveMetadata.dateUpdated"),
            status=F.when(text_at(d, "cveMetadata.state") == "REJECTED", "rejected").otherwise("active"), revision=F.lit(revision), url=F.concat(F.lit("https://www.cve.org/CVERecord?id="), identifier),
            affected=F.flatten(F.transform(parts, affected)), references=F.flatten(F.transform(parts, references)), provenance=provenance,
            body=canonical(object_of(data_version=quoted(text_at(d, "dataVersion")), descriptions=descriptions, assertions=assertions)),
        )
    )


def ghsa_records(docs: DataFrame, revision: str | None = None) -> DataFrame:
    """One record for each advisory document."""
    d = F.col("doc")
    identifier = text_at(d, "ghsa_id")
    named = F.filter(F.transform(items(json_at(d, "identifiers")), lambda x: text_at(x, "value")), lambda v: v != "")
    status = F.when(F.coalesce(text_at(d, "withdrawn_at"), F.lit("")) != "", "withdrawn").when(~text_at(d, "type").eqNullSafe(F.lit("reviewed")), "unreviewed").otherwise("active")

    def affected(v: Column) -> Column:
        return canonical(object_of(
            package=F.coalesce(json_at(v, "package"), F.lit("{}")), ecosystem=json_at(v, "package.ecosystem"), name=json_at(v, "package.name"), original_ranges=json_at(v, "vulnerable_version_range"),
            first_patched_version=json_at(v, "first_patched_version"), vulnerable_functions=F.coalesce(json_at(v, "vulnerable_functions"), F.lit("[]")),
        ))

    urls = F.from_json(json_at(d, "references"), "array<string>")
    references = F.transform(F.coalesce(urls, F.array().cast("array<string>")), lambda u: canonical(object_of(url=quoted(u), relationship=F.lit('"upstream-reference"'))))
    return docs.filter(identifier.rlike(f"(?i)^{H.GHSA}$")).filter(F.forall(F.coalesce(urls, F.array().cast("array<string>")), P.public_url)).select(
        *record(
            "ghsa", identifier, "advisory", title=text_at(d, "summary"), aliases=F.concat(named, F.array(identifier, F.when(text_at(d, "cve_id") != "", text_at(d, "cve_id")))),
            published=text_at(d, "published_at"), modified=text_at(d, "updated_at"), status=status, revision=F.lit(revision) if revision else text_at(d, "updated_at"), url=text_at(d, "html_url"),
            affected=F.transform(items(json_at(d, "vulnerabilities")), affected), references=references,
            body=canonical(object_of(
                review_state=json_at(d, "type"), withdrawn_at=json_at(d, "withdrawn_at"), github_reviewed_at=json_at(d, "github_reviewed_at"), severity=json_at(d, "severity"),
                metrics=F.coalesce(json_at(d, "cvss_severities"), json_at(d, "cvss")), independent_evidence_group=quoted(F.concat(F.lit("github-advisory/"), identifier)),
            )),
        )
    )


def catalogue(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, whether the declared count is the actual one) of an exploited-vulnerabilities catalogue."""
    d = F.col("doc")
    rows = items(json_at(d, "vulnerabilities"))
    return docs.select(F.explode(rows).alias("doc")), docs.select((text_at(d, "count").cast("long") == F.size(rows)).alias("authoritative"))


def kev_records(rows: DataFrame, revision: str) -> DataFrame:
    d = F.col("doc")
    identifier = text_at(d, "cveID")
    affected = canonical(object_of(vendor=json_at(d, "vendorProject"), product=json_at(d, "product"), original_ranges=F.lit(None).cast("string")))
    return rows.filter(identifier.rlike(f"^{H.CVE}$")).select(
        *record(
            "kev", identifier, "advisory", title=text_at(d, "vulnerabilityName"), aliases=F.array(identifier), published=text_at(d, "dateAdded"), modified=text_at(d, "dateAdded"), revision=F.lit(revision),
            url=F.lit("https://www.cisa.gov/known-exploited-vulnerabilities-catalog"), affected=F.array(affected),
            body=canonical(object_of(known_exploited=F.lit("true"), kev=F.lit("true"), kev_added_at=json_at(d, "dateAdded"), kev_metadata=d)),
        )
    )


def poc_records(rows: DataFrame, revision: str, intel_sha: str) -> DataFrame:
    """Records of per-key index rows (cve, doc)."""
    d, url = F.col("doc"), text_at(F.col("doc"), "html_url")
    native = F.coalesce(F.when(~text_at(d, "id").isin("0", ""), text_at(d, "id")), F.sha2(url, 256))
    body = object_of(
        url=quoted(url), author=json_at(d, "owner.login"), advisory_ids=F.to_json(F.array("cve")), mapping_confidence=F.lit('"source-asserted"'), index_revision=F.lit(f'"{revision}"'), intel_commit_sha=F.lit(f'"{intel_sha}"'),
        availability=F.lit('"not-checked"'), verification=F.lit('{"author_claim":"proof-of-concept","executed":false,"static_analysis":"not-performed","status":"unverified"}'),
    )
    title = F.coalesce(F.when(text_at(d, "description") != "", text_at(d, "description")), text_at(d, "full_name"))
    return rows.filter(P.public_url(url)).select(*record("poc-in-github", native, "poc", title=title, aliases=F.array("cve"), published=text_at(d, "created_at"), modified=text_at(d, "updated_at"), revision=F.lit(revision), url=url, body=canonical(body)))


def index_files(spark: SparkSession, path: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (cve, doc), presence (cve, exists)) of per-key files for the wanted keys: an absent file is not an empty list."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "CVE-*.json").text(path).select(H.id_of_path(F.col("_metadata.file_path")).alias("cve"), F.col("value").alias("doc"))
    mine = files.join(wanted.select(F.col("alias").alias("cve")).distinct(), "cve", "left_semi")
    present = wanted.select(F.col("alias").alias("cve")).distinct().join(mine.select("cve", F.lit(True).alias("exists")), "cve", "left").select("cve", F.coalesce("exists", F.lit(False)).alias("exists"))
    return mine.select("cve", F.explode(items(F.col("doc"))).alias("doc")), present


EXPLOIT_COLUMNS = ["id", "description", "codes", "date_published"]


def exploit_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an exploit index in CSV; a missing column is an error."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    if lacking := [c for c in EXPLOIT_COLUMNS if c not in rows.columns]:
        raise ValueError(f"not an exploit index: {lacking} missing")
    for c in ("date_updated", "author", "platform", "type", "port", "verified"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return rows


def exploit_records(rows: DataFrame, active: DataFrame, cutoff: str, revision: str, intel_sha: str) -> DataFrame:
    """Records of index rows that name an active id or are recent. An id that is no number fails the read."""
    aliases = H.aliases_in(F.coalesce("codes", F.lit("")))
    named = rows.withColumn("found", aliases)
    hits = named.select("id", F.explode("found").alias("alias")).join(active, "alias", "left_semi").select("id").distinct().withColumn("hit", F.lit(True))
    admitted = named.join(hits, "id", "left").filter(F.col("hit") | (F.col("date_published") >= cutoff))
    number = F.when(F.col("id").rlike("^[0-9]+$"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("invalid exploit id "), F.coalesce("id", F.lit("null")))))
    url = F.concat(F.lit("https://www.exploit-db.com/exploits/"), F.col("id"))
    prerequisites = canonical(object_of(platform=quoted(F.col("platform")), type=quoted(F.col("type")), port=quoted(F.col("port"))))
    verification = F.concat(F.lit('{"author_claim":"proof-of-concept","executed":false,"static_analysis":"not-performed","status":"unverified","upstream_verified":'), F.when(F.col("verified") == "1", "true").otherwise("false"), F.lit("}"))
    body = object_of(url=quoted(url), author=quoted(F.col("author")), advisory_ids=F.to_json("found"), mapping_confidence=F.when(F.size("found") > 0, '"source-asserted"').otherwise('"unknown"'), upstream_revision=F.lit(f'"{revision}"'), intel_commit_sha=F.lit(f'"{intel_sha}"'), prerequisites=prerequisites, availability=F.lit('"not-checked"'), verification=verification)
    return admitted.select(*record("exploitdb", number, "poc", title=F.col("description"), aliases=F.col("found"), published=F.col("date_published"), modified=F.col("date_updated"), revision=F.lit(revision), url=url, body=canonical(body)))


def official_references(advisories: DataFrame, intel_sha: str) -> tuple[DataFrame, DataFrame]:
    """(records, excluded) of advisories' references: a record for each (advisory, URL) that may be indexed; the others with
    their reason."""
    each = advisories.select("record_id", "aliases", "published_at", "source_modified_at", F.posexplode("references").alias("reference_index", "ref"))
    url = text_at(F.col("ref"), "url")
    is_object = F.schema_of_variant(F.try_parse_json("ref")).startswith("OBJECT")
    reason = F.when(~F.coalesce(is_object, F.lit(False)), "reference_not_object").when(~F.array_contains(F.map_keys(fields(F.col("ref"))), "url"), "missing_reference_url").otherwise(P.official_reference_reason(F.col("url")))
    judged = each.withColumn("url", url).withColumn("reason", reason)
    native = F.sha2(F.concat(F.col("record_id").cast("binary"), F.unhex(F.lit("00")), F.col("url").cast("binary")), 256)
    source = canonical(object_of(source_record_id=quoted(F.col("record_id")), reference=F.col("ref")))
    body = object_of(url=quoted(F.col("url")), advisory_ids=F.to_json("aliases"), mapping_confidence=F.lit('"explicit-advisory-reference"'), reference_type=F.lit('"advisory-reference"'), intel_commit_sha=F.lit(f'"{intel_sha}"'), availability=F.lit('"not-checked"'), verification=F.lit('{"executed":false,"status":"reference-only"}'))
    records = judged.filter("reason is null").select(
        *record("official-references", native, "poc", title=F.coalesce(text_at(F.col("ref"), "name"), F.col("url")), aliases=F.col("aliases"), published=F.col("published_at"), modified=F.col("source_modified_at"), revision=F.lit(intel_sha), url=F.col("url"), provenance=F.array(source), body=canonical(body))
    )
    return records, judged.filter("reason is not null").select("record_id", "reference_index", "url", "reason")


def change_log(docs: DataFrame, lower: Column, upper: Column) -> tuple[DataFrame, DataFrame]:
    """(newest change of each id, span) of a change log in [lower, upper]. An upstream error within it fails the read."""
    batch = docs.select(F.explode(items(F.col("doc"))).alias("b")).select(H.instant(text_at(F.col("b"), "fetchTime")).alias("fetched_at"), "b")
    span = batch.agg(F.min("fetched_at").alias("first_at"), F.max("fetched_at").alias("last_at"))
    ids = F.concat(items(json_at(F.col("b"), "new")), items(json_at(F.col("b"), "updated")))
    failed = ~F.coalesce(json_at(F.col("b"), "error"), F.lit("false")).isin("false", "[]", "{}", '""', "0")
    inside = batch.filter(F.col("fetched_at").between(lower, upper))
    each = inside.select("fetched_at", F.explode(F.when(failed, F.raise_error(F.lit("the change log holds upstream errors")).cast("array<string>")).otherwise(ids)).alias("x"))
    named = each.select("fetched_at", text_at(F.col("x"), "cveId").alias("id"))
    checked = F.when(F.col("id").rlike(f"^{H.CVE}$"), F.col("id")).otherwise(F.raise_error(F.lit("invalid id in the change log")))
    return named.select(checked.alias("id"), "fetched_at").groupBy("id").agg(F.max("fetched_at").alias("fetched_at")), span


def tree(docs: DataFrame, folders: list[str]) -> DataFrame:
    """Files (path, sha, size, mode) of a repository listing, under some top folders."""
    each = docs.select(F.explode(F.from_json(json_at(F.col("doc"), "tree"), "array<struct<path string, type string, sha string, size long, mode string>>")).alias("f")).select("f.*")
    return each.filter((F.col("type") == "blob") & F.split("path", "/")[0].isin(folders)).drop("type")


def advisory_pages(published: DataFrame, updated: DataFrame) -> DataFrame:
    """Advisory documents of both phases (each a row with doc, a JSON array), the updated ones later in order."""
    phase = lambda df, n: df.select(F.explode(items(F.col("doc"))).alias("doc")).withColumn("phase", F.lit(n))
    return phase(published, 0).unionByName(phase(updated, 1))


def corpus(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """Files as (path below the folder, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(below(F.col("path"), path).alias("path"), "content")


_TEMPLATE = "path string, error string, id string, name string, tags array<string>, identifiers array<string>, refs array<string>, urls array<boolean>, protocols array<string>, payloads array<string>, products map<string,string>, minimum_version string, mapping map<string,string>"


def _parse_templates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The YAML of each file as typed columns. YAML is the one thing here that needs a library for each row."""
    import json

    import yaml

    columns = [c.split(" ")[0] for c in _TEMPLATE.split(", ")]

    def several(value) -> list:
        """A value that may be missing, single or a list."""
        return value if type(value) is list else [] if value is None else [value]

    def mapping_or_error(found) -> dict:
        words = type(found) is dict and [*found.keys(), *found.values()]
        if words and all(type(w) is str and w.strip() for w in words) and found.keys().isdisjoint(("id", "info", *PROTOCOLS)):
            return {"mapping": found}
        return {"error": "no id or info"}

    def described(found: dict) -> dict:
        info, payloads = found["info"], set()
        for protocol in set(REQUEST_PROTOCOLS) & found.keys():
            for request in found[protocol] or ():
                if type(request) is not dict:
                    return {"error": "a request of another type"}
                payloads |= {v for v in (request.get("payloads") or {}).values() if type(v) is str}
        tags, meta = info.get("tags"), info.get("metadata") or {}
        if type(tags) is str:
            tags = [t.strip() for t in tags.split(",")]
        if type(several(tags)) is not list or type(tags) in (dict, int, float, bool):
            return {"error": "tags of another type"}
        links = several(info.get("reference"))
        return {
            "id": found["id"],
            "name": info.get("name"),
            "tags": list(map(str, several(tags))),
            "identifiers": [x for x in several((info.get("classification") or {}).get("cve-id")) if type(x) is str],
            "refs": [x if type(x) is str else json.dumps(x, ensure_ascii=False, sort_keys=True, default=str) for x in links],
            "urls": [type(x) is str for x in links],
            "protocols": [p for p in PROTOCOLS if p in found],
            "payloads": sorted(payloads),
            "products": {k: json.dumps(v) for k, v in meta.items() if k in PRODUCT_FIELDS},
            "minimum_version": str(meta.get("min-version") or found.get("minimum-version") or "") or None,
        }

    def one(path: str, content: bytes) -> dict:
        try:
            found = yaml.safe_load(content)
        except yaml.YAMLError:
            return dict.fromkeys(columns) | {"path": path, "error": "invalid YAML"}
        template = type(found) is dict and type(found.get("id")) is str and type(found.get("info")) is dict
        return dict.fromkeys(columns) | {"path": path} | (described(found) if template else mapping_or_error(found))

    for part in batches:
        yield pd.DataFrame([one(p, bytes(c)) for p, c in zip(part["path"], part["content"], strict=True)], columns=columns)


def template_records(files: DataFrame, revision: str, repository: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejected) of template files (path, content). Files over the size are rejected unparsed. References that are no public
    URL stay as text, with a warning that names their place."""
    parsed = files.filter(F.octet_length("content") <= MOST_TEMPLATE_BYTES).select("path", "content").mapInPandas(_parse_templates, _TEMPLATE)
    whole = files.select("path", F.sha2("content", 256).alias("sha256"), H.git_blob_sha1(F.col("content")).alias("blob_sha"), F.octet_length("content").alias("bytes"), F.expr("contains(content, cast('{{interactsh-url}}' as binary))").alias("oob")).join(parsed, "path", "left")
    unsafe = F.exists("payloads", lambda p: ~P.safe_path(p))
    whole = whole.withColumn("error", F.coalesce(F.when(F.col("bytes") > MOST_TEMPLATE_BYTES, "over the size"), F.when(~P.safe_path(F.col("path")), "a path that leaves its folder"), "error", F.when(unsafe, "a payload path that leaves its folder"), F.when(F.size("payloads") > 32, "over 32 dependencies"), F.when(F.col("mapping").isNotNull(), "auxiliary mapping")))
    upper = F.transform(F.concat("identifiers", "tags"), lambda x: F.upper(x))
    advisories = F.flatten(F.transform("refs", lambda r: F.regexp_extract_all(r, F.lit(f"(?i)({H.GHSA})"), F.lit(1))))
    aliases = F.array_sort(F.array_distinct(F.concat(F.filter(upper, lambda x: x.rlike(f"^{H.CVE}$")), advisories)))
    good = whole.filter("error is null").withColumn("found", aliases)
    linked = lambda r, i: F.coalesce(F.get("urls", i) & P.public_url(r), F.lit(False))
    message = "Upstream reference retained as inert text; not a download URL."
    warned = F.transform("refs", lambda r, i: F.when(~linked(r, i), F.struct(F.lit("non_url_reference").alias("code"), F.lit(message).alias("message"), i.alias("reference_index"))))
    warnings = F.array_compact(warned)
    references = F.transform("refs", lambda r, i: F.when(linked(r, i), canonical(object_of(url=quoted(r)))).otherwise(canonical(object_of(text=quoted(r), relationship=F.lit('"upstream-reference"'), retrievable=F.lit("false")))))
    url = F.concat(F.lit(f"https://github.com/{repository}/blob/{revision}/"), F.col("path"))
    flag = lambda c: F.when(c, "true").otherwise("false")
    has = lambda p: F.array_contains("protocols", p)
    requirements = object_of(authentication=F.when(F.arrays_overlap("tags", F.array(F.lit("auth"), F.lit("authenticated"))), '"required"'), browser=flag(has("headless")), out_of_band=flag(F.col("oob")), code=flag(has("code") | has("javascript")), configuration=F.lit(None).cast("string"))
    dependencies = F.to_json(F.transform("payloads", lambda p: F.struct(p.alias("path"), F.lit(revision).alias("revision"), F.lit("unresolved").alias("status"))))
    products = canonical(F.transform_values("products", lambda _, v: F.parse_json(v)))
    body = object_of(
        template_id=quoted(F.col("id")), resource_id=quoted(F.concat(F.lit("nuclei/"), F.col("path"))), products=products, path=quoted(F.col("path")), source_commit=F.lit(f'"{revision}"'), blob_sha=quoted(F.col("blob_sha")), sha256=quoted(F.col("sha256")), bytes=F.col("bytes").cast("string"), protocols=F.to_json("protocols"),
        tags=F.to_json(F.array_sort(F.array_distinct("tags"))), advisory_ids=F.to_json("found"), mapping_confidence=F.when(F.size("found") > 0, '"explicit-metadata"').otherwise('"unknown"'), dependencies=dependencies, requirements=canonical(requirements),
        engine=canonical(object_of(name=F.lit('"nuclei"'), minimum_version=quoted(F.col("minimum_version")))), verification=F.lit('{"executed":false,"status":"metadata-only"}'),
    )
    body = merged(body, F.when(F.size(warnings) > 0, object_of(warnings=F.to_json(warnings))).otherwise(fields(F.lit("{}"))))
    records = good.select(*record("nuclei", F.col("path"), "resource", title=F.col("name"), aliases=F.col("found"), published=F.lit(None).cast("string"), modified=F.lit(None).cast("string"), revision=F.lit(revision), url=url, references=references, body=canonical(body)))
    return records, whole.filter("error is not null").select("path", "error", "mapping")


def signature_blocks(lines: DataFrame) -> DataFrame:
    """One row for each file of signature lines (path, line_number from 0, line): how many six-line matcher blocks it has, how
    many lines are no part of a well-formed block, and a digest of the blocks in order."""
    kept = lines.filter((F.col("line") != "") & ~F.col("line").startswith("# digest: "))
    from pyspark.sql import Window

    block = F.sum(F.when(F.col("line") == "      - type: dsl", 1).otherwise(0)).over(Window.partitionBy("path").orderBy("line_number"))
    grouped = kept.withColumn("block", block).groupBy("path", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_number", "line"))), lambda x: x["line"]), "\n").alias("body"), F.count(F.lit(1)).alias("n_lines"))
    pattern = r"""^      - type: dsl\n        name: ([A-Za-z0-9._-]{1,256})\n        dsl:\n          - 'regex\("/plugins/([A-Za-z0-9._-]{1,256})/", body\)'\n          - 'status_code == 200'\n        condition: and$"""
    good = (F.col("block") > 0) & F.col("body").rlike(pattern) & (F.regexp_extract("body", pattern, 1) == F.regexp_extract("body", pattern, 2))
    return grouped.withColumn("good", good).groupBy("path").agg(
        F.count_if("good").alias("matcher_count"),
        F.sum(F.when(~F.col("good"), F.col("n_lines")).otherwise(0)).alias("odd_lines"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("good"), F.struct("block", F.concat("body", F.lit("\n")).alias("body"))))), lambda x: x["body"]), ""), 256).alias("matcher_blocks_sha256"),
    )


def active_projection(records: DataFrame) -> DataFrame:
    """What consumers see of active records."""
    return records.filter("status = 'active'").select("record_id", "source_id", "native_id", "kind", "aliases", "status", "title", "references", "published_at", "source_modified_at")

"""Canonical JSON, digests and identities as column expressions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the record format: what a change of is not a change of the fact.
VOLATILE_FIELDS = [
    "content_hash", "first_seen_at", "source_modified_at", "observed_at", "last_seen_at", "source_revision", "upstream_revision", "source_commit",
    "index_revision", "intel_commit_sha", "collected_at", "fetched_at", "derived", "assessment", "last_material_event_at",
]
NESTED_REVISION_FIELDS = [
    "source_revision", "upstream_revision", "source_commit", "index_revision", "intel_commit_sha", "source_index_url", "collected_at", "fetched_at",
    "observed_at", "last_seen_at",
]
CVE = "CVE-[0-9]{4}-[0-9]{4,}"
GHSA = "GHSA(-[23456789cfghjmpqrvwx]{4}){3}"


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no spaces. Whole-number and exponent floats follow Spark's spelling; see canonical_json_exact."""
    return F.to_json(F.parse_json(text))


@F.pandas_udf(T.StringType())
def canonical_json_exact(texts: pd.Series) -> pd.Series:
    """The same, byte for byte as Python's json spells numbers and sorts keys: for hashes that foreign snapshots carry."""
    return texts.map(lambda x: None if x is None else json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True, separators=(",", ":")))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def canonical_digest(text: Column) -> Column:
    """Digest of canonical JSON with its final line feed."""
    return digest(F.concat(canonical_json(text), F.lit("\n")))


def git_blob_sha1(content: Column) -> Column:
    """The object id that git gives to a file's bytes."""
    body = content.cast("binary")
    return F.sha1(F.concat(F.lit("blob ").cast("binary"), F.octet_length(body).cast("string").cast("binary"), F.unhex(F.lit("00")), body))


def json_string(value: Column) -> Column:
    """A JSON string, or null."""
    return F.when(value.isNull(), F.lit("null")).otherwise(F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'^\{"v":(.*)\}$', 1))


def event_id(record_id: Column, old_hash: Column, new_hash: Column, event_type: Column, revision: Column, policy_version: Column) -> Column:
    """A change event's identity: the digest of its six parts as a canonical JSON list."""
    parts = [json_string(x) for x in (record_id, old_hash, new_hash, event_type, revision, policy_version)]
    return digest(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]\n")))


def _facts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    nested, top = set(NESTED_REVISION_FIELDS), set(VOLATILE_FIELDS)
    only_nested = sorted(nested - top)  # at the top these are facts

    def stripped(pairs: list[tuple]) -> dict:
        """Called by the parser for each object, the innermost first."""
        return {k: v for k, v in pairs if k not in nested}

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        facts = json.loads(text, object_pairs_hook=stripped)
        if any(f'"{k}"' in text for k in only_nested):
            whole = json.loads(text)
            facts |= {k: whole[k] for k in only_nested if k in whole}
        for k in top & facts.keys():
            del facts[k]
        if "provenance" in facts:
            facts["provenance"] = [{k: p[k] for k in p if k not in ("revision", "url")} if type(p) is dict else p for p in facts["provenance"]]
        return json.dumps(facts, ensure_ascii=False, sort_keys=True, separators=(",", ":"))

    for part in texts:
        yield part.map(one)


#: Canonical JSON of a record's facts: volatile fields dropped at the top, revision fields at any depth. Depth is what column
#: expressions can't follow, hence the Arrow batches.
semantic_json = F.pandas_udf(_facts, T.StringType())


def content_hash(record: Column) -> Column:
    return digest(F.concat(semantic_json(record), F.lit("\n")))


def instant(text: Column) -> Column:
    """A timestamp of ISO text; without a zone it is UTC (the session's zone is to be UTC)."""
    return F.try_to_timestamp(text)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def cve_path(cve: Column) -> Column:
    """Path of a CVE id's document: CVE-2024-12345 is cves/2024/12xxx/CVE-2024-12345.json."""
    number = F.regexp_extract(cve, "^CVE-([0-9]{4})-([0-9]+)$", 2)
    bucket = F.when(F.length(number) > 3, F.concat(F.regexp_replace(number, "[0-9]{3}$", ""), F.lit("xxx"))).otherwise("0xxx")
    return F.concat(F.lit("cves/"), F.substring(cve, 5, 4), F.lit("/"), bucket, F.lit("/"), cve, F.lit(".json"))


def id_of_path(path: Column) -> Column:
    """CVE id that a path's file name carries, if its year folder agrees; else null."""
    cve = F.regexp_extract(path, f"(?:^|/)({CVE})\\.json$", 1)
    year = F.regexp_extract(path, "(?:^|/)([0-9]{4})/", 1)
    return F.when((cve != "") & ((year == "") | (year == F.substring(cve, 5, 4))), cve)


def source_partition(source: Column) -> Column:
    return F.when(source.rlike("^[A-Za-z0-9._-]+$"), source).otherwise(F.concat(F.lit("source-"), F.left(digest(source), F.lit(16))))


def tags(value: Column) -> Column:
    """Tags of a comma-separated string, sorted, each once."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != "")))


def aliases_in(text: Column) -> Column:
    """CVE ids in a text, sorted, each once."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({CVE})"), F.lit(1))))


def quoted_path(path: Column) -> Column:
    """A path with each of its parts percent-encoded."""
    return F.array_join(F.transform(F.split(path, "/"), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))), "/")


def truncated(text: Column, n: int) -> Column:
    """The first n characters of a diagnostic text."""
    return F.left(text, F.lit(n))

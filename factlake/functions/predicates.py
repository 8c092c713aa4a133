"""Predicates over URLs, paths and records."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the format.
RESERVED_OWNERS = [
    "about", "account", "accounts", "advisories", "apps", "blog", "collections", "contact", "customer-stories", "enterprise", "events", "explore",
    "features", "gist", "issues", "join", "login", "logout", "marketplace", "new", "notifications", "orgs", "organizations", "pricing", "pulls",
    "search", "security", "sessions", "settings", "site", "sponsors", "stars", "topics", "trending", "users",
]
RECORD_KINDS = ["advisory", "poc", "resource", "continuation"]
EVENT_TYPES = [
    "disclosure", "affected_corrected", "score_changed", "withdrawn", "rejected", "kev_added", "kev_removed", "poc_added", "poc_changed",
    "template_added", "template_requirements_changed", "template_logic_changed", "source_deleted", "retention_removed",
]
REQUIRED = [
    "schema_version", "record_id", "kind", "source_id", "native_id", "aliases", "status", "title", "published_at", "source_modified_at",
    "first_seen_at", "affected", "references", "provenance", "content_hash",
]

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def authority(url: Column) -> Column:
    return F.regexp_extract(url, _AUTHORITY, 1)


def host(url: Column) -> Column:
    """Host of a URL in lower case, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(authority(url), "^.*@", ""), ":[0-9]*$", ""))


def public_url(url: Column) -> Column:
    """An http or https URL with a host and without credentials; an empty user before the host is none."""
    user = F.regexp_extract(authority(url), "^(.*)@", 1)
    return url.isNotNull() & url.rlike("(?i)^https?://") & (host(url) != "") & user.isin("", ":")


@F.pandas_udf(T.StringType())
def _unusual_host(hosts: pd.Series) -> pd.Series:
    """Reason against an IPv6 address or a host name with non-ASCII letters."""

    def one(h):
        if h is None:
            return None
        try:
            return None if ipaddress.ip_address(h.strip("[]")).is_global else "non_public_url_host"
        except ValueError:
            pass
        try:
            name = h.encode("idna").decode("ascii").rstrip(".").lower()
        except UnicodeError:
            return "invalid_url_host"
        return None if "." in name and not name.rsplit(".", 1)[1].isdigit() else "invalid_url_host"

    return hosts.map(one)


def _ipv4_not_global(h: Column) -> Column:
    """Whether a dotted address lies in a range that is not globally reachable."""
    p = F.transform(F.split(h, r"\."), lambda x: x.cast("int"))
    a, b, c, d = (F.get(p, i) for i in range(4))
    blocks = (a == 0) | (a == 10) | (a == 127) | (a >= 240) | ((a == 100) & b.between(64, 127)) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31))
    return blocks | ((a == 192) & (b == 168)) | ((a == 192) & (b == 0) & ((c == 2) | ((c == 0) & ~d.isin(9, 10)))) | ((a == 198) & b.isin(18, 19)) | ((a == 198) & (b == 51) & (c == 100)) | ((a == 203) & (b == 0) & (c == 113))


def official_reference_reason(url: Column, unusual: bool = True) -> Column:
    """Why a URL is no official reference, or null. The first reason that applies counts. ``unusual`` also judges IPv6
    addresses and international names, which take an Arrow function for those rows alone."""
    where, h = authority(url), host(url)
    port = F.regexp_extract(F.regexp_replace(where, "^.*@", ""), ":([0-9]*)$", 1)
    dotted = h.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    odd = h.startswith("[") | h.rlike("[^\\x00-\\x7F]")
    label = "[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?"
    named = h.rlike(f"^({label}\\.)+{label}\\.?$") & ~h.rlike(r"(^|\.)[0-9]+\.?$") & (F.length(h) <= 254)
    reason = (
        F.when(url.isNull(), "url_not_string")
        .when((url == "") | url.rlike("[\\s\\x00-\\x20\\x7F\\u0085\\u00a0\\u2000-\\u200a\\u2028\\u2029\\u3000]"), "url_contains_whitespace_or_control")
        .when(url.contains("\\"), "url_contains_backslash")
        .when(where.rlike(r"^\[[^\]]*$") | where.rlike(r":[^0-9\]:@]+$") | (F.length(port) > 5) | (port.try_cast("int") > 65535), "malformed_url")
        .when(~url.rlike("(?i)^https?:"), "unsupported_url_scheme")
        .when((where == "") | (h == ""), "missing_url_host")
        .when(where.contains("@"), "url_contains_credentials")
        .when((port.try_cast("int") == 0) | where.endswith(":"), "invalid_url_port")
    )
    plain = F.when(dotted, F.when(F.exists(F.split(h, r"\."), lambda x: x.cast("int") > 255), "invalid_url_host").when(_ipv4_not_global(h), "non_public_url_host")).otherwise(
        F.when(~named, "invalid_url_host").when(F.regexp_replace(h, r"\.$", "").rlike(r"\.(localhost|local|internal)$"), "non_public_url_host")
    )
    return F.coalesce(reason, F.when(odd, _unusual_host(F.when(odd, h)) if unusual else F.lit(None)).otherwise(plain))


def reference_allowed(url: Column) -> Column:
    """A canonical repository root or a numbered exploit page: what may be probed."""
    repo = r"^https://github\.com/([A-Za-z0-9][A-Za-z0-9-]{0,38})/([A-Za-z0-9_][A-Za-z0-9_.-]{0,99})$"
    owner, name = F.regexp_extract(url, repo, 1), F.regexp_extract(url, repo, 2)
    canonical = ~owner.endswith("-") & ~name.contains("..") & ~name.endswith(".git") & ~F.lower(owner).isin(RESERVED_OWNERS)
    exploit = url.rlike(r"^https://www\.exploit-db\.com/exploits/[1-9][0-9]{0,9}$")
    return F.coalesce(url.isNotNull() & (F.length(url) <= 512) & (exploit | (url.rlike(repo) & canonical)), F.lit(False))


def safe_path(path: Column) -> Column:
    parts = F.exists(F.split(path, "/"), lambda x: x.isin(".", ".."))
    return F.coalesce((path != "") & ~path.rlike(r"[\\%:]") & ~path.startswith("/") & ~parts, F.lit(False))


def record_reasons(max_bytes: int | None = None) -> Column:
    """Why a row (the record columns, aliases an array of strings) is no valid record; empty if it is one."""
    present = [c for c in REQUIRED if c not in ("title", "published_at", "source_modified_at")]
    checks = [F.when(F.col(f"`{c}`").isNull(), f"missing {c}") for c in present]
    checks += [
        F.when(F.col("schema_version") != "1.0", "schema_version"),
        F.when(F.length("record_id") < 3, "record_id"),
        F.when(~F.col("kind").isin(RECORD_KINDS), "kind"),
        F.when(F.size("aliases") != F.size(F.array_distinct("aliases")), "aliases"),
        F.when(~F.col("content_hash").rlike("^[a-f0-9]{64}$"), "content_hash"),
    ]
    if max_bytes:
        checks.append(F.when(F.octet_length(F.to_json(F.struct("*"))) > max_bytes, "oversize"))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def event_reasons() -> Column:
    checks = [F.when(F.col(c).isNull(), f"missing {c}") for c in ("event_id", "record_id", "event_type", "observed_at", "policy_version")]
    checks += [F.when(~F.col("event_id").rlike("^[a-f0-9]{64}$"), "event_id"), F.when(~F.col("event_type").isin(EVENT_TYPES), "event_type")]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def split_valid(df, reasons: Column):
    """The valid rows, and the others with their reasons."""
    judged = df.withColumn("reasons", reasons)
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)

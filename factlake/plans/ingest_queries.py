"""Queries of the ingest job and of the schema checks, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import once, violations
from ..operators.ingest import EVENT_COLUMNS, STATE_COLUMNS, ingest

#: Orders come in batches up to these days; the second has records that don't fit.
CUTS = ["1994-01-01", "1996-01-01", "1999-01-01"]
NOW = [f"{d}T00:00:00Z" for d in CUTS]


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order of a batch as a record: events, state, quarantine and source status after three batches, the last
    two of which say which customers there are (those with an order of a higher priority)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    number = F.when(day < CUTS[0], 0).when(day < CUTS[1], 1).otherwise(2)
    state, events = spark.createDataFrame([], STATE_COLUMNS), spark.createDataFrame([], EVENT_COLUMNS)
    source, kept, status = {}, [], None
    for n, now in enumerate(NOW):
        of_batch = orders.filter(number == n)
        native, at = F.col("o_custkey").cast("string"), F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'")
        aliases = F.when((F.lit(n) == 1) & F.col("o_orderpriority").startswith("4"), F.array(F.lit("x"), F.lit("x"))).otherwise(F.array().cast("array<string>"))
        fields = {
            "record_id": F.concat(F.lit("orders/"), native), "source_id": F.lit("orders"), "native_id": native, "kind": F.lit("advisory"), "aliases": aliases,
            "status": F.when(F.col("o_orderstatus") == "F", "withdrawn").otherwise("active"), "title": F.lit(None).cast("string"), "published_at": at, "source_modified_at": at,
            "affected": F.array("o_orderpriority"), "metrics": F.struct(F.round(F.col("o_totalprice")).cast("long").alias("total")), "references": F.array().cast("array<string>"), "provenance": F.array().cast("array<string>"),
        }
        line = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
        batch = of_batch.select(fields["record_id"].alias("record_id"), F.struct(day, "o_orderkey").alias("seq"), line.alias("line"))
        done = ingest(state, batch, events, source, source_id="orders", revision=str(n), now=now, policy_version="1", inventory=batch.filter(~F.get_json_object("line", "$.affected[0]").startswith("5")).select("record_id") if n else None, watermark=CUTS[n])
        state, events, status = done.state, done.events, done.source
        source = status.first().asDict()
        kept.append(done.quarantine.select("record_id", F.array_join("reasons", "; ").alias("name"), F.lit(now).alias("at")))
    field = lambda name: F.get_json_object("line", f"$.{name}")
    none = F.lit(None).cast("string")
    out = events.select(F.lit("event").alias("what"), "record_id", F.col("event_type").alias("name"), "content_hash", "previous_hash", F.col("observed_at").alias("at"))
    out = out.union(state.select(F.lit("state"), "record_id", field("status"), field("content_hash"), none, field("last_material_event_at")))
    out = out.union(status.select(F.lit("source"), "source_id", "status", none, "completed_watermark", "last_success_at"))
    for q in kept:
        out = out.union(q.select(F.lit("quarantine"), "record_id", "name", none, none, "at"))
    return out


DOCUMENT = {
    "type": "object",
    "required": ["doc_id", "lang", "source", "text"],
    "properties": {
        "lang": {"enum": ["en", "de"]},
        "n_chars": {"type": "integer", "minimum": 100, "maximum": 3000},
        "source": {"type": "string", "pattern": "[0-4]$"},
        "text": {"type": "string", "minLength": 200},
        "tags": {"type": "array", "uniqueItems": True, "items": {"type": "object", "properties": {"name": {"type": "string", "maxLength": 5}}}},
    },
}


def schema_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why documents, as JSON, don't fit a schema that is given as data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tags = F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name")), F.struct(F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("other").alias("name")))
    line = F.to_json(F.struct("doc_id", "lang", "n_chars", "source", "text", tags.alias("tags")))
    # a filter would find the reasons, and the projection after it find them again
    found = once(violations(line, DOCUMENT), lambda r: F.when(F.size(r) > 0, F.array(F.array_join(r, "; "))).otherwise(F.array().cast("array<string>")))
    return docs.select("doc_id", F.explode(found).alias("reasons"))


def _step(n: int) -> str:
    """State and events after batch n, from those before."""
    b, p, now = f"b{n}", f"s{n - 1}", NOW[n]
    before = f"SELECT * FROM {p}" if n else "SELECT NULL AS c, NULL AS st, NULL AS pri, NULL AS total, NULL AS pub, NULL AS h, NULL AS w WHERE false"
    inventory = f"NOT EXISTS (SELECT 1 FROM f WHERE b = {n} AND bad)" if n else "false"
    return f"""
  p{n} AS ({before}),
  j{n} AS (SELECT coalesce(o.c, i.c) AS c, o.h AS oh, i.h AS nh, o.st AS ost, i.st AS nst, o.pri AS opri, i.pri AS npri, o.total AS ot, i.total AS nt, o.pub AS opub, i.pub AS npub, o.w AS ow, i.c IS NOT NULL AND o.h IS DISTINCT FROM i.h AS taken,
    CASE WHEN i.c IS NULL OR o.h = i.h THEN [] WHEN o.c IS NULL THEN ['disclosure'] ELSE list_filter([CASE WHEN o.st <> i.st THEN CASE WHEN i.st = 'withdrawn' THEN 'withdrawn' WHEN o.st IN ('withdrawn', 'source_deleted') THEN 'disclosure' END END,
      CASE WHEN o.pri <> i.pri THEN 'affected_corrected' END, CASE WHEN o.total <> i.total THEN 'score_changed' END], lambda x: x IS NOT NULL) END AS types
    FROM p{n} o FULL JOIN (SELECT * FROM f WHERE b = {n} AND NOT bad) i ON o.c = i.c),
  a{n} AS (SELECT c, CASE WHEN taken THEN nst ELSE ost END AS st, CASE WHEN taken THEN npri ELSE opri END AS pri, CASE WHEN taken THEN nt ELSE ot END AS total, CASE WHEN taken THEN npub ELSE opub END AS pub,
    CASE WHEN taken THEN nh ELSE oh END AS h, CASE WHEN len(types) > 0 THEN '{now}' ELSE ow END AS w, oh, types, {inventory} AND oh IS NOT NULL AND c NOT IN (SELECT c FROM o WHERE b = {n} AND pri NOT LIKE '5%') AND (CASE WHEN taken THEN nst ELSE ost END) <> 'source_deleted' AS gone FROM j{n}),
  s{n} AS (SELECT c, CASE WHEN gone THEN 'source_deleted' ELSE st END AS st, pri, total, pub, CASE WHEN gone THEN {_hash("'source_deleted'")} ELSE h END AS h, CASE WHEN gone THEN '{now}' ELSE w END AS w FROM a{n}),
  e{n} AS (SELECT c, unnest(types) AS t, h, oh, '{now}' AS w FROM a{n} UNION ALL SELECT c, 'source_deleted', {_hash("'source_deleted'")}, h, '{now}' FROM a{n} WHERE gone)"""


def _hash(status: str) -> str:
    return f"""sha256('{{"affected":["' || pri || '"],"aliases":[],"kind":"advisory","metrics":{{"total":' || total || '}},"native_id":"' || c || '","provenance":[],"published_at":"' || pub || '","record_id":"orders/' || c || '","references":[],"schema_version":"1.0","source_id":"orders","status":"' || {status} || '","title":null}}' || chr(10))"""


QUERIES = {"ingest": ingest_batches, "schema_quarantine": schema_quarantine}
SQL = {
    "ingest": f"""WITH o AS (SELECT o_custkey AS c, o_orderdate::DATE AS d, o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'withdrawn' ELSE 'active' END AS st, round(o_totalprice)::BIGINT AS total, o_orderpriority AS pri,
    strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS pub, CASE WHEN o_orderdate::DATE < DATE '{CUTS[0]}' THEN 0 WHEN o_orderdate::DATE < DATE '{CUTS[1]}' THEN 1 ELSE 2 END AS b FROM orders),
  f AS (SELECT *, b = 1 AND pri LIKE '4%' AS bad, {_hash("st")} AS h FROM (SELECT *, row_number() OVER (PARTITION BY b, c ORDER BY d DESC, k DESC) AS r FROM o) WHERE r = 1),{",".join(_step(n) for n in range(3))}
SELECT 'event' AS what, 'orders/' || c AS record_id, t AS name, h AS content_hash, oh AS previous_hash, w AS "at" FROM (SELECT * FROM e0 UNION ALL SELECT * FROM e1 UNION ALL SELECT * FROM e2)
UNION ALL SELECT 'state', 'orders/' || c, st, h, NULL, w FROM s2
UNION ALL SELECT 'source', 'orders', 'ok', NULL, '{CUTS[2]}', '{NOW[2]}'
UNION ALL SELECT 'quarantine', 'orders/' || c, '$.aliases: items repeat', NULL, NULL, '{NOW[1]}' FROM f WHERE bad""",
    "schema_quarantine": """WITH d AS (SELECT doc_id, list_sort(list_filter([
    CASE WHEN lang IS NULL THEN '$: lacks lang' WHEN lang NOT IN ('en', 'de') THEN '$.lang: not one of the values' END,
    CASE WHEN source IS NULL THEN '$: lacks source' WHEN NOT regexp_matches(source, '[0-4]$') THEN '$.source: does not match the pattern' END,
    CASE WHEN text IS NULL THEN '$: lacks text' WHEN length(text) < 200 THEN '$.text: too short' END, CASE WHEN doc_id IS NULL THEN '$: lacks doc_id' END,
    CASE WHEN n_chars < 100 THEN '$.n_chars: breaks minimum 100' WHEN n_chars > 3000 THEN '$.n_chars: breaks maximum 3000' END,
    CASE WHEN doc_id % 3 = 0 OR lang = source OR 'other' IN (lang, source) THEN '$.tags: items repeat' END,
    CASE WHEN length(lang) > 5 THEN '$.tags[0].name: too long' END, CASE WHEN length(source) > 5 THEN '$.tags[1].name: too long' END,
    CASE WHEN doc_id % 3 = 0 AND length(lang) > 5 THEN '$.tags[2].name: too long' END], lambda x: x IS NOT NULL)) AS r FROM documents)
SELECT doc_id, array_to_string(r, '; ') AS reasons FROM d WHERE len(r) > 0""",
}

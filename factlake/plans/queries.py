"""Queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import predicates as P
from ..operators import changes, costs, coverage, fragments, physical, reconcile, replay, retention, shards
from ..sources import snapshots
from ..streaming import streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as a query under its name, with the SQL that gives its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER = ["ts", "event_id"]


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
SELECT event_type, count(*) AS n_users, sum(event_id)::BIGINT AS id_sum FROM l WHERE r = 1 AND event_type <> 'error' GROUP BY event_type""")
def replay_latest(spark, sf_dir):
    """Last event of each user, errors as tombstones, by type."""
    state = replay.replay(_t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ORDER, F.col("event_type") == "error")
    return state.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_users"), F.sum("event_id").alias("id_sum"))


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE ts < TIMESTAMP '2024-01-15')
SELECT user_id, event_id, event_type, value FROM l WHERE r = 1 AND event_type <> 'error'""")
def replay_as_of(spark, sf_dir):
    """State of each user as of a day."""
    log = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return replay.replay(log, "user_id", ORDER, F.col("event_type") == "error", F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).drop("ts")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12')
SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op FROM l WHERE r = 1""")
def read_changes(spark, sf_dir):
    """Changes between two versions: the log's suffix alone is read."""
    days = F.col("ts").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz"))
    log = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type").filter(days)
    return replay.changes(log, "user_id", ORDER, F.col("event_type") == "error").select("user_id", "event_id", "op")


@query("""WITH cur AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus || 'x' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL SELECT -o_orderkey - 1, o_orderstatus FROM orders WHERE o_orderkey % 13 = 0)
SELECT 'upsert' AS op, c.o_orderkey FROM cur c LEFT JOIN orders p ON c.o_orderkey = p.o_orderkey WHERE p.o_orderkey IS NULL OR p.o_orderstatus <> c.s
UNION ALL SELECT 'delete', p.o_orderkey FROM orders p LEFT JOIN cur c ON c.o_orderkey = p.o_orderkey WHERE c.o_orderkey IS NULL""")
def snapshot_diff(spark, sf_dir):
    """Upserts and deletes between a table and an altered copy of it."""
    prior = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("line"))
    new = prior.filter("o_orderkey % 13 = 0").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "line")
    cur = prior.filter("o_orderkey % 11 <> 0").withColumn("line", F.when(F.col("o_orderkey") % 7 == 0, F.concat("line", F.lit("x"))).otherwise(F.col("line"))).union(new)
    return changes.upserts(prior, cur, "o_orderkey", "line").select(F.lit("upsert").alias("op"), "o_orderkey").union(changes.deletes(prior, cur, "o_orderkey").select(F.lit("delete"), "o_orderkey"))


@query("""WITH inc AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS k, CASE WHEN c_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS s, 2 AS seen FROM customer WHERE c_custkey % 2 = 0),
  cur AS (SELECT c_custkey AS k, c_mktsegment AS s, 1 AS seen FROM customer)
SELECT coalesce(cur.k, inc.k) AS c_custkey, CASE WHEN inc.k IS NULL OR cur.s = inc.s THEN cur.s ELSE inc.s END AS segment, coalesce(cur.seen, inc.seen)::INT AS first_seen,
  CASE WHEN cur.k IS NULL THEN 'insert' WHEN inc.k IS NULL THEN 'absent' WHEN cur.s = inc.s THEN 'unchanged' ELSE 'update' END AS change
FROM cur FULL JOIN inc ON cur.k = inc.k""")
def apply_batch(spark, sf_dir):
    """A batch merged into the state: equal content changes nothing, first_seen is kept."""
    c = _t(spark, sf_dir, "customer")
    cur = c.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lit(1).alias("first_seen"))
    inc = c.filter("c_custkey % 2 = 0").select(
        F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey") + 1000000).otherwise(F.col("c_custkey")).alias("c_custkey"),
        F.when(F.col("c_custkey") % 3 == 0, "CHANGED").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.lit(2).alias("first_seen"),
    )
    return changes.merge(cur, inc, "c_custkey", "segment", kept=["first_seen"])


_EVENTS = """WITH v AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, lag(o_orderkey) OVER w AS pk, lag(o_orderstatus) OVER w AS ps, lag(o_orderpriority) OVER w AS pp, lag(o_totalprice) OVER w AS pt
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
  m AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'withdrawn' ELSE 'rejected' END AS s, CASE ps WHEN 'F' THEN 'active' WHEN 'O' THEN 'withdrawn' ELSE 'rejected' END AS q FROM v),
  e AS (SELECT o_custkey, o_orderkey, CASE WHEN pk IS NULL THEN [CASE WHEN o_orderpriority LIKE '1%' THEN 'kev_added' ELSE 'disclosure' END]
    ELSE list_filter([CASE WHEN s <> q AND s IN ('withdrawn', 'rejected') THEN s WHEN s <> q THEN 'disclosure' END,
      CASE WHEN (o_orderpriority LIKE '1%') <> (pp LIKE '1%') THEN CASE WHEN o_orderpriority LIKE '1%' THEN 'kev_added' ELSE 'kev_removed' END END,
      CASE WHEN floor(o_totalprice / 100000) <> floor(pt / 100000) THEN 'score_changed' END], lambda x: x IS NOT NULL) END AS t FROM m)
SELECT o_custkey, o_orderkey, unnest(t) AS event_type FROM e"""


@query(_EVENTS)
def derive_events(spark, sf_dir):
    """Typed change events between the consecutive orders of a customer, taken as versions of a record."""
    from pyspark.sql import Window

    o = _t(spark, sf_dir, "orders")
    none = F.lit(None).cast("string")
    status = F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "withdrawn").otherwise("rejected")
    record = F.struct(
        F.lit("advisory").alias("kind"), F.lit("orders").alias("source_id"), status.alias("status"), F.col("o_orderpriority").startswith("1").alias("kev"), none.alias("affected"),
        F.floor(F.col("o_totalprice") / 100000).cast("string").alias("scores"), none.alias("severity"), none.alias("metrics"), F.array().cast("array<string>").alias("assertion_metrics"),
        none.alias("semantic"), none.alias("requirements"), none.alias("dependencies"), none.alias("sha256"), F.array().cast("array<string>").alias("proof"),
    )
    versions = o.select("o_custkey", "o_orderkey", "o_orderdate", record.alias("new"))
    pairs = versions.withColumn("old", F.lag("new").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    return pairs.select("o_custkey", "o_orderkey", F.explode(changes.event_types()).alias("event_type"))


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'source_deleted' ELSE 'active' END AS status FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def authoritative_delete(spark, sf_dir):
    """Documents after labels as a completed inventory."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.lit("active").alias("status"))
    return changes.authoritative_delete(docs, _t(spark, sf_dir, "labels"), True, "doc_id").select("doc_id", "status")


@query("""WITH p AS (SELECT DISTINCT o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'P')
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus <> 'O' AND NOT kev AND p.o_custkey IS NULL THEN 'removed' ELSE 'kept' END AS verdict
FROM (SELECT *, coalesce(c_mktsegment = 'BUILDING' AND o_orderstatus = 'P', false) AS kev FROM orders LEFT JOIN customer ON c_custkey = o_custkey) o LEFT JOIN p ON p.o_custkey = o.o_custkey""")
def expire(spark, sf_dir):
    """Retention: old orders go, unless open, exploited, or of a customer with an exploited one."""
    o = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    records = o.select(
        F.col("o_orderkey").alias("record_id"),
        F.when(F.col("o_orderstatus") == "O", "resource").otherwise("advisory").alias("kind"),
        ((F.col("c_mktsegment") == "BUILDING") & (F.col("o_orderstatus") == "P")).alias("kev"),
        F.array("o_custkey").alias("aliases"),
        F.col("o_orderdate").alias("published_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_material_event_at"),
        F.lit("active").alias("status"),
    )
    judged = retention.with_expiry(records, F.lit("1998-01-01").cast("timestamp_ntz"))
    return judged.select(F.col("record_id").alias("o_orderkey"), F.when(F.col("expired"), "removed").otherwise("kept").alias("verdict"))


@query("SELECT sha256(text) AS content_hash, max(doc_id) AS doc_id, min(doc_id) AS first_seq, list_sort(list_distinct(list(source))) AS sources FROM documents GROUP BY sha256(text)")
def content_dedup(spark, sf_dir):
    """Documents of equal content as one: the last counts, sources are united."""
    docs = _t(spark, sf_dir, "documents").select(H.digest(F.col("text")).alias("content_hash"), "doc_id", F.array("source").alias("sources"), F.col("doc_id").alias("seq"))
    return changes.dedup_batch(docs, "content_hash", "seq", ["sources"]).select("content_hash", "doc_id", "first_seq", "sources")


_PLAN = """WITH d AS (SELECT doc_id, source, octet_length(encode(text)) AS s, sha256(doc_id::VARCHAR) AS h FROM documents),
  g AS (SELECT source, k, left(h, k) AS p, sum(s) AS b, count(*) AS n FROM d, generate_series(2, 10) AS t(k) GROUP BY ALL),
  f AS (SELECT * FROM g WHERE b <= 65536 OR n = 1 OR k = 10),
  shards AS (SELECT f.source, f.p, f.k FROM f LEFT JOIN f u ON f.source = u.source AND left(f.p, f.k - 1) = u.p AND u.k = f.k - 1 WHERE u.p IS NULL),
  planned AS (SELECT d.*, p AS prefix FROM d JOIN shards s ON d.source = s.source AND left(d.h, s.k) = s.p)"""


@query(f"{_PLAN} SELECT source, prefix, count(*) AS n_rows, sum(s)::BIGINT AS bytes FROM planned GROUP BY source, prefix")
def shard_plan(spark, sf_dir):
    """Shards of documents: by source, then digest prefixes until 64 KiB fit."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source", F.octet_length("text").cast("long").alias("bytes"))
    return shards.shard_plan(docs, ["source"], "doc_id", "bytes", 65536).groupBy("source", "prefix").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("bytes").alias("bytes"))


@query(f"""{_PLAN}, t AS (SELECT planned.source, prefix, doc_id, '{{"doc_id":' || doc_id || ',"lang":"' || lang || '"}}' AS line FROM planned JOIN documents USING (doc_id))
SELECT source, prefix, count(*) AS count, sum(strlen(line) + 1)::BIGINT AS bytes, sha256(string_agg(line, chr(10) ORDER BY doc_id) || chr(10)) AS sha256 FROM t GROUP BY source, prefix""")
def shard_descriptors(spark, sf_dir):
    """Count, bytes and digest of each shard's canonical lines."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.octet_length("text").cast("long").alias("bytes"))
    planned = shards.shard_plan(docs, ["source"], "doc_id", "bytes", 65536)
    lines = planned.select("source", "prefix", "doc_id", H.canonical_json(F.to_json(F.struct("lang", "doc_id"))).alias("line"))
    return shards.descriptors(lines, ["source", "prefix"], "doc_id", "line")


@query("""WITH p AS (SELECT left(sha256(s_suppkey::VARCHAR), 2) AS b, s_suppkey || ':' || md5(s_name) AS x FROM supplier),
  d AS (SELECT b, sha256(string_agg(x, ',' ORDER BY x)) AS d, count(*) AS n FROM p GROUP BY b)
SELECT sha256(string_agg(d, ',' ORDER BY b)) AS digest, sum(n)::BIGINT AS n_rows FROM d""")
def snapshot_digest(spark, sf_dir):
    """One digest of a table, whatever its partitioning."""
    return shards.snapshot_digest(_t(spark, sf_dir, "supplier").select("s_suppkey", F.md5("s_name").alias("h")), "s_suppkey", "h")


@query("""SELECT 'customer/' || c_custkey AS record_id, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 11 <> 0""")
def snapshot_roundtrip(spark, sf_dir):
    """Customers written as a checkpoint, then, some of them new, changed or gone, as a delta; verified, read and replayed."""
    c = _t(spark, sf_dir, "customer").select(F.concat(F.lit("customer/"), F.col("c_custkey").cast("string")).alias("record_id"), F.lit("customer").alias("source_id"), "c_custkey", F.col("c_mktsegment").alias("segment"))
    changed = c.withColumn("segment", F.when(F.col("c_custkey") % 7 == 0, "CHANGED").otherwise(F.col("segment"))).filter("c_custkey % 11 <> 0")
    no_events, root = spark.createDataFrame([], "event_id string, observed_at string, line string"), streams.folder(spark, "snapshot")
    for day, version in enumerate((c.filter("c_custkey % 5 <> 0"), changed), 1):
        rows = version.select("record_id", "source_id", F.to_json(F.struct("record_id", "source_id", "segment")).alias("line"))
        snapshots.write_version(spark, root, rows, no_events, now=f"2024-01-0{day}T00:00:00Z", run_id=f"r{day}", event_start_at="2024-01-01T00:00:00Z")
    records, _ = snapshots.read_version(spark, root)
    return records.select("record_id", F.get_json_object("line", "$.segment").alias("segment"))


@query("SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS bytes, CASE WHEN octet_length(encode(text)) > 4096 THEN ceil(octet_length(encode(text)) / 2048.0)::INT END AS total_parts FROM documents")
def fragment_roundtrip(spark, sf_dir):
    """Long texts cut into parts, put together again, verified."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    parents, parts = fragments.fragment(docs, "doc_id", "text", 4096, 2048)
    back = fragments.reassemble(parents, parts, "doc_id", "text")
    return back.join(parents.select("doc_id", "total_parts"), "doc_id").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"), "total_parts")


@query("SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS bytes FROM documents")
def physical_roundtrip(spark, sf_dir):
    """Documents as records, long ones as stubs and parts, half of them packed, and put together again."""
    docs = _t(spark, sf_dir, "documents").filter("doc_id is not null and text is not null").select("doc_id", "text")
    source, native = F.when(F.col("doc_id") % 2 == 0, "cve").otherwise("documents"), F.col("doc_id").cast("string")
    none, empty, day = F.lit(None).cast("string"), F.array().cast("array<string>"), F.lit("2024-01-01T00:00:00Z")
    fields = {
        "schema_version": F.lit("1.0"), "record_id": F.concat(source, F.lit("/"), native), "source_id": source, "native_id": native, "kind": F.lit("advisory"), "status": F.lit("active"), "published_at": none,
        "source_modified_at": none, "first_seen_at": day, "content_hash": F.sha2("text", 256), "title": F.col("text"), "aliases": empty, "affected": empty, "references": empty, "provenance": empty,
    }
    line = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
    lines = physical.physical(docs.select(fields["record_id"].alias("record_id"), H.canonical_json(line).alias("line"))).select("record_id", "line")
    root = streams.folder(spark, "physical")  # the lines are kept, as a reader of them looks at them twice
    lines.write.parquet(f"{root}/lines")
    back = physical.logical(spark.read.schema(lines.schema).parquet(f"{root}/lines"))
    text = F.get_json_object("line", "$.title")
    return back.select(F.get_json_object("line", "$.native_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("bytes"))


@query("""WITH c AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS total FROM (SELECT DISTINCT conv_id, turn FROM conversations)),
  k AS (SELECT * FROM c WHERE (conv_id + turn) % 5 <> 0), dup AS (SELECT * FROM k UNION ALL SELECT * FROM k WHERE conv_id % 7 = 0 AND turn = 1),
  s AS (SELECT conv_id, count(*) AS n, count(DISTINCT turn) AS d, min(turn) AS lo, max(turn) AS hi FROM dup GROUP BY conv_id),
  p AS (SELECT conv_id, max(total) AS t FROM c WHERE conv_id % 9 <> 0 GROUP BY conv_id)
SELECT * FROM (SELECT coalesce(p.conv_id, s.conv_id) AS conv_id, CASE WHEN p.conv_id IS NULL THEN 'orphan' WHEN n IS NULL THEN 'missing' WHEN n > d THEN 'duplicate' WHEN n < t OR lo <> 0 OR hi <> t - 1 THEN 'missing' END AS reason
FROM p FULL JOIN s ON p.conv_id = s.conv_id) WHERE reason IS NOT NULL""")
def fragment_integrity(spark, sf_dir):
    """Conversations as parents, turns as parts, some taken away or doubled: what no longer fits."""
    turns = _t(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    parents = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total_parts")).filter("conv_id % 9 <> 0")
    kept = turns.filter("(conv_id + turn) % 5 <> 0")
    kept = kept.union(kept.filter("conv_id % 7 = 0 and turn = 1"))
    parts = kept.select(F.col("conv_id").alias("parent"), F.col("turn").alias("part_index"), F.lit(b"x").alias("payload"), F.sha2(F.lit(b"x"), 256).alias("chunk_sha256"))
    return fragments.problems(parents, parts, "conv_id")


_URLS = """SELECT page_id, CASE page_id % 8 WHEN 1 THEN replace(url, 'https://', 'ftp://') WHEN 2 THEN replace(url, '://', '://user@') WHEN 3 THEN url || ' x' WHEN 4 THEN regexp_replace(url, '://[^/]*', '://10.0.0.7')
  WHEN 5 THEN regexp_replace(url, '://[^/]*', '://db.internal') WHEN 6 THEN regexp_replace(url, '://([^/]*)', '://\\1:0') ELSE url END AS url FROM pages"""


@query(f"""WITH u AS ({_URLS}), h AS (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS a FROM u)
SELECT page_id, CASE WHEN regexp_matches(url, '\\s') THEN 'url_contains_whitespace_or_control' WHEN NOT regexp_matches(url, '^https?:') THEN 'unsupported_url_scheme' WHEN contains(a, '@') THEN 'url_contains_credentials'
  WHEN regexp_matches(a, ':0$') THEN 'invalid_url_port' WHEN a = '10.0.0.7' THEN 'non_public_url_host' WHEN a LIKE '%.internal' THEN 'non_public_url_host' END AS reason,
  regexp_matches(url, '^https?://') AND NOT contains(a, '@') AS is_public FROM h""")
def reference_classify(spark, sf_dir):
    """Page URLs, some spoilt on purpose, with the reason against each as an official reference."""
    n, u = F.col("page_id") % 8, F.col("url")
    spoilt = (
        F.when(n == 1, F.replace(u, F.lit("https://"), F.lit("ftp://")))
        .when(n == 2, F.replace(u, F.lit("://"), F.lit("://user@")))
        .when(n == 3, F.concat(u, F.lit(" x")))
        .when(n == 4, F.regexp_replace(u, "://[^/]*", "://10.0.0.7"))
        .when(n == 5, F.regexp_replace(u, "://[^/]*", "://db.internal"))
        .when(n == 6, F.regexp_replace(u, "://([^/]*)", "://$1:0"))
        .otherwise(u)
    )
    pages = _t(spark, sf_dir, "pages").select("page_id", spoilt.alias("url"))
    return pages.select("page_id", P.official_reference_reason(F.col("url")).alias("reason"), P.public_url(F.col("url")).alias("is_public"))


@query("""SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '[0-9]{3}-[0-9]{4}'))) AS ids FROM documents WHERE regexp_matches(text, '[0-9]{3}-[0-9]{4}')""")
def id_extract(spark, sf_dir):
    """Identifiers in texts, sorted, each once."""
    pattern = "([0-9]{3}-[0-9]{4})"
    docs = _t(spark, sf_dir, "documents").filter(F.col("text").rlike(pattern))
    return docs.select("doc_id", F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))).alias("ids"))


@query("""SELECT * FROM (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey)::INT AS rank, count(*) OVER (PARTITION BY l_partkey) AS total_known_count
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)) WHERE rank <= 3""")
def topn_selection(spark, sf_dir):
    """The first three suppliers of each part, and how many are known."""
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    counts = reconcile.selection_counts(rows, "l_partkey", "l_suppkey", 3).select("l_partkey", "total_known_count")
    return reconcile.top_n(rows, "l_partkey", "l_suppkey", 3).join(counts, "l_partkey")


@query("""WITH prev AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'), listed AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
  sel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS r FROM listed) WHERE r <= 5), present AS (SELECT DISTINCT l_partkey, l_partkey % 10 <> 3 AS e FROM prev),
  gone AS (SELECT p.l_partkey, p.l_suppkey, CASE WHEN NOT e THEN 'source_file_absent' WHEN l.l_partkey IS NOT NULL THEN 'selection_limit' ELSE 'source_reference_removed' END AS reason
    FROM prev p JOIN present USING (l_partkey) LEFT JOIN sel s ON p.l_partkey = s.l_partkey AND p.l_suppkey = s.l_suppkey LEFT JOIN listed l ON p.l_partkey = l.l_partkey AND p.l_suppkey = l.l_suppkey WHERE s.l_partkey IS NULL)
SELECT p.l_suppkey, count(*) FILTER (g.reason IS NULL) AS n_kept, min(p.l_partkey) FILTER (g.reason IS NULL) AS first_kept,
  CASE WHEN count(*) FILTER (g.reason IS NULL) > 0 THEN 'active' WHEN bool_or(g.reason = 'selection_limit') THEN 'selection_removed' ELSE 'source_deleted' END AS status
FROM prev p LEFT JOIN gone g ON p.l_partkey = g.l_partkey AND p.l_suppkey = g.l_suppkey GROUP BY p.l_suppkey""")
def mapping_reconcile(spark, sf_dir):
    """Part-supplier mappings of a former period against a later selection: what is removed, why, and what suppliers keep."""
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    prev, listed = rows.filter(F.col("l_shipdate") < cut).drop("l_shipdate").distinct(), rows.filter(F.col("l_shipdate") >= cut).drop("l_shipdate").distinct()
    present = prev.select("l_partkey").distinct().withColumn("exists", F.col("l_partkey") % 10 != 3)
    removed = reconcile.removals(prev, reconcile.top_n(listed, "l_partkey", "l_suppkey", 5), listed, "l_partkey", "l_suppkey", present)
    out = reconcile.regrouped(prev, removed, "l_partkey", "l_suppkey")
    return out.select("l_suppkey", F.size("kept").cast("long").alias("n_kept"), F.get("kept", F.lit(0)).alias("first_kept"), "status")


@query("""WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND event_type = 'purchase'), b AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-05' AND event_type = 'purchase'),
  t AS (SELECT user_id, max(event_id) AS newest FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND event_type = 'error' GROUP BY user_id)
SELECT user_id, newest FROM (SELECT user_id FROM a EXCEPT SELECT user_id FROM b UNION SELECT user_id FROM t WHERE user_id IN (SELECT user_id FROM a)) LEFT JOIN t USING (user_id)""")
def changed_keys(spark, sf_dir):
    """Users to look at again: newly active ones, and active ones that a change log names."""
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    bought = e.filter("event_type = 'purchase'")
    late = F.lit("2024-01-20").cast("timestamp_ntz")
    active = bought.filter(F.col("ts") >= late).select(F.col("user_id").alias("alias")).distinct()
    before = bought.filter(F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")).select(F.col("user_id").alias("alias")).distinct()
    log = e.filter((F.col("ts") >= late) & (F.col("event_type") == "error"))
    files = log.select(F.col("user_id").alias("filename"), F.lit(None).cast("long").alias("previous_filename"))
    ids = reconcile.scan_ids(active, before, files, F.col("path"), False)
    newest = log.groupBy("user_id").agg(F.max("event_id").alias("newest"))
    return ids.withColumnRenamed("alias", "user_id").join(newest, "user_id", "left")


@query("""WITH base AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30') WHERE r = 1),
  last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1),
  ch AS (SELECT f.o_custkey, max(v.o_orderdate) AS c FROM last f JOIN orders v ON v.o_custkey = f.o_custkey AND v.o_orderdate BETWEEN TIMESTAMP '1998-06-30' AND TIMESTAMP '2001-08-01' AND v.o_orderstatus <> f.o_orderstatus GROUP BY f.o_custkey)
SELECT l.o_custkey, b.o_orderkey AS base_order, CASE WHEN b.o_orderkey IS NULL THEN 'absent' WHEN b.o_orderstatus = l.o_orderstatus THEN 'same' ELSE 'changed' END AS baseline, strftime(ch.c, '%Y-%m-%d') AS changed_on
FROM last l LEFT JOIN base b USING (o_custkey) LEFT JOIN ch USING (o_custkey)""")
def baseline_asof(spark, sf_dir):
    """Each customer's last order against that at a cutoff, and the newest one in between that differs."""
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_orderkey").alias("at"), "o_orderdate")
    cut, end = F.lit("1998-06-30").cast("timestamp_ntz"), F.lit("2001-08-01").cast("timestamp_ntz")
    base = o.filter(F.col("o_orderdate") <= cut).groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderstatus"), "at").alias("b"))
    last = replay.last_rows(o, "o_custkey", ["at"])
    found = reconcile.material_change(o, "o_custkey", "o_orderdate", cut, end, last, F.col("v.o_orderstatus") != F.col("f.o_orderstatus"))
    state = F.when(F.col("b").isNull(), "absent").when(F.col("b.o_orderstatus") == F.col("o_orderstatus"), "same").otherwise("changed")
    out = last.join(base, "o_custkey", "left").join(found, "o_custkey", "left")
    return out.select("o_custkey", F.col("b.o_orderkey").alias("base_order"), state.alias("baseline"), F.date_format("changed_at", "yyyy-MM-dd").alias("changed_on"))


@query("""WITH d AS (SELECT doc_id, n_chars FROM documents), p AS (SELECT l.doc_id, CASE WHEN l.doc_id % 10 = 0 THEN d.n_chars + 1 ELSE d.n_chars END AS n_chars FROM labels l JOIN documents d USING (doc_id) UNION ALL SELECT doc_id + 10000000, 1 FROM labels WHERE doc_id % 50 = 0)
SELECT * FROM (SELECT coalesce(d.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'undeclared' WHEN d.n_chars <> p.n_chars THEN 'n_chars mismatch' END AS reason FROM d FULL JOIN p ON d.doc_id = p.doc_id) WHERE reason IS NOT NULL""")
def inventory_check(spark, sf_dir):
    """Declared documents against present ones: missing, undeclared, wrong size."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = _t(spark, sf_dir, "labels").select("doc_id")
    p = labels.join(d, "doc_id").select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("n_chars"))
    p = p.union(labels.filter("doc_id % 50 = 0").select(F.col("doc_id") + 10000000, F.lit(1).cast("long")))
    return shards.inventory_check(d, p, "doc_id", ["n_chars"])


@query("""WITH s AS (SELECT source AS source_id, CASE WHEN avg(n_chars) > 2400 THEN 'partial' ELSE 'ok' END AS status FROM documents GROUP BY source)
SELECT bool_and(coalesce(status = 'ok', false)) AS complete, list_sort(list(r.source_id) FILTER (NOT coalesce(status = 'ok', false))) AS incomplete FROM (SELECT unnest(['src0', 'src1', 'src2', 'src3', 'missing']) AS source_id) r LEFT JOIN s USING (source_id)""")
def coverage_gate(spark, sf_dir):
    """Whether all required sources are complete; a source that is missing is not."""
    docs = _t(spark, sf_dir, "documents")
    none = F.array().cast("array<string>")
    state = docs.groupBy(F.col("source").alias("source_id")).agg(F.when(F.avg("n_chars") > 2400, "partial").otherwise("ok").alias("status"), F.max("doc_id").cast("string").alias("completed_watermark"))
    state = state.select("*", F.lit(None).cast("string").alias("continuation"), none.alias("coverage_gaps"), none.alias("errors"))
    required = docs.sparkSession.createDataFrame([(x,) for x in ("src0", "src1", "src2", "src3", "missing")], "source_id string")
    return coverage.coverage(required, state)


@query("""SELECT event_type, count(*) AS n_rows, sum(octet_length(encode(props)))::BIGINT AS bytes, max(user_id) AS max_user FROM events GROUP BY event_type""")
def health_summary(spark, sf_dir):
    """Rows and bytes of each kind of event."""
    e = _t(spark, sf_dir, "events").withColumn("size", F.octet_length("props").cast("long"))
    return coverage.source_health(e, "event_type", "size").join(e.groupBy("event_type").agg(F.max("user_id").alias("max_user")), "event_type")


@query("""SELECT 'negative value' AS reason, count(*) AS n_rows FROM events WHERE value < 5 HAVING count(*) > 0 UNION ALL SELECT 'error event', count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0""")
def health_problems(spark, sf_dir):
    """Reasons that hold for some events."""
    return coverage.problems({"negative value": F.col("value") < 5, "error event": F.col("event_type") == "error", "no user": F.col("user_id").isNull()}, _t(spark, sf_dir, "events"))


@query("""SELECT 'source' AS what, source AS name, count(*)::DOUBLE AS observed, sum(n_chars)::DOUBLE AS size, false AS exceeded FROM documents WHERE source IN ('src0', 'src1', 'src2') GROUP BY source
UNION ALL SELECT 'source', NULL, count(*), sum(n_chars), false FROM documents WHERE source IS NULL OR source NOT IN ('src0', 'src1', 'src2') HAVING count(*) > 0
UNION ALL SELECT 'threshold', 'n_rows', count(*), NULL, count(*) > 5000 FROM documents
UNION ALL SELECT 'threshold', 'bytes', coalesce(sum(n_chars), 0), NULL, coalesce(sum(n_chars), 0) > 1000000 FROM documents""")
def measured_write(spark, sf_dir):
    """Documents written; health of three sources and of the rest, and thresholds, from metrics taken in that one pass."""
    names = ["src0", "src1", "src2"]
    rows, seen = coverage.measured(_t(spark, sf_dir, "documents"), coverage.health_metrics("source", "n_chars", names))
    rows.write.parquet(streams.folder(spark, "measured"))
    health = coverage.measured_health(spark, seen, "source", names)
    out = health.select(F.lit("source").alias("what"), F.col("source").alias("name"), F.col("n_rows").cast("double").alias("observed"), F.col("bytes").cast("double").alias("size"), F.lit(False).alias("exceeded"))
    limits = coverage.measured_thresholds(spark, seen, {"n_rows": 5000, "bytes": 1000000})
    return out.union(limits.select(F.lit("threshold"), "metric", "observed", F.lit(None).cast("double"), "exceeded"))


@query("""WITH m AS (SELECT sum(n_chars)::DOUBLE AS total_chars, count(*)::DOUBLE AS n_docs, max(n_chars)::DOUBLE AS longest FROM documents)
SELECT metric, observed, threshold, observed > threshold AS exceeded FROM (SELECT 'total_chars' AS metric, total_chars AS observed, 1000000.0::DOUBLE AS threshold FROM m UNION ALL SELECT 'n_docs', n_docs, 5000.0 FROM m UNION ALL SELECT 'longest', longest, 100000.0 FROM m)""")
def threshold_observations(spark, sf_dir):
    """Advisory thresholds: measured, never enforced."""
    m = _t(spark, sf_dir, "documents").agg(F.sum("n_chars").alias("total_chars"), F.count(F.lit(1)).alias("n_docs"), F.max("n_chars").alias("longest"))
    return coverage.thresholds(m, {"total_chars": 1000000, "n_docs": 5000, "longest": 100000})


@query("""SELECT grouping_id(l_returnflag, l_linestatus, month)::BIGINT AS "grouping", l_returnflag, l_linestatus, month, count(*) AS n_rows, sum(l_quantity) AS quantity
FROM (SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem) GROUP BY GROUPING SETS ((), (l_returnflag), (l_linestatus), (l_returnflag, month))""")
def cost_rollup(spark, sf_dir):
    """Totals, by flag, by status and by flag and month, in one pass."""
    rows = _t(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_quantity")
    out = costs.roll_up(rows, [[], ["l_returnflag"], ["l_linestatus"], ["l_returnflag", "month"]], [F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")])
    g, s, m = F.col("l_returnflag").isNull(), F.col("l_linestatus").isNull(), F.col("month").isNull()
    return out.withColumn("grouping", (g.cast("long") * 4 + s.cast("long") * 2 + m.cast("long")))


@query("""WITH c AS (SELECT ts::DATE AS day, CASE WHEN event_type = 'signup' THEN 'initialization' ELSE 'steady' END AS phase, event_id % 1000 AS bytes FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'),
  s AS (SELECT (sum(bytes) FILTER (phase <> 'steady'))::BIGINT AS initial_bytes, (sum(bytes) FILTER (phase = 'steady'))::BIGINT AS steady_bytes, count(DISTINCT day) FILTER (phase = 'steady') AS observed_days FROM c)
SELECT *, round(initial_bytes + steady_bytes / observed_days * 31, 3) AS projected_bytes FROM s""")
def month_projection(spark, sf_dir):
    """A month's cost from the days seen so far."""
    e = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.when(F.col("event_type") == "signup", "initialization").otherwise("steady").alias("phase"), (F.col("event_id") % 1000).alias("bytes"))
    return costs.month_projection(e, F.lit("2024-01-01").cast("date")).withColumn("projected_bytes", F.round("projected_bytes", 3))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, sum(greatest(1, ceil(value / 60)))::BIGINT AS minutes, sum(event_id)::BIGINT AS bytes, sum(event_id) > 100000 AS exceeded FROM events GROUP BY 1""")
def billed_minutes(spark, sf_dir):
    """Begun minutes of each day, and its bytes against a limit."""
    e = _t(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", F.col("event_id").alias("reserved_bytes"), F.lit(None).cast("long").alias("charged_bytes"))
    return e.groupBy("day").agg(F.sum(costs.minutes(F.col("value"))).alias("minutes")).join(costs.reserved_by_day(e, 100000), "day")


@query("""WITH k AS (SELECT o_orderkey, o_orderpriority, o_totalprice, max(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS m FROM orders)
SELECT o_orderkey, strftime(m, '%Y-%m-%d') AS replay_day, row_number() OVER (PARTITION BY o_orderpriority, m ORDER BY o_orderkey) AS step FROM k""")
def chain_replay(spark, sf_dir):
    """Priorities as chains of orders: the time at which each order can replay, and its step within it."""
    from pyspark.sql import Window

    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    keyed = costs.chain_order(o, "o_orderpriority", "o_orderkey", "o_orderdate", "o_orderkey")
    step = F.row_number().over(Window.partitionBy("o_orderpriority", "replay_key.o_orderdate").orderBy("o_orderkey"))
    return keyed.select("o_orderkey", F.date_format("replay_key.o_orderdate", "yyyy-MM-dd").alias("replay_day"), step.cast("long").alias("step"))


@query("""WITH s AS (SELECT o_custkey, o_orderkey, floor(o_totalprice)::BIGINT AS cost, sum(floor(o_totalprice)::BIGINT) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::BIGINT AS upto FROM orders)
SELECT o_custkey, o_orderkey, upto, upto > 1000000 AS exceeded FROM s""")
def cumulative_cap(spark, sf_dir):
    """Running costs of each customer against a cap."""
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", F.floor("o_totalprice").alias("cost"))
    return costs.cumulative(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], "cost", 1000000).select("o_custkey", "o_orderkey", "upto", "exceeded")


@query("""WITH new AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01' EXCEPT SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01')
SELECT p_type, count(*) AS n_objects, sum(p_size)::BIGINT AS bytes FROM new JOIN part ON p_partkey = l_partkey GROUP BY p_type""")
def object_diff(spark, sf_dir):
    """Parts of a late snapshot that an early one lacks, by type."""
    l = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_size").cast("long").alias("p_size"))
    late = l.filter(F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    early = l.filter(F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")).select(F.col("l_partkey").alias("p_partkey"))
    return costs.object_diff(late, early, "p_partkey", "p_type", "p_size")


@query("""WITH g AS (SELECT user_id, epoch(ts) - lag(epoch(ts)) OVER w AS gap, row_number() OVER w AS r, value < 1 AS bad FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  b AS (SELECT *, bool_or(bad OR coalesce(gap < 0 OR gap > 86400, false)) OVER (PARTITION BY user_id ORDER BY r) AS broken FROM g),
  o AS (SELECT user_id, coalesce(sum(gap) FILTER (NOT broken), 0) AS s, bool_or(broken) AS invalid, bool_or(r = 1 AND bad) AS rejected, count(*) AS n_samples FROM b GROUP BY user_id)
SELECT user_id, CASE WHEN rejected THEN 'start_rejected' WHEN invalid THEN 'invalid' WHEN s >= 864000 THEN 'review_required' ELSE 'collecting' END AS status,
  round(CASE WHEN invalid THEN 0 ELSE s END)::BIGINT AS qualified_seconds, round(CASE WHEN invalid THEN s ELSE 0 END)::BIGINT AS seconds_before_break, n_samples FROM o""")
def observation_gaps(spark, sf_dir):
    """Observation windows of users: a long gap or a bad sample ends them."""
    e = _t(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    out = coverage.qualification(e, "user_id", "ts", F.col("value") < 1, 86400, 864000)
    return out.withColumns({c: F.round(c).cast("long") for c in ("qualified_seconds", "seconds_before_break")})


@query("""SELECT s_suppkey, s_acctbal FROM (SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0 ORDER BY s_suppkey <= 40, s_suppkey LIMIT 25)""")
def rotating_cursor(spark, sf_dir):
    """The next 25 due suppliers after a cursor, going round."""
    return retention.rotating_cursor(_t(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_suppkey", 40, F.col("s_acctbal") > 0, 25)


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER w AS r, sum(octet_length(encode(props))) OVER w AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)) WHERE r <= 20 AND b <= 150""")
def bounded_retention(spark, sf_dir):
    """The newest events of each user that fit two bounds."""
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.octet_length("props").alias("size"))
    return retention.bounded(e, ["user_id"], [F.desc("ts"), F.desc("event_id")], "size", 20, 150).select("user_id", "event_id")


@query("""WITH c AS (SELECT * FROM (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) WHERE p IS DISTINCT FROM event_type),
  n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nx FROM c)
SELECT user_id, event_id FROM n WHERE nx IS NULL OR nx >= TIMESTAMP '2024-01-28'""")
def history_trim(spark, sf_dir):
    """Changes of each user's event type, without those that were superseded long ago."""
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return retention.history_trim(e, "user_id", "ts", "event_type", F.lit("2024-01-28").cast("timestamp_ntz")).select("user_id", "event_id")


@query("SELECT count(*) AS n_events, sum(event_id)::BIGINT AS id_sum, count(DISTINCT user_id) AS n_users FROM events")
def overlap_ingest(spark, sf_dir):
    """Events read in two-day windows that overlap by a day: identities make them one log again."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01"))
    twice = e.withColumn("window", F.explode(F.array(F.floor(day), F.floor(day) + 1))).drop("window", "ts")
    return changes.append_events(twice.limit(0), twice).agg(F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("id_sum"), F.countDistinct("user_id").alias("n_users"))


@query("""SELECT event_id, '{"k":' || (props::JSON->>'k') || ',"type":"' || event_type || '"}' AS canonical, sha256('{"k":' || (props::JSON->>'k') || ',"type":"' || event_type || '"}' || chr(10)) AS hash FROM events""")
def canonical_json(spark, sf_dir):
    """Canonical JSON and its digest."""
    doc = F.concat(F.lit('{ "type" : "'), F.col("event_type"), F.lit('" , '), F.substring("props", 2, 1000))
    return _t(spark, sf_dir, "events").select("event_id", H.canonical_json(doc).alias("canonical"), H.canonical_digest(doc).alias("hash"))


@query("""SELECT event_id, '{"props":{"k":' || (props::JSON->>'k') || '},"provenance":[{"source_id":"' || event_type || '"}]}' AS semantic FROM events""")
def semantic_strip(spark, sf_dir):
    """A record's facts: volatile fields and nested revisions dropped at any depth."""
    doc = F.concat(F.lit('{"first_seen_at":"x","props":{"k":'), F.get_json_object("props", "$.k"), F.lit(',"source_commit":"y"},"provenance":[{"revision":1,"url":"z","source_id":"'), F.col("event_type"), F.lit('"}]}'))
    return _t(spark, sf_dir, "events").select("event_id", H.semantic_json(doc).alias("semantic"))


@query("""SELECT page_id, sha1(encode('blob ' || octet_length(encode(html)) || chr(0)) || encode(html)) AS blob_sha FROM pages""")
def blob_identity(spark, sf_dir):
    """Git's object id of each page."""
    return _t(spark, sf_dir, "pages").select("page_id", H.git_blob_sha1(F.col("html")).alias("blob_sha"))


@query("""SELECT c_nationkey, CASE WHEN count(DISTINCT seg) + max((seg IS NULL)::INT) = 1 THEN max(seg) END AS single FROM (SELECT c_nationkey, CASE WHEN c_nationkey % 3 = 0 THEN 'ONE' WHEN c_nationkey % 3 = 1 AND c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) GROUP BY c_nationkey""")
def single_value(spark, sf_dir):
    """The only value of a group, null counting as a value."""
    seg = F.when(F.col("c_nationkey") % 3 == 0, "ONE").when((F.col("c_nationkey") % 3 == 1) & (F.col("c_custkey") % 2 == 0), None).otherwise(F.col("c_mktsegment"))
    return _t(spark, sf_dir, "customer").select("c_nationkey", seg.alias("seg")).groupBy("c_nationkey").agg(reconcile.single_value("seg").alias("single"))


@query(SQL["replay_latest"])
def stream_replay(spark, sf_dir):
    """replay_latest from a stream of the log, folded batch by batch."""
    state = streams.replayed(spark, f"{sf_dir}/events.parquet", spark.read.parquet(f"{sf_dir}/events.parquet").schema, "user_id", ORDER, ["user_id", "ts", "event_id", "event_type"])
    return state.filter("event_type <> 'error'").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_users"), F.sum("event_id").alias("id_sum"))


@query("""SELECT event_type, count(*) AS n_changes FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS DISTINCT FROM event_type GROUP BY event_type""")
def stream_changes(spark, sf_dir):
    """Changes of each user's event type, found by a stateful stream operator."""
    found = streams.state_changes(spark, f"{sf_dir}/events.parquet", spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_changes"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_events FROM events GROUP BY ALL""")
def stream_daily(spark, sf_dir):
    """Events of each UTC day, from a stream with a watermark."""
    return streams.daily_counts(spark, f"{sf_dir}/events.parquet", spark.read.parquet(f"{sf_dir}/events.parquet").schema)

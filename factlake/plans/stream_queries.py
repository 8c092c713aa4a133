"""Queries of record streams with retention and of progress by units, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..operators.replay import last_rows
from ..streaming import records, streams
from ..streaming.state import Units

#: Orders before this day are taken in on it, the others on the second day.
CUT, NOW, RETENTION_DAYS, DUE = "1998-06-01", ["1998-06-01T00:00:00Z", "1999-01-01T00:00:00Z"], 100.5, "1998-09-09T12:00:00Z"
MONTHS_FIRST = 40


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records with the facts of their last order in a batch, taken in by two runs of one stream: typed events, and the
    removal of those that were not seen again and share no alias with an urgent one. The last order is found before the feed is
    written, by an aggregation that combines before its shuffle; the stream would parse and hash every order's record."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    late = F.col("o_orderdate").cast("date") >= CUT
    fields = {
        "record_id": F.concat(F.lit("orders/"), F.col("o_custkey").cast("string")), "source_id": F.lit("orders"), "kind": F.lit("advisory"), "status": F.when(F.col("o_orderstatus") == "F", "withdrawn").otherwise("active"),
        "affected": F.array("o_orderpriority"), "kev": F.col("o_orderpriority").startswith("1"), "aliases": F.array(F.floor(F.col("o_custkey") / 2).cast("string")), "published_at": F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'"),
    }
    line = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    where = streams.folder(spark, "records")
    for n, part in enumerate((~late, late)):
        rows = last_rows(orders.filter(part), "o_custkey", ["o_orderkey"]).select(fields["record_id"].alias("record_id"), F.col("o_orderkey").cast("long").alias("seq"), F.lit(NOW[n]).cast("timestamp").alias("at"), line.alias("line"))
        rows.write.mode("append").parquet(f"{where}/in")
        found = records.record_events(spark, f"{where}/in", rows.schema, retention_days=RETENTION_DAYS, policy_version="1", where=f"{where}/run")
    return found.select("record_id", "event_type", "previous_hash", "content_hash", "observed_at")


def unit_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders as units: a run that takes some of them, and one that resumes it with its version and closes it."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM").alias("unit"), "o_orderkey")
    sums = orders.groupBy("unit").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_orderkey").alias("key_sum"))
    units = sums.select("unit", digest(F.concat_ws(" ", "unit", "n_orders", "key_sum")).alias("content_sha256"))
    where = streams.folder(spark, "units")
    work = Units(spark, f"{where}/progress")
    for batch, latest in enumerate(("1", "2")):
        version = work.begin(latest)
        due = work.pending(units).orderBy("unit")
        due = due.limit(MONTHS_FIRST) if batch == 0 else due
        out = sums.join(due.select("unit"), "unit", "left_semi").withColumns({"version": F.lit(version), "batch": F.lit(str(batch))})
        work.once(str(batch), due, lambda out=out, batch=batch: out.write.mode("overwrite").parquet(f"{where}/out/{batch}"))
        work.close(units, "1999-01-01")
    return spark.read.parquet(f"{where}/out/0", f"{where}/out/1").withColumn("watermark", F.lit(work.watermark()))


def _hash(row: str, status: str | None = None) -> str:
    return f"""sha256('{{"affected":["' || {row}.pri || '"],"aliases":["' || {row}.alias || '"],"kev":' || {row}.kev || ',"kind":"advisory","published_at":"' || {row}.pub || '","record_id":"orders/' || {row}.c || '","source_id":"orders","status":"' || {status or f"{row}.st"} || '"}}' || chr(10))"""


QUERIES = {"stream_records": stream_records, "unit_progress": unit_progress}
SQL = {
    "stream_records": f"""WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderdate::DATE >= DATE '{CUT}' AS late, CASE WHEN o_orderstatus = 'F' THEN 'withdrawn' ELSE 'active' END AS st, o_orderpriority AS pri, o_orderpriority LIKE '1%' AS kev,
    (o_custkey // 2)::VARCHAR AS alias, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS pub FROM orders),
  f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY late, c ORDER BY k DESC) AS r FROM o) WHERE r = 1),
  a AS (SELECT *, {_hash("f")} AS h FROM f WHERE NOT late), b AS (SELECT *, {_hash("f")} AS h FROM f WHERE late),
  urgent AS (SELECT alias FROM b WHERE kev UNION SELECT alias FROM a WHERE kev AND c NOT IN (SELECT c FROM b)),
  e AS (SELECT c, CASE WHEN kev THEN 'kev_added' ELSE 'disclosure' END AS t, NULL AS oh, h AS nh, '{NOW[0]}' AS w FROM a
    UNION ALL SELECT c, CASE WHEN kev THEN 'kev_added' ELSE 'disclosure' END, NULL, h, '{NOW[1]}' FROM b WHERE c NOT IN (SELECT c FROM a)
    UNION ALL SELECT c, unnest(list_filter([CASE WHEN ost <> st THEN CASE WHEN st = 'withdrawn' THEN 'withdrawn' ELSE 'disclosure' END END, CASE WHEN okev <> kev THEN CASE WHEN kev THEN 'kev_added' ELSE 'kev_removed' END END,
      CASE WHEN opri <> pri THEN 'affected_corrected' END], lambda x: x IS NOT NULL)), oh, h, '{NOW[1]}' FROM (SELECT b.*, a.st AS ost, a.kev AS okev, a.pri AS opri, a.h AS oh FROM b JOIN a USING (c)) WHERE oh <> h
    UNION ALL SELECT c, 'retention_removed', h, {_hash("a", "'retention_removed'")}, '{DUE}' FROM a WHERE NOT kev AND c NOT IN (SELECT c FROM b) AND alias NOT IN (SELECT alias FROM urgent)
    UNION ALL SELECT b.c, 'retention_removed', b.h, {_hash("b", "'retention_removed'")}, strftime(b.pub::TIMESTAMP + INTERVAL {int(RETENTION_DAYS * 24)} HOUR, '%Y-%m-%dT%H:%M:%SZ') FROM b JOIN a ON a.c = b.c
      WHERE NOT b.kev AND a.st = b.st AND a.pri = b.pri AND a.h <> b.h AND b.pub::TIMESTAMP + INTERVAL {int(RETENTION_DAYS * 24)} HOUR < TIMESTAMP '{NOW[1][:10]}' AND b.alias NOT IN (SELECT alias FROM urgent))
SELECT 'orders/' || c AS record_id, t AS event_type, oh AS previous_hash, nh AS content_hash, w AS observed_at FROM e""",
    "unit_progress": f"""SELECT unit, n_orders, key_sum, '1' AS version, CASE WHEN row_number() OVER (ORDER BY unit) <= {MONTHS_FIRST} THEN '0' ELSE '1' END AS batch, '1999-01-01' AS watermark
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS unit, count(*) AS n_orders, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1)""",
}

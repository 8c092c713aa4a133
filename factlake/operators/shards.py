"""Shards of a snapshot: hash prefixes as deep as size demands, their descriptors, digests and inventory checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Groups that a plan sends to all tasks, at most.
MOST_SENT = 200_000


def shard_plan(rows: DataFrame, part: list[str], key: str, size: str, limit: int, deepest: int = 10, first: int = 2) -> DataFrame:
    """``rows`` with prefix: the shortest hex prefix of the key's digest, from ``first`` digits on, at which its group in the
    part fits the limit or is one row.

    Groups of the first three depths are sums of those at the third, which are counted in one pass with map-side combining; only
    rows of groups that don't fit there are counted at more digits, up to ``deepest``. How many these are goes to the driver, and
    says what is small enough for all tasks. Rows are read three times: who makes them at some cost keeps them first."""
    hashed = rows.withColumn("_h", F.sha2(F.col(key).cast("string"), 256))
    middle = min(first + 2, deepest)
    counted = hashed.groupBy(*part, F.substring("_h", 1, middle).alias("_m")).agg(F.sum(size).alias("_b"), F.count(F.lit(1)).alias("_n"))
    fit = lambda depth: F.coalesce((F.col("_b") <= limit) | (F.col("_n") == 1) | (depth == deepest), F.lit(False))
    large = counted.filter(~fit(F.lit(middle)))
    found = counted.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.when(~fit(F.lit(middle)), F.col("_n"))), F.lit(0)).alias("rest")).first()
    if not found.groups:
        return rows.withColumn("prefix", F.lit(None).cast("string")).filter(F.lit(False))
    sent = F.broadcast if found.groups + found.rest <= MOST_SENT else lambda x: x
    groups = _at_depths(counted, part, "_m", "_b", "_n", first, middle)
    if found.rest:
        named = large.select(*part, "_m")
        own = hashed.withColumn("_m", F.substring("_h", 1, middle))
        own = own.join(sent(named), _same(own, named, [*part, "_m"]), "left_semi").select(*part, "_h", F.col(size).alias("_b"), F.lit(1).alias("_n"))
        groups = groups.unionByName(_at_depths(own, part, "_h", "_b", "_n", middle + 1, deepest))
    fits = groups.filter(fit(F.length("_p")))
    # a group that fits is a shard unless the group one digit up fits too
    up = fits.select(*part, F.col("_p").alias("_up"))
    below = fits.withColumn("_up", F.substring("_p", F.lit(1), F.length("_p") - 1))
    shards = below.join(up, _same(below, up, [*part, "_up"]), "left_anti").select(*part, F.col("_p").alias("prefix"))
    # a row is looked up by equality, at the few depths that the shards of its first digits have
    depths_of = shards.groupBy(*part, F.substring("prefix", 1, first).alias("_c")).agg(F.collect_set(F.length("prefix")).alias("_depths"))
    keyed = hashed.withColumn("_c", F.substring("_h", 1, first))
    tried = keyed.join(sent(depths_of), _same(keyed, depths_of, [*part, "_c"])).select(*[keyed[c] for c in hashed.columns], F.explode("_depths").alias("_d"))
    tried = tried.withColumn("prefix", F.substring(F.col("_h"), F.lit(1), F.col("_d")))
    return tried.join(sent(shards), _same(tried, shards, [*part, "prefix"])).select(*[tried[c] for c in rows.columns], tried["prefix"])


def _at_depths(rows: DataFrame, part: list[str], digits: str, size: str, n: str, first: int, last: int) -> DataFrame:
    """Bytes (_b) and rows (_n) of the groups (_p) at some depths."""
    depths = F.sequence(F.lit(first), F.lit(last))
    each = rows.select(*part, F.col(size).alias("_s"), F.col(n).alias("_k"), F.explode(F.transform(depths, lambda d: F.substring(F.col(digits), 1, d))).alias("_p"))
    return each.groupBy(*part, "_p").agg(F.sum("_s").alias("_b"), F.sum("_k").alias("_n"))


def _same(a: DataFrame, b: DataFrame, columns: list[str]):
    out = None
    for c in columns:
        one = a[c].eqNullSafe(b[c])
        out = one if out is None else out & one
    return out


def descriptors(rows: DataFrame, shard: list[str], key: str, line: str) -> DataFrame:
    """Count, bytes and SHA-256 of each shard's lines in key order. A shard's size is bounded by its plan, so gathering its
    lines is safe."""
    lines = F.array_sort(F.collect_list(F.struct(key, line)))
    text = F.concat(F.array_join(F.transform(lines, lambda x: x[line]), "\n"), F.lit("\n"))
    return rows.groupBy(*shard).agg(F.count(F.lit(1)).alias("count"), F.sum(F.octet_length(line) + 1).alias("bytes"), F.sha2(text, 256).alias("sha256"))


#: Pairs that a bucket of a digest holds on average, at most.
BUCKET_ROWS = 4096


def snapshot_digest(rows: DataFrame, key: str, content: str, digits: int | None = None) -> DataFrame:
    """One digest of all (key, content) pairs, the same for any partitioning: each bucket of key hashes is digested in order,
    then the digests of buckets that share all but their last two digits, and so on. The number of ``digits`` grows with the
    rows, by two, so that no bucket does."""
    if digits is None:
        digits, n = 2, rows.count()
        while n > BUCKET_ROWS * 16**digits:
            digits += 2
    pair = F.concat_ws(":", F.col(key).cast("string"), F.col(content))
    hashed = rows.select(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, digits).alias("bucket"), pair.alias("pair"))
    each = hashed.groupBy("bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("pair")), ","), 256).alias("d"), F.count(F.lit(1)).alias("n"))
    digest = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "d"))), lambda x: x["d"]), ","), 256)
    for left in range(digits - 2, 0, -2):
        each = each.groupBy(F.substring("bucket", 1, left).alias("_b")).agg(digest.alias("d"), F.sum("n").alias("n")).withColumnRenamed("_b", "bucket")
    return each.agg(digest.alias("digest"), F.sum("n").alias("n_rows"))


def inventory_check(declared: DataFrame, present: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """Key and reason of each disagreement: duplicate, missing, undeclared, or the first compared column that differs."""
    d = declared.groupBy(key).agg(F.count(F.lit(1)).alias("dn"), *[F.min(c).alias(f"d_{c}") for c in compared])
    p = present.groupBy(key).agg(F.count(F.lit(1)).alias("pn"), *[F.min(c).alias(f"p_{c}") for c in compared])
    reason = F.when(F.col("dn") > 1, "duplicate").when(F.col("pn").isNull(), "missing").when(F.col("dn").isNull(), "undeclared").when(F.col("pn") > 1, "duplicate file")
    for c in compared:
        reason = reason.when(~F.col(f"d_{c}").eqNullSafe(F.col(f"p_{c}")), f"{c} mismatch")
    return d.join(p, key, "full_outer").select(key, reason.alias("reason")).filter("reason is not null")


def changed_bytes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bytes of shards that are new or differ."""
    o = old.select("path", F.col("sha256").alias("was"))
    return new.join(o, "path", "left").filter(~F.col("was").eqNullSafe(F.col("sha256"))).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("changed_bytes"))

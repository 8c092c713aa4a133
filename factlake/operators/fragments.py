"""Oversized rows in parts, and back."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INLINE_BYTES, PART_BYTES, MOST_PARTS = 16384, 8192, 256


@F.pandas_udf(T.BinaryType())
def deflated(data: pd.Series) -> pd.Series:
    """zlib at level 6; Spark has no function for it."""
    return data.map(lambda x: None if x is None else zlib.compress(bytes(x), 6))


@F.pandas_udf(T.BinaryType())
def inflated(data: pd.Series) -> pd.Series:
    return data.map(lambda x: None if x is None else zlib.decompress(bytes(x)))


def chunks(body: Column, size: int) -> Column:
    """Array of (index, payload) of a binary value; an empty one has a part of its own."""
    n = F.greatest(F.ceil(F.octet_length(body) / size).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("part_index"), F.substring(body, i * size + 1, F.lit(size)).alias("payload")))


def fragment(rows: DataFrame, key: str, line: str, inline: int = INLINE_BYTES, part: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """(parents, parts) of rows: a line of more than ``inline`` bytes becomes null in its parent, which keeps its size, digest
    and number of parts."""
    body = F.col(line).cast("binary")
    big = F.octet_length(body) > inline
    n = F.ceil(F.octet_length(body) / part).cast("int")
    parents = rows.select(key, F.when(~big, F.col(line)).alias(line), F.when(big, n).alias("total_parts"), F.when(big, F.octet_length(body)).alias("bytes"), F.when(big, F.sha2(body, 256)).alias("sha256"))
    each = rows.filter(big).select(F.col(key).alias("parent"), n.alias("total_parts"), F.inline(chunks(body, part)))
    return parents, each.withColumn("chunk_sha256", F.sha2("payload", 256))


def problems(parents: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Key and reason of parts and parents that don't fit together: orphan, duplicate, missing, damaged part, too many parts."""
    seen = parts.groupBy("parent").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("part_index").alias("distinct_n"), F.min("part_index").alias("low"), F.max("part_index").alias("high"), F.bool_or(F.sha2("payload", 256) != F.col("chunk_sha256")).alias("damaged")
    )
    big = parents.filter("total_parts is not null").select(F.col(key).alias("parent"), "total_parts")
    both = big.join(seen, "parent", "full_outer")
    reason = (
        F.when(F.col("total_parts").isNull(), "orphan")
        .when(F.col("total_parts") > MOST_PARTS, "too many parts")
        .when(F.col("n").isNull(), "missing")
        .when(F.col("damaged"), "damaged part")
        .when(F.col("n") > F.col("distinct_n"), "duplicate")
        .when((F.col("n") < F.col("total_parts")) | (F.col("low") != 0) | (F.col("high") != F.col("total_parts") - 1), "missing")
    )
    return both.select(F.col("parent").alias(key), reason.alias("reason")).filter("reason is not null")


def reassemble(parents: DataFrame, parts: DataFrame, key: str, line: str) -> DataFrame:
    """Rows with their lines. Any disagreement of parts, sizes or digests fails the read: nothing is left out in silence.
    The parts of one row are bounded (``MOST_PARTS``), so gathering them is safe."""
    joined = F.aggregate(F.transform(F.array_sort(F.collect_list(F.struct("part_index", "payload"))), lambda x: x["payload"]), F.lit(b""), lambda a, x: F.concat(a, x))
    ok = F.bool_and(F.sha2("payload", 256) == F.col("chunk_sha256"))
    whole = parts.groupBy("parent").agg(joined.alias("body"), F.count(F.lit(1)).alias("n"), ok.alias("ok"))
    both = parents.join(whole, parents[key] == whole["parent"], "full_outer")
    good = F.col(key).isNotNull() & F.when(F.col("total_parts").isNull(), F.col("parent").isNull()).otherwise(F.col("ok") & (F.col("n") == F.col("total_parts")) & (F.octet_length("body") == F.col("bytes")) & (F.sha2("body", 256) == F.col("sha256")))
    checked = F.when(F.coalesce(good, F.lit(False)), F.coalesce(F.col(line), F.col("body").cast("string"))).otherwise(F.raise_error(F.concat(F.lit("damaged fragments of "), F.coalesce(F.col(key).cast("string"), F.col("parent").cast("string")))))
    return both.select(F.coalesce(key, "parent").alias(key), checked.alias(line))


def normalise_assertions(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(affected items, assertions) as child tables of records (record_id, affected array, assertions array of structs with
    affected_indices): an item's provider and role are stored once, with its assertion."""
    items = records.select("record_id", F.posexplode("affected").alias("affected_index", "item"))
    owners = records.select("record_id", F.posexplode("assertions").alias("assertion_index", "assertion"))
    owned = owners.select("record_id", "assertion_index", F.explode("assertion.affected_indices").alias("affected_index"))
    return items.join(owned, ["record_id", "affected_index"], "left"), owners


def ownership_problems(items: DataFrame) -> DataFrame:
    """Items that no assertion, or more than one, claims."""
    claims = items.groupBy("record_id", "affected_index").agg(F.count("assertion_index").alias("claims"))
    return claims.filter("claims <> 1")

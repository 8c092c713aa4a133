"""Sharding by minimax contiguous partition.

Rows with equal texts form atomic groups, in the order of a digest of the text. The groups are cut into at most ``shards``
contiguous parts so that the largest part is as small as it can be: a binary search finds the least capacity for which
greedy filling needs no more than ``shards`` parts, and the groups are cut where that filling cuts them.

Only sums travel. Rows are range-partitioned by (digest, doc_id), so a group of any size spreads over partitions; each
partition keeps running sums, and the driver adds up one row a partition. For the search the driver holds the group ends of
at most ``CELLS`` cells of the running total: the first and the last of each. They bound what greedy filling can reach from
below and above, hence the capacity; the few cells that matter are then looked at again in finer cells, until the bounds
meet. The number of passes is about log(total) / log(CELLS / shards): three for gigabytes, six for 100 TB.

Defined results: a null text is empty; its size is 1; null doc_ids come first in their group; repeated rows get slots of
their own; with fewer groups than shards, or a group larger than an even share, some shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

SHARDS = 16
#: Cells of the running total that the driver looks at in one pass.
CELLS = 1 << 15


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number, its running size and rows, and whether a group ends (null for its last row)."""
    part, size, rows, held = TaskContext.get().partitionId(), 0, 0, None
    names = ["doc_id", "g", "size", "text_crc32", "part", "upto_size", "upto_rows", "ends"]
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column("size").to_numpy(zero_copy_only=False)
        upto = np.cumsum(own) + size
        place = np.arange(1, len(own) + 1) + rows
        size, rows = int(upto[-1]), int(place[-1])
        g = batch.column("g")
        ends = pa.concat_arrays([pc.not_equal(g.slice(1), g.slice(0, len(g) - 1)), pa.nulls(1, pa.bool_())])
        if held is not None:  # now its last row's successor is known
            first = held.column("g")[held.num_rows - 1] != g[0]
            fixed = pa.concat_arrays([held.column("ends").slice(0, held.num_rows - 1), pa.array([first])])
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], fixed], names=names)
        held = pa.RecordBatch.from_arrays([*batch.select(names[:4]).columns, pa.array(np.full(len(own), part, np.int32)), pa.array(upto), pa.array(place), ends], names=names)
    if held is not None:
        yield held


class Ends:
    """What the driver knows of the group ends: some of them, in order, and the gaps that may hold more."""

    def __init__(self, total: int):
        self.total, self.points, self.open = total, [0, total], {0}

    def replace(self, a: int, b: int, cells: list[tuple[int, int, int]]) -> None:
        """Within [a, b] the ends are those of ``cells`` (first, last, number), in order."""
        i, j = bisect_right(self.points, a - 1), bisect_right(self.points, b)
        inner, gaps = [], set()
        for first, last, n in cells:
            inner.append(first)
            if last > first:
                if n > 2:
                    gaps.add(len(inner) - 1)
                inner.append(last)
        kept = {k for k in self.open if k < i - 1} | {k - j + i + len(inner) for k in self.open if k >= j}
        self.points[i:j] = inner
        self.open = kept | {i + k for k in gaps}

    def cut(self, t: int) -> tuple[int, int]:
        """Bounds of the last end at or before t."""
        if t >= self.total:
            return self.total, self.total
        k = bisect_right(self.points, t) - 1
        return self.points[k], t if k in self.open else self.points[k]

    def fill(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of where greedy filling ends after each shard."""
        low = high = 0
        out = []
        for _ in range(shards):
            low, high = self.cut(low + capacity)[0], self.cut(high + capacity)[1]
            out.append((low, high))
        return out

    def least(self, shards: int) -> tuple[int, int]:
        """Bounds of the least capacity that suffices."""

        def search(which: int) -> int:
            a, b = -(-self.total // shards), self.total
            while a < b:
                m = (a + b) // 2
                if self.fill(m, shards)[-1][which] >= self.total:
                    b = m
                else:
                    a = m + 1
            return a

        return search(1), search(0)

    def wanted(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """Ranges, apart from one another, that hold every open gap in which filling may cut at a capacity from low to high."""
        ranges = []
        starts = [(0, 0), *[(a[0], b[1]) for a, b in zip(self.fill(low, shards), self.fill(high, shards), strict=True)]]
        for a, b in starts[:-1]:
            i, j = bisect_right(self.points, a + low) - 1, bisect_right(self.points, min(b + high, self.total - 1)) - 1
            gaps = [k for k in self.open if i <= k <= j]
            if gaps:
                ranges.append((self.points[min(gaps)] + (min(gaps) == 0), self.points[max(gaps) + 1]))
        merged: list[list[int]] = []
        for a, b in sorted(ranges):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        return [(a, b) for a, b in merged]


def minimax_cuts(ends: DataFrame, total: int, shards: int = SHARDS, cells: int = CELLS) -> list[int]:
    """Where greedy filling at the least sufficient capacity cuts; ``ends`` (p long) has the running total at each group's end."""
    known = Ends(total)
    while True:
        low, high = known.least(shards)
        path = known.fill(high, shards)
        if low == high and all(a == b for a, b in path):
            return [a for a, _ in path]
        ranges = known.wanted(low, high, shards)
        case = None
        for k, (a, b) in enumerate(ranges):
            width = max(1, -(-(b - a + 1) // (cells // len(ranges))))
            within = F.col("p").between(a, b)
            cell = F.lit(k * cells) + F.floor((F.col("p") - a) / width)
            case = F.when(within, cell) if case is None else case.when(within, cell)
        found = ends.select("p", case.alias("cell")).filter("cell is not null").groupBy("cell").agg(F.min("p").alias("a"), F.max("p").alias("b"), F.count("p").alias("n"))
        seen = sorted((r.cell, r.a, r.b, r.n) for r in found.collect())  # at most ``cells`` rows
        for k, (a, b) in enumerate(ranges):
            known.replace(a, b, [x[1:] for x in seen if x[0] // cells == k])


def shard(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard, slot
    (from 0, gapless in the shard)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("g"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    ordered = rows.repartitionByRange("g", "doc_id").sortWithinPartitions("g", "doc_id")
    schema = "doc_id long, g binary, size long, text_crc32 long, part int, upto_size long, upto_rows long, ends boolean"
    table = written(ordered.mapInArrow(_running, schema), "ordered")
    parts = table.groupBy("part").agg(F.max("upto_size").alias("size"), F.max("upto_rows").alias("rows"), F.min("g").alias("first"), F.max("g").alias("last")).orderBy("part").collect()
    if not parts:
        return table.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    before, total, n = [], 0, 0
    for p, after in zip(parts, [*parts[1:], None], strict=True):  # one row a partition
        before.append((p.part, total, n, after is None or bytes(after["first"]) != bytes(p["last"])))
        total, n = total + p["size"], n + p["rows"]
    offsets = df.sparkSession.createDataFrame(before, "part int, size_before long, rows_before long, last_ends boolean")
    placed = table.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32", (F.col("upto_size") + F.col("size_before")).alias("p"), (F.col("upto_rows") + F.col("rows_before")).alias("r"), F.coalesce("ends", "last_ends").alias("ends")
    )
    cuts = minimax_cuts(placed.filter("ends").select("p"), total, shards)
    at = {r.p: r.r for r in placed.filter(F.col("p").isin(cuts)).select("p", "r").collect()}  # at most a row for each shard
    starts = [0, *[at[c] for c in cuts[:-1]]]
    number = sum((F.when(F.col("p") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0))
    first = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard") + 1)
    return placed.select("*", number.cast("int").alias("shard")).select("doc_id", "size", "text_crc32", "shard", (F.col("r") - 1 - first).alias("slot"))

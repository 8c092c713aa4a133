"""Approximate nearest neighbours by collision counting.

Vectors are projected on ``PROJECTIONS`` random directions, and each projection is kept as a sorted array of pages. A query's window in
each array is centred on its own projection; a vector collides where it lies in the window. Windows widen by virtual
rehashing (the same arrays, a wider window) until enough vectors have collided in more than a
threshold of the arrays; those are verified by their exact inner product.

The largest inner product becomes the least distance by one more coordinate, which lifts all vectors to the norm of the largest
and is zero for queries.

Queries are a stated set; they meet all rows in blocks: every block of vectors with every block of queries, both of bounded
size, by a cogrouped join. Each pair of blocks gives at most k rows a query, of which a window keeps the best k.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; vectors of different
lengths are never compared; ties go to the smaller vec_id; a query's own vec_id is no candidate, repeated rows of others are
candidates each, but rows that repeat a query's vec_id ask once, by the shortest vector that sorts first; null vec_ids take no part; with fewer candidates than k all are returned.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

K, PROJECTIONS, SEED = 20, 96, 7
#: Half the first window, in norms of the largest vector, and its growth from round to round.
FIRST, GROWTH = 0.7, 1.12
#: A vector is verified if it collides in more than this share of the arrays; a round suffices if it gives a block so many
#: vectors, or this share of the block if that is more. Without clusters the 20 nearest of some thousand vectors are hardly
#: nearer than the rest, so a good recall needs shares like these; with clusters the first round gives more than enough.
COLLISIONS, ENOUGH, SHARE = 0.46, 1536, 0.25
#: Pages of a sorted array: windows reach over whole pages, so that a collision is a comparison of two bytes.
PAGES = 256
BLOCK, QUERY_BLOCK = 8192, 2048


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


class Arrays:
    """The sorted projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, largest: float, projections: int):
        d = vectors.shape[1]
        self.directions = np.random.default_rng(SEED).standard_normal((projections, d + 1))
        lift = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(1), 0))
        spots = np.column_stack([vectors, lift]) @ self.directions.T
        order = np.argsort(spots, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(spots, order, axis=0).T)
        self.n, self.largest = len(vectors), largest
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(self.n)[:, None], axis=0)
        self.page = np.ascontiguousarray((rank * PAGES // self.n).T.astype(np.uint8))  # of each vector, in each array

    def candidates(self, queries: np.ndarray, threshold: int, enough: int):
        """For each query the vectors that collide often enough, in the first round in which there are enough."""
        scale = self.largest / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)  # a query's length doesn't matter
        spots = np.ascontiguousarray(((queries * scale) @ self.directions[:, :-1].T).T)
        rounds: list[tuple[np.ndarray, np.ndarray]] = []

        def windows(r: int) -> tuple[np.ndarray, np.ndarray]:
            """The first page of all queries' windows in all arrays, and how many more they reach over, in round r."""
            while len(rounds) <= r:
                half = FIRST * GROWTH ** len(rounds) * self.largest
                ends = [np.array([np.searchsorted(s, x + d, side=side) for s, x in zip(self.sorted, spots, strict=True)]).T for d, side in ((-half, "left"), (half, "right"))]
                first = np.minimum(ends[0] * PAGES // self.n, PAGES - 1)
                last = np.maximum(ends[1] - 1, ends[0]) * PAGES // self.n
                rounds.append((first.astype(np.uint8), (np.minimum(last, PAGES - 1) - first).astype(np.uint8)))
            return rounds[r]

        for i in range(len(queries)):
            r = 0
            while True:
                first, reach = (x[i][:, None] for x in windows(r))
                # unsigned: pages before the window wrap around to large numbers
                found = np.flatnonzero(np.add.reduce((self.page - first) <= reach, axis=0, dtype=np.uint8 if len(self.page) < 256 else np.uint16) > threshold)
                if len(found) >= enough or (reach == PAGES - 1).all():
                    yield found
                    break
                r += 1


def _search(k: int, projections: int):
    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        names, types = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]
        out: list[list[np.ndarray]] = [[], [], []]
        if queries.num_rows and vectors.num_rows:
            x, q = _matrix(vectors.column("embedding")), _matrix(queries.column("query"))
            ids, own = vectors.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
            largest = float(vectors.column("largest")[0].as_py())
            # of length 1 at most, so that a rough score is within half of ``slack`` of the true one
            short, asked = (x / largest).astype(np.float32), (q / np.linalg.norm(q, axis=1, keepdims=True)).astype(np.float32)
            slack = np.float32((x.shape[1] + 8) * 2.0**-22)
            arrays = Arrays(x, largest, projections)
            enough = min(len(x), max(ENOUGH, int(SHARE * len(x))))
            for i, found in enumerate(arrays.candidates(q, int(COLLISIONS * projections), enough)):
                found = found[ids[found] != own[i]]
                if len(found) > k:  # single precision keeps all that may be among the best, however many are equal
                    rough = short[found] @ asked[i]
                    found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
                score = (x[found] * q[i]).sum(1)
                best = np.lexsort((ids[found], -score))[:k]
                for c, v in zip(out, (np.full(len(best), own[i]), ids[found][best], score[best]), strict=True):
                    c.append(v)
        return pa.table([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types, strict=True)], names=names)

    return run


def nearest(df: DataFrame, is_query: Callable[[Column], Column], k: int = K, projections: int = PROJECTIONS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (inner product) of each query's k nearest found; ``df`` has vec_id and embedding,
    ``is_query`` says of a vec_id whether it is a query."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vectors = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = vectors.filter("vec_id is not null").filter(F.forall("embedding", sound) & F.exists("embedding", lambda x: x != 0))
    vectors = vectors.withColumn("d", F.size("embedding"))
    sizes = vectors.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query(F.col("vec_id"))).alias("q"), F.sqrt(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))).alias("largest"))
    sizes = sizes.select("d", "largest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("q") / QUERY_BLOCK).cast("int").alias("query_blocks")).filter("query_blocks > 0")
    both = vectors.join(sizes, "d")  # a row for each length of vectors
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    dealt = both.select("d", "largest", "vec_id", "embedding", spread("blocks").alias("b"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("q"))
    once = both.filter(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min(F.struct("d", "embedding", "blocks", "query_blocks")).alias("r")).select("vec_id", "r.*")
    asked = once.select(
        F.col("d").alias("of_d"), F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), spread("query_blocks").alias("of_q"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("of_b")
    )
    found = asked.groupBy("of_d", "of_b", "of_q").cogroup(dealt.groupBy("d", "b", "q")).applyInArrow(_search(k, projections), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

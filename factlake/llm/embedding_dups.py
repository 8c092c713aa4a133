"""Near copies among embeddings: all pairs of vectors with a cosine of ``COSINE`` or more, by cover trees and dual traversal.

Unit vectors have a cosine of at least c where they are at most r = sqrt(2 - 2c) apart, so bounds are those of a metric.

1. Equal vectors are one with a number, however many there are.
2. Vectors are dealt out by the nearest of ``CENTRES`` centres at most, taken by farthest-first traversal from a bounded sample
   (which only says who meets whom first; every vector is indexed). What a centre has beyond ``BLOCK`` vectors is dealt out by hash.
3. A task builds a cover tree of its vectors: the lowest nodes, cells, have a radius of r / 4 at most, and each of the nested
   levels above doubles it. Vectors of one cell are all linked, so a dense group is a few cells before anything else is shuffled.
4. Blocks of cells meet in pairs whose balls are near enough. A task goes down both blocks' trees at once, and leaves node pairs
   whose centres are farther apart than r and both covering radii. Two cells so near that all their vectors are linked are counted
   as a whole; cells of one vector are compared. A task gives degrees of cells and a spanning forest of its links, not pairs.
5. Pairs of cells that bounds leave open are compared vector by vector, in pieces of ``PIECE``.

Links are exact. Where vectors have no clusters, no metric bound prunes, and the blocks' work is quadratic in the number of
vectors (a matrix product for each two blocks of ``BLOCK``).

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
lengths are never compared; each row is a vector, also one that repeats a vec_id; a null vec_id is linked like any other but names
no component, and is not kept; equal vectors are told by 128 bits of hash; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .components import components
from .shared import in_small_batches, written

COSINE = 0.9
#: Vectors of a tree and cells of a block; centres; numbers in the sample from which they are taken.
BLOCK, CENTRES, SAMPLE_NUMBERS = 8192, 1024, 1 << 21
LEVELS, PIECE = 4, 64
#: Distances are sure to this; pairs within a band of cosines around the threshold are computed anew from the vectors given.
SURE, BAND = 1e-7, 1e-12
TREE = "cell long, d int, top int, salt int, far double, vec binary, n long, low long, up array<long>, reach array<double>, members array<long>, weights array<long>, vecs binary"


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def _blobs(x: np.ndarray) -> pa.Array:
    width = x.shape[1] * 8 if x.ndim > 1 else 0
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """Places of k unit vectors, each the farthest from those before."""
    out, near = [0], x @ x[0]
    while len(out) < min(k, len(x)):
        out.append(int(near.argmin()))
        near = np.maximum(near, x @ x[out[-1]])
    return np.array(out)


def _dealt(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == d))
                x = part.column("embedding").flatten().to_numpy().reshape(-1, d)
                top, far = np.zeros(len(x), np.int32), np.zeros(len(x))
                if d in centres:
                    near = _units(x) @ centres[d].T
                    top, far = near.argmax(1).astype(np.int32), _distance(near.max(1)) + SURE
                yield pa.RecordBatch.from_arrays([part.column("v"), part.column("m"), part.column("low"), pa.array(np.full(len(x), d, np.int32)), pa.array(top), pa.array(far), _blobs(x)], names=["v", "m", "low", "d", "top", "far", "vec"])

    return run


def leaders(x: np.ndarray, radius: float) -> np.ndarray:
    """For each unit vector the place of its leader, within ``radius``; leaders are farther than that from each other."""
    owner, lead, least = np.full(len(x), -1), np.zeros(0, np.int64), 1 - radius * radius / 2
    for a in range(0, len(x), 512):
        part = x[a : a + 512]
        free = np.ones(len(part), bool)
        if len(lead):
            near = part @ x[lead].T
            best = near.argmax(1)
            free = near[np.arange(len(part)), best] < least
            owner[a : a + len(part)][~free] = lead[best[~free]]
        here = np.flatnonzero(free)
        close = part[here] @ part[here].T >= least
        left, new = np.ones(len(here), bool), []
        for i in range(len(here)):
            if left[i]:
                mine = close[i] & left
                mine[i] = True
                left &= ~mine
                owner[a + here[mine]] = a + here[i]
                new.append(a + here[i])
        lead = np.concatenate([lead, np.array(new, np.int64)])
    return owner


def _built(radius: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        d, top, salt = (k.as_py() for k in key)
        v, m, far = (table.column(c).to_numpy() for c in ("v", "m", "far"))
        x = _matrix(table.column("vec"), d)
        unit = _units(x)
        short = unit.astype(np.float32)
        nodes, owner = np.arange(len(x)), None
        ups, reaches = [], []
        for level in range(LEVELS):
            lead = nodes[leaders(short[nodes], radius * 2.0 ** (level - 2))]
            if owner is None:
                owner = of = lead
            else:
                step = np.full(len(x), -1)
                step[nodes] = lead
                of = step[of]
            apart = _distance((unit * unit[of]).sum(1)) + SURE
            apart[of == np.arange(len(x))] = 0
            reach = np.zeros(len(x))
            np.maximum.at(reach, of, apart)
            ups.append(of)
            reaches.append(reach)
            nodes = np.unique(lead)
        cells, place = np.unique(owner, return_inverse=True)
        n, most = np.zeros(len(cells), np.int64), np.zeros(len(cells))
        np.add.at(n, place, m)
        np.maximum.at(most, place, far)
        low_of: dict[int, int] = {}
        for p, value in zip(place.tolist(), table.column("low").to_pylist(), strict=True):
            if value is not None and value < low_of.get(p, 1 << 63):
                low_of[p] = value
        order = np.argsort(place, kind="stable")
        cut = np.searchsorted(place[order], np.arange(len(cells) + 1))
        names = ["cell", "d", "top", "salt", "far", "vec", "n", "low", "up", "reach", "members", "weights", "vecs"]
        each = np.array([v[u[cells]] for u in ups[1:]], np.int64).T if LEVELS > 1 else np.zeros((len(cells), 0), np.int64)
        of_cell = pa.table(
            [
                pa.array(v[cells]),
                pa.array(np.full(len(cells), d, np.int32)),
                pa.array(np.full(len(cells), top, np.int32)),
                pa.array(np.full(len(cells), salt, np.int32)),
                pa.array(most),
                _blobs(x[cells]),
                pa.array(n),
                pa.array([low_of.get(i) for i in range(len(cells))], pa.int64()),
                pa.array(each.tolist(), pa.list_(pa.int64())),
                pa.array(np.array([r[cells] for r in reaches]).T.tolist(), pa.list_(pa.float64())),
                pa.nulls(len(cells), pa.list_(pa.int64())),
                pa.nulls(len(cells), pa.list_(pa.int64())),
                pa.nulls(len(cells), pa.binary()),
            ],
            names=names,
        )
        pieces = [(c, order[a : min(a + PIECE, cut[c + 1])]) for c in range(len(cells)) for a in range(cut[c], cut[c + 1], PIECE)]
        k = len(pieces)
        columns = {
            "cell": pa.array(v[cells[[c for c, _ in pieces]]] if k else [], pa.int64()),
            "d": pa.array(np.full(k, d, np.int32)),
            "members": pa.array([v[p].tolist() for _, p in pieces], pa.list_(pa.int64())),
            "weights": pa.array([m[p].tolist() for _, p in pieces], pa.list_(pa.int64())),
            "vecs": pa.array([x[p].tobytes() for _, p in pieces], pa.binary()),
        }
        of_piece = pa.table([columns.get(c, pa.nulls(k, of_cell.schema.field(c).type)) for c in names], names=names)
        return pa.concat_tables([of_cell, of_piece])

    return run


class _Side:
    """A block's cells and the nodes above them, by level: places of centres, covering radii, and each node's children."""

    def __init__(self, table: pa.Table, d: int, prefix: str):
        table = table.rename_columns([c.removeprefix(prefix) for c in table.column_names])
        self.cell = table.column("cell").to_numpy()
        order = np.argsort(self.cell)
        place = lambda ids: order[np.searchsorted(self.cell[order], ids)]
        self.n, self.x = table.column("n").to_numpy(), _matrix(table.column("vec"), d)
        self.unit = _units(self.x)
        self.short = self.unit.astype(np.float32)
        up = table.column("up").combine_chunks().flatten().to_numpy().reshape(len(self.cell), -1)
        self.reach = table.column("reach").combine_chunks().flatten().to_numpy().reshape(len(self.cell), -1).T
        self.levels, self.below = [np.arange(len(self.cell))], [None]
        for level in range(up.shape[1]):
            parent = place(up[self.levels[-1], level])
            by = np.argsort(parent, kind="stable")
            nodes, first = np.unique(parent[by], return_index=True)
            kids = dict(zip(nodes.tolist(), np.split(self.levels[-1][by], first[1:]), strict=True))
            self.levels.append(nodes)
            self.below.append(kids)


class Traversal:
    """Two blocks' links: ``degrees`` of either's cells, ``linked`` pairs (a forest over places; the second block's come after the
    first's) and ``open`` pairs. A block may be met with itself."""

    def __init__(self, a: _Side, b: _Side, cosine: float):
        self.a, self.b, self.cosine, self.radius, self.same = a, b, cosine, sqrt(2 - 2 * cosine), a is b
        self.slack = 4 * a.x.shape[1] * 2.0**-24 + 1e-6
        self.shift = 0 if self.same else len(a.cell)
        self.label = np.arange(self.shift + len(b.cell))
        self.degrees = np.zeros(len(a.cell), np.int64), np.zeros(len(b.cell), np.int64)
        self.open: list[tuple[np.ndarray, np.ndarray]] = []
        self._meet(len(a.levels) - 1, a.levels[-1], b.levels[-1])

    def _meet(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        if level == 0:
            self._cells(i, j)
            return
        for one, of_one in ((True, i[self.a.reach[level][i] == 0]), (False, i[self.a.reach[level][i] > 0])):
            for other, of_other in ((True, j[self.b.reach[level][j] == 0]), (False, j[self.b.reach[level][j] > 0])):
                if one and other:
                    self._cells(of_one, of_other)
                elif len(of_one) and len(of_other):
                    self._nodes(level, of_one, of_other)

    def _tiles(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        right = self.b.short[j].T
        step = max(1, (1 << 22) // max(len(j), 1))
        for k in range(0, len(i), step):
            yield i[k : k + step], self.a.short[i[k : k + step]] @ right

    def _nodes(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        rb = self.b.reach[level][j]
        for rows, s in self._tiles(i, j):
            reach = self.radius + self.a.reach[level][rows][:, None] + rb[None, :]
            near = s >= 1 - reach * reach / 2 - self.slack
            for k in np.flatnonzero(near.any(1)).tolist():
                mine = self.a.below[level][int(rows[k])]
                theirs = np.concatenate([self.b.below[level][int(x)] for x in j[near[k]]])
                self._meet(level - 1, mine, theirs)

    def _cells(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i) or not len(j):
            return
        widest = self.radius + self.a.reach[0][i].max() + self.b.reach[0][j].max()
        least = np.float32(1 - widest * widest / 2 - self.slack)
        for rows, s in self._tiles(i, j):
            p, q = np.nonzero(s >= least)
            p, q = rows[p], j[q]
            if self.same:
                p, q = p[p < q], q[p < q]
            for k in range(0, len(p), 1 << 16):
                self._pairs(p[k : k + (1 << 16)], q[k : k + (1 << 16)])

    def _pairs(self, p: np.ndarray, q: np.ndarray) -> None:
        ra, rb = self.a.reach[0][p], self.b.reach[0][q]
        cosine = (self.a.unit[p] * self.b.unit[q]).sum(1)
        lone, apart = (ra == 0) & (rb == 0), _distance(cosine)
        linked = np.where(lone, cosine >= self.cosine, apart + ra + rb <= self.radius - SURE)
        for k in np.flatnonzero(lone & (np.abs(cosine - self.cosine) < BAND)).tolist():
            linked[k] = exact_cosine(self.a.x[p[k]], self.b.x[q[k]]) >= self.cosine
        undecided = ~lone & ~linked & (apart - ra - rb <= self.radius + SURE)
        if undecided.any():
            self.open.append((p[undecided], q[undecided]))
        p, q = p[linked], q[linked]
        np.add.at(self.degrees[0], p, self.b.n[q])
        np.add.at(self.degrees[1], q, self.a.n[p])
        q = q + self.shift
        while len(p):
            x, y = self.label[p], self.label[q]
            if (apart := x != y).any():
                p, q, x, y = p[apart], q[apart], x[apart], y[apart]
                np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
                while (self.label != self.label[self.label]).any():
                    self.label = self.label[self.label]
            else:
                break


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    x, y = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (x, y))  # powers of two, so that nothing overflows
    return float(np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)))


def _traversed(cosine: float):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        d = key[0].as_py()
        kinds: list[list[np.ndarray]] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            a = _Side(left, d, "a_")
            b = a if key[1] == key[3] and key[2] == key[4] else _Side(right, d, "b_")
            t = Traversal(a, b, cosine)
            ids = a.cell if t.same else np.concatenate([a.cell, b.cell])
            some = np.flatnonzero(t.label != np.arange(len(t.label)))
            found = [(1, ids[some], ids[t.label[some]], np.zeros(len(some), np.int64))]
            for side, degree in zip((a, b), t.degrees, strict=True):
                has = np.flatnonzero(degree)
                found.append((0, side.cell[has], side.cell[has], degree[has]))
            found += [(2, a.cell[p], b.cell[q], np.zeros(len(p), np.int64)) for p, q in t.open]
            for kind, x, y, n in found:
                for c, values in zip(kinds, (np.full(len(x), kind, np.int32), x, y, n), strict=True):
                    c.append(values)
        return pa.table([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(kinds, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["kind", "a", "b", "n"])

    return run


def _opened(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between the vectors of two pieces: (v, n) for each, and (a, b) of the cells if there is one."""
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                x, y = (np.frombuffer(r[c], np.float64).reshape(-1, r["d"]) for c in ("vecs_a", "vecs_b"))
                cosines = _units(x) @ _units(y).T
                linked = cosines >= cosine
                for i, j in zip(*np.nonzero(np.abs(cosines - cosine) < BAND), strict=True):
                    linked[i, j] = exact_cosine(x[i], y[j]) >= cosine
                if linked.any():
                    out.append((1, r["a"], r["b"], 0))
                    for side, other, counts in (("a", "b", linked), ("b", "a", linked.T)):
                        n = counts @ np.array(r[f"weights_{other}"], np.int64)
                        out += [(0, v, v, k) for v, k in zip(r[f"members_{side}"], n.tolist(), strict=True) if k]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["kind", "a", "b", "n"])

    return run


def _centres(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Centres of each length that has more vectors than a block (a row for each ``BLOCK`` vectors at most)."""
    out = {}
    for r in vectors.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK).collect():
        size = max(2, min(16 * CENTRES, SAMPLE_NUMBERS // r.d))
        sample = vectors.filter(F.size("embedding") == r.d).select("embedding", F.xxhash64("k1", "k2").alias("h")).orderBy("h").limit(size).select("embedding").toArrow()
        x = _units(sample.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, r.d))
        out[r.d] = x[farthest_first(x, min(CENTRES, -(-r.n // BLOCK)))]
    return out


def _block_pairs(cells: DataFrame, centres: dict[int, np.ndarray], radius: float) -> DataFrame:
    """d, top_a, block_a, top_b, block_b of blocks whose balls are near enough, each pair in one order."""
    blocks = written(cells.groupBy("d", "top", "block").agg(F.max("far").alias("far")), "blocks")
    of = lambda x: blocks.select("d", *[F.col(c).alias(f"{c}_{x}") for c in ("top", "block", "far")])
    same = of("a").join(of("b").withColumn("top_a", F.col("top_b")), ["d", "top_a"]).filter("block_a <= block_b")
    columns = ["d", "top_a", "block_a", "top_b", "block_b"]
    pairs = same.select(*columns)
    for d, c in centres.items():  # CENTRES * CENTRES / 2 rows at most
        i, j = np.triu_indices(len(c), 1)
        apart = _distance((c @ c.T)[i, j])
        tops = cells.sparkSession.createDataFrame(pa.table([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(apart)], names=["top_a", "top_b", "apart"]))
        met = tops.withColumn("d", F.lit(d)).join(of("a"), ["d", "top_a"]).join(of("b"), ["d", "top_b"])
        pairs = pairs.union(met.filter(F.col("apart") <= F.col("far_a") + F.col("far_b") + radius + SURE).select(*columns))
    return written(pairs, "block-pairs")


def near_duplicates(df: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``df`` (vec_id, embedding)."""
    radius = sqrt(2 - 2 * cosine)
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = in_small_batches(df).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = F.coalesce(F.forall("embedding", sound) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    keyed = rows.withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit(1), "embedding")})
    vectors = keyed.filter(good).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("low"), F.any_value("embedding").alias("embedding"))
    vectors = written(vectors.withColumn("v", F.monotonically_increasing_id()), "vectors")
    centres = _centres(vectors)
    dealt = written(vectors.mapInArrow(_dealt(centres), "v long, m long, low long, d int, top int, far double, vec binary"), "dealt")
    sizes = dealt.groupBy("d", "top").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts"))
    salted = dealt.join(sizes, ["d", "top"]).withColumn("salt", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int")).drop("salts")
    tree = written(salted.groupBy("d", "top", "salt").applyInArrow(_built(radius), TREE), "cover-trees")

    cells, pieces = tree.filter("members is null"), tree.filter("members is not null").select("cell", "d", "members", "weights", "vecs")
    chunks = cells.groupBy("d", "top", "salt").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("d", "top").orderBy("salt"))  # a row for each task's tree
    chunks = chunks.select("d", "top", "salt", F.floor((running - 1) / BLOCK).cast("int").alias("block"))
    blocked = cells.join(chunks, ["d", "top", "salt"])
    pairs = _block_pairs(blocked, centres, radius)
    by = ["d", "top_a", "block_a", "top_b", "block_b"]

    def side(x: str):
        own = blocked.select("d", F.col("top").alias(f"top_{x}"), F.col("block").alias(f"block_{x}"), "cell", "vec", "n", "up", "reach")
        both = pairs.join(own, ["d", f"top_{x}", f"block_{x}"])
        return both.select(*[F.col(c).alias(f"{x}_{c}") for c in both.columns]).groupBy(*[f"{x}_{c}" for c in by])

    met = written(side("a").cogroup(side("b")).applyInArrow(_traversed(cosine), "kind int, a long, b long, n long"), "traversed")
    part = lambda x: pieces.select(F.col("cell").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("members", "weights", "vecs")], *(["d"] if x == "a" else []))
    both = met.filter("kind = 2").select("a", "b").join(part("a"), "a").join(part("b"), "b")
    opened = written(both.mapInArrow(_opened(cosine), "kind int, a long, b long, n long"), "opened")

    group = components(met.filter("kind = 1").select("a", "b").union(opened.filter("kind = 1").select("a", "b")))
    degree = met.filter("kind = 0").groupBy(F.col("a").alias("cell")).agg(F.sum("n").alias("degree"))
    more = opened.filter("kind = 0").groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("more"))
    named = cells.select("cell", "n", "low").join(group.withColumnRenamed("node", "cell"), "cell", "left").join(degree, "cell", "left").withColumn("component", F.coalesce("component", "cell"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_cell = named.join(lows, "component").select("cell", "component_id", (F.col("n") + F.coalesce("degree", F.lit(0)) - 1).alias("links"))
    of_vector = pieces.select("cell", F.explode("members").alias("v")).join(of_cell, "cell").join(more, "v", "left")
    of_vector = of_vector.select("v", "component_id", (F.col("links") + F.coalesce("more", F.lit(0))).alias("n_links")).join(vectors.select("v", "k1", "k2"), "v")
    linked = keyed.filter(good).select("vec_id", "k1", "k2").join(of_vector, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


SQL = f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
  s AS (SELECT r, e, len(e) AS d FROM v WHERE len(list_filter(e, lambda x: x <> 0)) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  l AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.d = b.d AND a.r <> b.r AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
  t AS (SELECT r, r AS o FROM v UNION SELECT t.r, l.b FROM t JOIN l ON l.a = t.o),
  c AS (SELECT t.r, min(v.vec_id) AS c FROM t JOIN v ON v.r = t.o GROUP BY t.r),
  n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.c AS component_id, coalesce(v.vec_id = c.c, false) AS kept FROM v JOIN c ON c.r = v.r LEFT JOIN n ON n.r = v.r"""

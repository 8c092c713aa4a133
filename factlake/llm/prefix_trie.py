"""The prefix trie of conversations, by double arrays in shards of prefixes.

Conversations are first rebuilt: each takes over the first turns of the leader of its block of ids, so that prefixes are shared.

1. Turns get their places and become cells of ``CELL`` bytes (128 bits of SHA-256 of role and text, and the text's words); a
   conversation is the string of its cells. Conversations with equal strings are one from here, with their number, least id and
   the digest of all their ids, so a group of copies is one row however large it is.
2. Distinct strings are sorted over the cluster; a task's range of them, a shard, holds a range of prefixes. In a shard turns get
   dense ids, and the trie is packed level by level into two arrays: a node at s has its child by turn t at BASE[s] + t, where
   CHECK is s. All conversations walk these arrays at once, and leave their counts at the nodes that they pass.
3. Nodes that lie within a shard are done. Only nodes on the path of a shard's first or last string can lie in several: these
   upper nodes are merged by key. What they add to the nodes above is summed along one path for each, the first that has it.

A shard has about ``SHARD_CELLS`` cells. A conversation's cells are one row, as a text is.

Defined results: turns come by number, null first, ties by role and text; null role or text count as empty; rows with null
conv_id take no part; without rows there are no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .expressions import words
from .shared import in_small_batches, written

#: A conversation shares the turns of the leader of its block of so many ids: CRC-32 of its id modulo HEADS of them.
SHARED, HEADS = 20, 4
CELL, KEY = 20, 16
SHARD_CELLS = 1 << 20
#: Free places that are tried for a node's children before they go behind the last used one.
TRIES = 64
NODE = "key binary, parent_key binary, shard int, side int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string"
NONE = hashlib.sha256(b"").hexdigest()


def _cell(role: Column, text: Column) -> Column:
    """A turn's cell in hex."""
    turn = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.left(F.sha2(turn.cast("binary"), 256), F.lit(2 * KEY)), F.lpad(F.hex(F.size(words(text))), 2 * (CELL - KEY), "0"))


def rebuilt(df: DataFrame) -> DataFrame:
    """conv_id, cells (array of hex) of the rebuilt conversations of ``df`` (conv_id, turn, role, text)."""
    turns = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    turns = turns.filter("conv_id is not null").select("*", _cell(F.col("role"), F.col("text")).alias("cell"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    own = turns.select("conv_id", "cell", place.alias("place")).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "cell"))).alias("turns"))
    own = written(own.select("conv_id", F.transform("turns", lambda t: t["cell"]).alias("cells")), "conversations")
    heads = own.filter(F.col("conv_id") % SHARED == 0).select(F.col("conv_id").alias("leader"), F.slice("cells", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumns({"leader": F.col("conv_id") - F.col("conv_id") % SHARED, "h": h}).join(heads, "leader", "left")
    rest = F.slice("cells", F.col("h") + 1, F.size("cells"))
    return both.select("conv_id", F.concat(F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h")), rest).alias("cells"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each sequence, joined by commas as far as a task and a batch have them together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        k, ids = batch.column("k"), batch.column("conv_id").to_numpy()
        code = k.dictionary_encode().indices.to_numpy()
        at = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
        ends = np.append(at[1:], len(code))
        text = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(at, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([k.take(pa.array(at)), pa.array(ids[at]), pa.array(ends - at), pa.array(text, pa.binary())], names=["k", "first", "n", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chunks in order: number, least id and digest of each sequence's ids; holds one chunk's ids at a time."""
    now, out = None, []
    for batch in batches:
        for k, first, n, ids in zip(*(batch.column(c).to_pylist() for c in ("k", "first", "n", "ids")), strict=True):
            if now and now[0] == k:
                now[2] += n
                now[3].update(b",")
            else:
                out += [now] if now else []
                now = [k, first, n, hashlib.sha256()]
            now[3].update(ids)
        if len(out) > 10000:
            yield _digested(out)
            out = []
    yield _digested(out + ([now] if now else []))


def _digested(rows: list) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3].hexdigest() for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["k", "conv_id", "n", "ends"])


def sequences(conversations: DataFrame) -> DataFrame:
    """The distinct cell strings of ``conversations``: seq, conv_id (the least), n, ends (digest of all ids)."""
    keyed = conversations.select("conv_id", F.unhex(F.array_join("cells", "")).alias("seq")).withColumn("k", F.unhex(F.sha2("seq", 256)))
    keyed = written(keyed, "rebuilt")
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = keyed.select("k", "conv_id").repartitionByRange(n, "k", "conv_id").sortWithinPartitions("k", "conv_id").mapInArrow(_chunks, "k binary, first long, n long, ids binary")
    counted = chunks.repartition("k").sortWithinPartitions("k", "first").mapInArrow(_digests, "k binary, conv_id long, n long, ends string")
    return keyed.groupBy("k").agg(F.any_value("seq").alias("seq")).join(counted, "k").select("seq", "conv_id", "n", "ends")


class DoubleArray:
    """BASE and CHECK of a trie over sequences of dense ids: ``ids`` of sequence i from cut[i] to cut[i + 1]."""

    def __init__(self, ids: np.ndarray, cut: np.ndarray):
        self.base, self.check = np.zeros(1024, np.int64), np.full(1024, -1, np.int64)
        self.check[0] = 0  # the root is its own parent
        self.top, self.free = 1, 1  # behind the last used place; no free place before
        size, depth, self.levels = np.diff(cut), 0, [np.zeros(1, np.int64)]
        wide = int(ids.max()) + 1 if len(ids) else 1
        at, alive = np.zeros(len(size), np.int64), np.arange(len(size))
        while True:
            alive = alive[size[alive] > depth]
            if not len(alive):
                break
            here, turn = at[alive], ids[cut[alive] + depth]
            parent, child = np.divmod(np.unique(here * wide + turn), wide)
            owner, first = np.unique(parent, return_index=True)
            for s, a, b in zip(owner.tolist(), first.tolist(), [*first[1:].tolist(), len(parent)], strict=True):
                self._place(s, child[a:b])
            self.levels.append(self.base[parent] + child)
            at[alive] = self.base[here] + turn
            depth += 1
        self.end = at  # where each sequence ends

    def _place(self, s: int, turns: np.ndarray) -> None:
        first, span = int(turns[0]), int(turns[-1] - turns[0]) + 1
        self._room(self.top + span + 1)
        while self.check[self.free] >= 0:
            self.free += 1
        spot = self.free
        if span > 1:
            start = np.flatnonzero(self.check[self.free : self.top] < 0)[:TRIES] + self.free if self.top - self.free < 1 << 12 else np.zeros(0, np.int64)
            ok = (self.check[np.minimum(start[:, None] + (turns - first), len(self.check) - 1)] < 0).all(1) & (start + span < len(self.check))
            spot = int(start[ok][0]) if ok.any() else max(self.top, self.free)
        self.base[s] = spot - first
        self.check[spot + (turns - first)] = s
        self.top = max(self.top, spot + span)

    def _room(self, size: int) -> None:
        if size >= len(self.check):
            more = max(size + 1, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.append(self.base, np.zeros(more, np.int64)), np.append(self.check, np.full(more, -1, np.int64))

    def walk(self, ids: np.ndarray, cut: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """All sequences from the root down: depth, the sequences that reach it, and the nodes that they are at."""
        size, depth, alive = np.diff(cut), 0, np.arange(len(cut) - 1)
        at = np.zeros(len(alive), np.int64)
        while len(alive):
            yield depth, alive, at
            on = size[alive] > depth
            alive, at = alive[on], at[on]
            below = self.base[at] + ids[cut[alive] + depth]
            assert (self.check[below] == at).all()
            at, depth = below, depth + 1


def dense(cells: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Ids from 0 of cells (rows of ``KEY`` bytes), in the order in which a walk by levels meets them: siblings are near each other."""
    if not len(cells):
        return np.zeros(0, np.int64)
    size = np.diff(cut)
    depth = np.arange(len(cells)) - np.repeat(cut[:-1], size)
    by_level = np.argsort(depth, kind="stable")
    _, first, ids = np.unique(cells[by_level].view(f"V{KEY}").ravel(), return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    out = np.empty(len(cells), np.int64)
    out[by_level] = rank[ids.ravel()]
    return out


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's range of sequences, which come sorted."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    raw, offsets = W.flat(table.column("seq").combine_chunks())
    cells, cut = raw.reshape(-1, CELL), offsets // CELL
    ids, last = dense(np.ascontiguousarray(cells[:, :KEY]), cut), len(cut) - 2
    tokens = np.ascontiguousarray(cells[:, KEY:]).view(">u4").ravel().astype(np.int64)
    trie = DoubleArray(ids, cut)
    size = len(trie.check)
    count, conv = table.column("n").to_numpy(), table.column("conv_id").to_numpy()
    zeros = lambda: np.zeros(size, np.int64)
    n, least, words_, level = zeros(), np.full(size, np.iinfo(np.int64).max), zeros(), zeros()
    paths: tuple[list[int], list[int]] = ([], [])  # the nodes of the first and of the last sequence
    for depth, who, at in trie.walk(ids, cut):
        np.add.at(n, at, count[who])
        np.minimum.at(least, at, conv[who])
        level[at] = depth
        if depth:
            words_[at] = tokens[cut[who] + depth - 1]
        if who[0] == 0:
            paths[0].append(int(at[0]))
        if who[-1] == last:
            paths[1].append(int(at[-1]))
    upper = np.zeros(size, bool)
    upper[paths[0]] = upper[paths[1]] = True
    # whole for nodes that are done; an upper node gets what is done below it in this shard
    children, leaves, saved = zeros(), zeros(), zeros()
    for nodes in trie.levels[:0:-1]:
        done, parents = nodes[~upper[nodes]], trie.check[nodes]
        leaves[done[children[done] == 0]] = 1
        saved[done] += (n[done] - 1) * words_[done]
        np.add.at(children, trie.check[done], 1)
        np.add.at(leaves, parents, leaves[nodes])
        np.add.at(saved, parents, saved[nodes])
    ended = np.full(size, -1, np.int64)
    ended[trie.end] = np.arange(len(cut) - 1)

    keys: dict[int, bytes] = {}
    for path, i in zip(paths, (0, last), strict=True):
        h, prefix = hashlib.sha256(), raw[offsets[i] : offsets[i + 1]].tobytes()
        for depth, s in enumerate(path):
            h.update(prefix[max(depth - 1, 0) * CELL : depth * CELL])
            keys[s] = h.digest()
    inner = np.concatenate(trie.levels)
    inner = inner[~upper[inner]]
    shard, digests = TaskContext.get().partitionId(), table.column("ends").to_pylist()

    def rows(at: np.ndarray, side: int, counted: np.ndarray) -> pa.RecordBatch:
        up = trie.check[at]
        under = upper[up] & (at > 0)
        part = lambda x: pa.array(np.where(counted, x[at], 0))
        columns = {
            "key": pa.array([keys.get(s) for s in at.tolist()], pa.binary()),
            "parent_key": pa.array([keys[s] if u else None for s, u in zip(up.tolist(), under.tolist(), strict=True)], pa.binary()),
            "shard": pa.array(np.full(len(at), shard, np.int32)),
            "side": pa.array(np.full(len(at), side, np.int32)),
            "depth": pa.array(level[at]),
            "conv_id": pa.array(least[at]),
            "parent_conv_id": pa.array(least[up], mask=under | (at == 0)),
            "n_convs": part(n),
            "n_children": part(children),
            "n_leaves": part(leaves),
            "saved_tokens": part(saved),
            "words": pa.array(words_[at]),
            "ends": pa.array([digests[e] if e >= 0 else None for e in ended[at].tolist()], pa.string()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    both = np.array(paths[0], np.int64), np.array(paths[1], np.int64)
    for side, (at, counted) in enumerate(((both[0], np.ones(len(both[0]), bool)), (both[1], ~np.isin(both[1], both[0])), (inner, np.ones(len(inner), bool)))):
        for a in range(0, len(at), 10000):
            yield rows(at[a : a + 10000], side, counted[a : a + 10000])


def _merged(upper: DataFrame) -> DataFrame:
    """The upper nodes, each once, from their parts in the shards."""
    first = F.min(F.struct("shard", "side"))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = upper.groupBy("key").agg(*sums, F.min("conv_id").alias("conv_id"), first.alias("first"), *[F.any_value(c).alias(c) for c in ("parent_key", "depth", "words")], F.max("ends").alias("ends"), F.lit(None).cast("long").alias("parent_conv_id"))
    below = nodes.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    nodes = nodes.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    nodes = written(nodes, "upper-nodes")
    mine = F.col("first") == F.struct("shard", "side")
    own = {"leaf": F.when(mine & (F.col("children") == 0), 1).otherwise(0), "save": F.when(mine, F.greatest(F.col("convs") - 1, F.lit(0)) * F.col("words")).otherwise(0)}
    paths = upper.select("shard", "side", "depth", "key").join(nodes.select("key", "first", "words", F.col("n_children").alias("children"), F.col("n_convs").alias("convs")), "key")
    down = Window.partitionBy("shard", "side").orderBy(F.desc("depth"))
    added = paths.select("key", *[F.sum(x).over(down).alias(c) for c, x in own.items()]).groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    return nodes.join(added, "key").withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("save")}).drop("leaf", "save", "first", "words")


def prefix_trie(df: DataFrame) -> DataFrame:
    """One row for each node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends (the
    digest of the ids that end there)."""
    spark = df.sparkSession
    seqs = written(sequences(rebuilt(in_small_batches(df))), "sequences")
    cells = seqs.agg(F.sum(F.octet_length("seq"))).first()[0]
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(cells or 0) // (CELL * SHARD_CELLS)))
    nodes = written(seqs.repartitionByRange(shards, "seq").sortWithinPartitions("seq").mapInArrow(_shard, NODE), "nodes")
    upper = _merged(nodes.filter("key is not null"))
    names = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    done = nodes.filter("key is null and parent_key is null").select(*columns)
    under = nodes.filter("key is null and parent_key is not null").select("parent_key", *columns).unionByName(upper.select("parent_key", *columns))
    under = under.join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("above"))
    return done.unionByName(under.select(*columns)).withColumn("ends", F.coalesce("ends", F.lit(NONE)))


_CRC = "list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)"
SQL = f"""WITH t AS (SELECT conv_id AS c, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
  o AS (SELECT c, list(t ORDER BY turn NULLS FIRST, t.role, t.text) AS ts FROM t GROUP BY c),
  h AS (SELECT c, ts, (xor({_CRC}, 4294967295) % {HEADS})::INT AS h FROM o),
  r AS (SELECT h.c, list_concat(coalesce(l.ts, [])[1:h.h], h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN o l ON l.c = h.c - h.c % {SHARED}),
  p AS (SELECT c, d, ts[1:d] AS p, len(ts) = d AS e FROM (SELECT c, ts, unnest(generate_series(0, len(ts))) AS d FROM r)),
  n AS (SELECT p, d, min(c) AS c, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (e), '') AS ends FROM p GROUP BY p, d),
  k AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM n WHERE d > 0 GROUP BY 1),
  s AS (SELECT n.*, coalesce(k.k, 0) AS k, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * len(list_filter(regexp_extract_all(n.p[n.d].text, '[^\\x20\\x09-\\x0D]+'), lambda x: x <> '')) END AS w FROM n LEFT JOIN k ON k.p = n.p),
  a AS (SELECT p[1:u] AS p, sum(w) AS w, count(*) FILTER (k = 0) AS l FROM (SELECT p, w, k, unnest(generate_series(0, d)) AS u FROM s) GROUP BY 1)
SELECT s.c AS conv_id, s.d AS depth, m.c AS parent_conv_id, s.n AS n_convs, s.k AS n_children, a.l AS n_leaves, a.w::BIGINT AS saved_tokens, sha256(s.ends) AS ends_sha256
FROM s JOIN a ON a.p = s.p LEFT JOIN n m ON m.p = s.p[1:s.d - 1] AND s.d > 0"""

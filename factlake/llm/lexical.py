"""Ranked lexical search by presence masks: each item's best documents, in whole numbers and exactly.

Which of an item's terms a document has is its presence mask. No document can score more than its mask's bound, the sum of the
terms' largest contributions anywhere; there are far fewer masks than documents.

1. Items are read in parts of at most ``MOST_TERMS`` terms (one part as a rule), whose terms are sent to the tasks. Documents
   become rows of their length and of the part's terms in them, found by 128 bits of hash; the rows are written as a table.
2. Counts over all documents (how many, terms in all, documents of each term), then each term's largest contribution, are
   aggregations of that table.
3. A task takes the table in blocks. In a block a term's places are set in the masks of all documents at once, documents are
   grouped by mask, and groups are scored by descending bound until the ``k``-th best score is above the next bound.
4. A block's best meet those of some other blocks, then those of all, by item.

Defined results: null and empty texts, and those without terms, are not counted and match nothing; each row is a document, also
one that repeats a doc_id; null doc_ids come last among equals; rows of one item_id are one item, with the terms of all;
null item_ids are left out; items without terms or matches have no rows; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .shared import in_small_batches, written

K = 50
#: Terms are maximal runs of letters and digits of ASCII and of all characters beyond it; only A to Z are lower-cased.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms of items that the driver holds and sends to tasks at once.
MOST_TERMS = 1 << 20
#: Documents, and terms in them, that a task scores at once; partial results meet in so many groups first.
BLOCK, BLOCK_TERMS, GROUPS = 1 << 16, 1 << 22, 64
_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


class Vocabulary:
    """Terms by two hashes; ids are places in the order of the first one."""

    def __init__(self, strings: list[str]):
        joined = "".join(strings).encode()
        ends = np.cumsum([len(s.encode()) for s in strings]).astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        buf = np.frombuffer(joined, np.uint8)
        first = W.hashes(buf, starts, ends)
        self.order = np.argsort(first)
        self.first, self.second = first[self.order], W.hashes(buf, starts, ends, 1)[self.order]

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The id of each word of ``buf``, or -1."""
        h = W.hashes(buf, starts, ends)
        at = np.minimum(np.searchsorted(self.first, h), len(self.first) - 1)
        out = np.where(self.first[at] == h, at, -1)
        hit = np.flatnonzero(out >= 0)
        out[hit[self.second[at[hit]] != W.hashes(buf, starts[hit], ends[hit], 1)]] = -1
        return out


def _counted(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = W.flat(batch.column("text"))
            for a, b in W.slices(offsets):
                part, cut = _LOWER[buf[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
                starts, ends, row = W.split(part, cut, _APART)
                n = np.bincount(row, minlength=b - a)
                ids = vocabulary.find(part, starts, ends)
                pair, tf = np.unique((row * len(vocabulary.first) + ids)[ids >= 0], return_counts=True)
                row, ids = np.divmod(pair, len(vocabulary.first))
                lists = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(lists), pa.array(x, t)) for x, t in ((ids.astype(np.int32), pa.int32()), (tf.astype(np.int64), pa.int64()))]
                out = pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(n.astype(np.int64)), *columns], names=["doc_id", "n", "ids", "tfs"])
                yield out.filter(pa.array(n > 0))

    return run


def _length_part(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """A document's m, whatever the size of the numbers on the way."""
    if len(n) and 50 * int(n.max()) * docs >= 1 << 63:
        return np.array([50 + 50 * int(x) * docs // length for x in n], np.int64)
    return 50 + 50 * n * docs // length


class Scorer:
    """``items``: arrays of term ids, of the item_ids in ``names``; ``weight`` and ``most``, the largest contribution, by term."""

    def __init__(self, names: np.ndarray, items: list[np.ndarray], weight: np.ndarray, most: np.ndarray, docs: int, length: int, k: int):
        self.names, self.items, self.weight, self.most, self.docs, self.length, self.k = names, items, weight, most, docs, length, k

    def best(self, doc: np.ndarray, named: np.ndarray, n: np.ndarray, lists: np.ndarray, ids: np.ndarray, tfs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each item its id, the rows of its best documents in a block and their scores. ``named``: the doc_id isn't null."""
        owner = np.repeat(np.arange(len(doc)), np.diff(lists))
        order = np.argsort(ids, kind="stable")
        ids, owner, tfs = ids[order], owner[order], tfs[order]
        gain = self.weight[ids] * (1_000_000_000 * tfs // (1000 * tfs + 20 * _length_part(n, self.docs, self.length)[owner]))
        cut = np.searchsorted(ids, np.arange(len(self.weight) + 1))
        for i, mine in zip(self.names.tolist(), self.items, strict=True):
            mine = mine[(cut[mine + 1] > cut[mine]) & (self.most[mine] > 0)]
            if len(mine):
                rows, scores = self._of(mine, owner, gain, cut, doc, named)
                if len(rows):
                    yield i, rows, scores

    def _of(self, mine: np.ndarray, owner: np.ndarray, gain: np.ndarray, cut: np.ndarray, doc: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = [(owner[cut[t] : cut[t + 1]], gain[cut[t] : cut[t + 1]]) for t in mine]
        masks = np.zeros(((len(mine) + 63) // 64, len(doc)), np.uint64)
        for j, (at, _) in enumerate(places):
            masks[j // 64, at] |= np.uint64(1 << (j % 64))
        group, of = masks[0], None
        if len(masks) > 1:
            group, of = np.unique(masks, axis=1, return_inverse=True)
            of = of.ravel()
        else:
            group, of = np.unique(group, return_inverse=True)
            group = group[None, :]
        bits = np.unpackbits(np.ascontiguousarray(group.T).view(np.uint8).reshape(group.shape[1], -1), axis=1, bitorder="little")[:, : len(mine)]
        bound = bits.astype(np.int64) @ self.most[mine]
        by_bound = np.argsort(-bound, kind="stable")
        rank = np.empty_like(by_bound)
        rank[by_bound] = np.arange(len(by_bound))
        rows = np.argsort(rank[of], kind="stable")  # documents, those of the highest bound first
        upper = bound[of[rows]]
        found, scores, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 4 * self.k
        while at < len(rows) and upper[at] > 0 and (len(scores) < self.k or upper[at] >= scores[-1]):
            end = int(np.searchsorted(-upper, -upper[min(at + step, len(rows)) - 1], side="right"))  # whole groups
            new = np.sort(rows[at:end])
            score = np.zeros(len(new), np.int64)
            for own, gains in places:
                if len(new) < len(own):
                    x = np.minimum(np.searchsorted(own, new), len(own) - 1)
                    score += np.where(own[x] == new, gains[x], 0)
                else:
                    x = np.minimum(np.searchsorted(new, own), len(new) - 1)
                    hit = new[x] == own
                    score[x[hit]] += gains[hit]
            found, scores = np.concatenate([found, new[score > 0]]), np.concatenate([scores, score[score > 0]])
            order = np.lexsort((doc[found], ~named[found], -scores))[: self.k]
            found, scores, at, step = found[order], scores[order], end, 2 * step
        return found, scores


def _scored(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(kept).combine_chunks()
            kept.clear()
            doc, ids = t.column("doc_id"), t.column("ids").combine_chunks()
            named = doc.is_valid().to_numpy(zero_copy_only=False)
            doc = doc.fill_null(0).to_numpy()
            lists = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            found = list(scorer.best(doc, named, t.column("n").to_numpy(), lists, ids.flatten().to_numpy(), t.column("tfs").combine_chunks().flatten().to_numpy()))
            for i, rows, scores in found:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), i, np.int64)), pa.array(doc[rows], mask=~named[rows]), pa.array(scores)], names=["item_id", "doc_id", "score"])

        docs = held = 0
        for batch in batches:
            kept.append(batch)
            docs, held = docs + batch.num_rows, held + len(batch.column("ids").flatten())
            if docs >= BLOCK or held >= BLOCK_TERMS:
                yield from flush()
                docs = held = 0
        if docs:
            yield from flush()

    return run


def _part(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Results of a part's items; ``items`` has item_id and term, distinct."""
    spark = docs.sparkSession
    held = items.toArrow()
    strings = held.column("term").unique().to_pylist() if held.num_rows else []
    if not strings:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    vocabulary = Vocabulary(strings)
    place = np.empty(len(strings), np.int64)
    place[vocabulary.order] = np.arange(len(strings))
    encoded = held.column("term").combine_chunks().dictionary_encode()
    number = {s: i for i, s in enumerate(strings)}
    remap = np.array([place[number[s]] for s in encoded.dictionary.to_pylist()])
    ids, item = remap[encoded.indices.to_numpy()], held.column("item_id").to_numpy()
    names, of = np.unique(item, return_inverse=True)
    order = np.lexsort((ids, of))
    each = np.split(ids[order], np.searchsorted(of[order], np.arange(1, len(names))))

    table = written(docs.mapInArrow(_counted(vocabulary), "doc_id long, n long, ids array<int>, tfs array<long>"), "terms")
    n_docs, length = table.agg(F.count(F.lit(1)), F.expr("cast(sum(cast(n as decimal(20,0))) as string)")).first()
    weight, most = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
    if n_docs:
        m = F.expr(f"cast(50 + (cast(50 * n as decimal(20,0)) * {n_docs}) div {length} as bigint)") if int(length) else F.lit(50)
        rows = table.select(m.alias("m"), F.inline(F.arrays_zip("ids", "tfs")))
        gain = F.expr("(1000000000 * tfs) div (1000 * tfs + 20 * m)")
        for r in rows.groupBy("ids").agg(F.count(F.lit(1)).alias("df"), F.max(gain).alias("gain")).toArrow().to_pylist():  # MOST_TERMS rows at most
            weight[r["ids"]] = floor(1000 * log((2 * n_docs + 2) / (2 * r["df"] + 1)))
            most[r["ids"]] = weight[r["ids"]] * r["gain"]
    found = table.mapInArrow(_scored(Scorer(names, each, weight, most, n_docs, int(length or 0), k)), "item_id long, doc_id long, score long")
    some = F.pmod(F.xxhash64("doc_id", "score"), F.lit(GROUPS))
    top = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))).filter(F.col("rank") <= k)
    best = top(top(found.withColumn("some", some), "item_id", "some").drop("rank", "some"), "item_id")
    return best.select("item_id", "rank", "doc_id", "score")


def ranked(df: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``k`` best of ``df`` (doc_id, text) for each of ``items`` (item_id, text)."""
    docs = in_small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms(F.col("text"))).alias("term")).filter("item_id is not null").distinct()
    asked = written(asked, "item-terms")
    parts = max(1, -(-asked.count() // MOST_TERMS))
    out = [_part(docs, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p), k) for p in range(parts)]
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return found


SQL = f"""WITH q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL),
  d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
  s AS (SELECT count(*)::BIGINT AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
  p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
  w AS (SELECT term, floor(1000 * ln((2 * max(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
  g AS (SELECT p.r, d.doc_id, p.term, (w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * len(d.t) * s.n) // s.l))))::BIGINT AS g FROM p JOIN d ON d.r = p.r JOIN w ON w.term = p.term, s),
  f AS (SELECT q.item_id, g.r, g.doc_id, sum(g.g)::BIGINT AS score FROM q JOIN g ON g.term = q.term GROUP BY q.item_id, g.r, g.doc_id HAVING sum(g.g) > 0),
  k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM f)
SELECT * FROM k WHERE rank <= {K}"""

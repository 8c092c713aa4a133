"""Near copies at a given similarity: texts whose sets of five-word shingles have a Jaccard similarity of ``SIMILARITY`` or more.

At a similarity of 0.8 two 64-bit SimHash fingerprints differ in some ten bits. No pigeonhole holds pairs that far apart without
probing most of the table, and where thousands of texts lie just below the similarity every such search gives their pairs by the
million. So SimHash finds the bulk, and an exact filter the rest; what is in one component already is never paired again.

1. SimHash: ``PRINTS`` fingerprints of 64 bits each are searched as in ``simhash``: correlated bits together, thresholds allotted by
   the same dynamic program, buckets probed. Members of a bucket are compared with its ``LEADERS`` first ones only, a row for each
   member, and each text keeps the nearest of each kind. Verified pairs form components, so a large group is one, or few.
2. Who is left: of each text ``SAMPLE`` to twice as many shingles, the same ones in all texts, or all of a shorter text, are counted
   by component. A text stays if so many of its own are found in another component as a similar text would have; in a sampled text
   up to ``BEYOND`` standard deviations fewer. All others are done.
3. The rest, exactly: texts that stay are joined by shingles. In the order of their rarity, and with shingles of a single component
   first, similar texts share one among the first few; how many depends on both sizes, so texts meet in (shingle, size, size). Texts
   whose own shingles are too many to leave room for a similar one never enter. First with leaders, as in 1, then with all others.
4. Candidates are verified by their whole sets of shingles (64-bit hashes). Only candidates' texts are read for it.

Defined results: words and letter case as in op10; fewer words than a shingle make one shingle; null and empty texts, and those
without words, are copies of one another; equal texts are one node (by a 64-bit hash of the text); rows with null doc_id take
no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import acos, floor, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .shared import in_small_batches, written
from .simhash import MAX_BITS, plan

SHINGLE, SIMILARITY = 5, 0.8
#: Fingerprints, and kinds of leaders of a bucket.
PRINTS, LEADERS = 4, 4
#: Shingles that a longer text is sampled to at least, and how far beyond the expected number of something a text or pair is let go.
SAMPLE, BEYOND = 64, 3.5
#: Sizes of sets are taken together within this ratio; words of the bit maps by which sets are compared in the last join.
RATIO, MAP_WORDS = 1.02, 32
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ONES = np.uint64(0x0101010101010101)


def flip_rate(similarity: float) -> float:
    """Probability that a bit differs between the fingerprints of two sets of this Jaccard similarity."""
    return acos(2 * similarity / (1 + similarity)) / pi


def most_bits(bits: int) -> int:
    """Differing bits up to which a pair may be a link."""
    rate = flip_rate(SIMILARITY)
    return floor(bits * rate + BEYOND * (bits * rate * (1 - rate)) ** 0.5)


class _Slice:
    """The distinct shingle hashes of texts a to b, one text after the other, each sorted: ``h``, ``text``, and ``cut`` into them."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        starts, ends, word_of = W.split(buf, offsets)
        h, rows = W.hashes(buf, starts, ends), len(offsets) - 1
        first = np.searchsorted(word_of, np.arange(rows + 1))
        n = max(0, len(h) - SHINGLE + 1)
        whole = word_of[:n] == word_of[SHINGLE - 1 : SHINGLE - 1 + n]
        grams, text = W.mix(W.grams(h, SHINGLE, _BASE))[whole], word_of[:n][whole]
        short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE))
        if len(short):
            each = [W.mix(W.grams(h[first[i] : first[i + 1]], int(first[i + 1] - first[i]), _BASE)) for i in short]
            grams, text = np.concatenate([grams, *each]), np.concatenate([text, short])
            order = np.argsort(text, kind="stable")
            grams, text = grams[order], text[order]
        cut = np.searchsorted(text, np.arange(rows + 1))
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            grams[x:y].sort()
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        self.h, self.text = grams[new], text[new]
        self.cut = np.searchsorted(self.text, np.arange(rows + 1))

    def prints(self, words: int) -> np.ndarray:
        """A fingerprint of ``words`` words for each text: a bit is set where more than half of the shingles' hashes have it."""
        size = np.diff(self.cut)
        out = np.zeros((len(size), words), np.uint64)
        if not len(self.h):
            return out
        # eight counters of a byte in each 64-bit integer, so at most 255 shingles are added up at once
        piece = np.flatnonzero((np.arange(len(self.h)) - self.cut[self.text]) % 255 == 0)
        owner = np.flatnonzero(np.concatenate([[True], np.diff(self.text[piece]) > 0]))
        has = self.text[piece][owner]
        for w in range(words):
            x = W.mix(self.h + np.uint64((w + 1) * _BASE % (1 << 64)))
            ones = np.empty((len(has), 8, 8), np.int64)
            for b in range(8):
                eight = np.add.reduceat((x >> np.uint64(b)) & _ONES, piece)
                ones[:, :, b] = np.add.reduceat(eight.view(np.uint8).reshape(-1, 8).astype(np.int64), owner, axis=0)
            over = 2 * ones.reshape(-1, 64) > size[has, None]
            out[has, w] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
        return out


def _slices(column: pa.Array) -> Iterator[tuple[int, int, _Slice]]:
    buf, offsets = W.flat(column)
    for a, b in W.slices(offsets):
        yield a, b, _Slice(_LOWER[buf[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a])


def sampled(h: np.ndarray, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts' shingles those whose lowest ``level`` bits are zero, where the level is the highest that leaves ``SAMPLE`` of them on
    average: their places, those of the next level first; the levels; how many of the next level a text has, or -1 where no
    similar text can have that level."""
    level = np.maximum(np.floor(np.log2(np.maximum(size, 1) / SAMPLE)), 0).astype(np.int64)
    of = level[text].astype(np.uint64)
    low = h & ((np.uint64(1) << of) - np.uint64(1)) == 0
    next_ = low & ((h >> of) & np.uint64(1) == 0)
    places = np.flatnonzero(low)
    places = places[np.lexsort((~next_[places], text[places]))]
    coarse = np.bincount(text[next_], minlength=len(size))
    return places, level, np.bincount(text[low], minlength=len(size)), np.where(size / SIMILARITY >= SAMPLE * 2.0 ** (level + 1), coarse, -1)


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, s in _slices(batch.column("text")):
            prints = pa.FixedSizeListArray.from_arrays(pa.array(s.prints(PRINTS).view(np.int64).ravel()), PRINTS).cast(pa.list_(pa.int64()))
            size = np.diff(s.cut)
            places, level, n, coarse = sampled(s.h, s.text, size)
            sample = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(s.h[places].view(np.int64)))
            columns = [*[batch.column(c).slice(a, b - a) for c in ("doc_id", "node")], pa.array(size), prints, pa.array(level), pa.array(coarse.astype(np.int64)), sample]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "prints", "level", "coarse", "sample"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, s in _slices(batch.column("text")):
            sets = pa.ListArray.from_arrays(pa.array(s.cut.astype(np.int32)), pa.array(s.h.view(np.int64)))
            maps = np.zeros((b - a, MAP_WORDS), np.uint64)
            place = (s.h >> np.uint64(20)) % np.uint64(64 * MAP_WORDS)
            np.bitwise_or.at(maps, (s.text, (place // np.uint64(64)).astype(np.int64)), np.uint64(1) << place % np.uint64(64))
            maps = pa.FixedSizeListArray.from_arrays(pa.array(maps.view(np.int64).ravel()), MAP_WORDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), sets, maps], names=["node", "shingles", "map"])


def _together(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often bits i and j of a word are both set, over a task's rows."""
        n = np.zeros((words, 64, 64), np.int64)
        for batch in batches:
            prints = batch.column("prints").flatten().to_numpy(zero_copy_only=False).reshape(-1, words)
            for a in range(0, len(prints), 1 << 12):
                bits = np.unpackbits(np.ascontiguousarray(prints[a : a + (1 << 12)]).view(np.uint8).reshape(-1, words, 8), axis=2, bitorder="little").astype(np.float32)
                for w in range(words):
                    n[w] += np.rint(bits[:, w].T @ bits[:, w]).astype(np.int64)
        i, j = np.triu_indices(64)
        for w in range(words):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), w, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n[w, i, j])], names=["w", "i", "j", "n"])

    return run


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for c in ("of_a", "of_b"):
            column = batch.column(c)
            sides.append((column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])))
        (x, cut_x), (y, cut_y) = sides
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a, b = x[cut_x[i] : cut_x[i + 1]], y[cut_y[i] : cut_y[i + 1]]
            both = np.sort(np.concatenate([a, b]))
            both = np.count_nonzero(both[1:] == both[:-1])
            keep[i] = both >= SIMILARITY * (len(a) + len(b) - both) - 1e-9
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def _shingled(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, what: str) -> DataFrame:
    """node, shingles, map (a bit for each shingle, by its hash) of the ``wanted`` nodes, as a table."""
    wanted = written(wanted.select("node").distinct().join(nodes.select("node", F.col("rep").alias("doc_id")), "node"), f"{what}-nodes")  # a table whose size Spark knows
    texts = docs.join(wanted, ["node", "doc_id"]).select("node", "text")
    return written(texts.mapInArrow(_sets, "node long, shingles array<long>, map array<long>").dropDuplicates(["node"]), f"{what}-shingles")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, what: str, sets: DataFrame | None = None) -> DataFrame:
    """Of ``pairs`` (a, b) those that are similar, as a table."""
    pairs = written(pairs, f"{what}-pairs")
    if sets is None:
        sets = _shingled(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), docs, nodes, what)
    of = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"of_{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "of_a", "of_b")
    return written(both.mapInArrow(_similar, "a long, b long"), f"{what}-links")


def _differing(a: list[str], b: list[str]) -> Column:
    out = F.lit(0)
    for x, y in zip(a, b, strict=True):
        out += F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
    return out


def _sizes_fit(a: str, b: str) -> Column:
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b) - 1e-9


def _literal(values: list, kind: str) -> Column:
    return F.from_json(F.lit(str(values)), kind)  # folded to one literal


def _mask(bits: list[int]) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >> 63 else x


def _buckets(parts: list[tuple[int, list[int], int]]) -> Column:
    """Array of (bucket, own) of (word, bits, threshold): a text's keys, and (own: false) those with up to so many bits flipped."""
    rows = []
    for k, (w, group, t) in enumerate(parts):
        rows += [(k, w, _mask(group), _mask(c)) for e in range(t + 1) for c in combinations(group, e)]
    columns = [_literal([r[c] for r in rows], "array<long>") for c in range(4)]

    def bucket(i: Column) -> Column:
        k, w, mask, flip = (F.get(c, i) for c in columns)
        key = F.get(F.col("prints"), w.cast("int")).bitwiseAND(mask).bitwiseXOR(flip)
        return F.struct(F.xxhash64(k, key).alias("key"), (flip == 0).alias("own"))

    return F.transform(F.sequence(F.lit(0), F.lit(len(rows) - 1)), bucket)


def node_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


_WORDS = [f"p{i}" for i in range(PRINTS)]


def _stars(members: DataFrame, leads: Column, fits) -> DataFrame:
    """Pairs (a, b): each of ``members`` (key, node, n, fingerprints) with the nearest leaders of its keys; ``leads`` says who may
    lead; ``fits`` says of a leader's column whether a member may be similar to it."""
    kinds = [f"lead{i}" for i in range(LEADERS)]
    carried = [c for c in members.columns if c not in ("key", "own")]
    chosen = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("order"), *carried)).alias(k) for i, k in enumerate(kinds)]
    leaders = members.filter(leads).groupBy("key").agg(F.count(F.lit(1)).alias("many"), *chosen)
    bits = lambda k: _differing(_WORDS, [f"{k}.{c}" for c in _WORDS])
    near = lambda k: F.when((F.col("node") != F.col(f"{k}.node")) & _sizes_fit("n", f"{k}.n") & fits(k), F.struct(bits(k).alias("d"), F.col(f"{k}.node").alias("to")))
    met = members.join(leaders, "key").select("node", *[near(k).alias(k) for k in kinds]).filter(F.coalesce(*kinds).isNotNull())
    nearest = met.groupBy("node").agg(*[F.min(k).alias(k) for k in kinds])
    pairs = nearest.select("node", F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(f"{k}.to") for k in kinds])))).alias("to"))
    return pairs.select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")).distinct()


def _named(nodes: DataFrame, links: DataFrame, what: str) -> DataFrame:
    """``nodes`` with the component that ``links`` give them, as a table."""
    found = written(components(links), f"{what}-components")
    return written(nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), what)


def _elsewhere(tokens: DataFrame, what: str) -> DataFrame:
    """Tokens of several components, with how many rows they have: a table, so that Spark can split a frequent one in joins."""
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    return written(counted.filter("low < high").select("token", "df"), what)


def _left(named: DataFrame) -> DataFrame:
    """The nodes that may have a similar one in another component."""
    tokens = named.select("node", "component", "coarse", F.posexplode("sample").alias("at", "token"))
    found = tokens.join(_elsewhere(tokens, "sampled-elsewhere"), "token").groupBy("node").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("at") < F.col("coarse")).alias("some"))
    need = lambda s: SIMILARITY * s - BEYOND * F.sqrt(SIMILARITY * (1 - SIMILARITY) * s) - 1e-9
    whole = F.when(F.col("level") == 0, SIMILARITY * F.size("sample") - 1e-9).otherwise(need(F.size("sample")))
    both = named.select("node", "level", "coarse", "sample").join(found, "node")
    return written(both.filter((F.col("all") >= whole) | ((F.col("coarse") >= 0) & (F.col("some") >= need(F.col("coarse"))))).select("node"), "left")


def _overlap(a: Column, b: Column) -> Column:
    """Shingles that sets of two sizes have in common at least, if they are similar."""
    return F.ceil(SIMILARITY / (1 + SIMILARITY) * (a + b) - 1e-9)


def _prefixes(sets: DataFrame, named: DataFrame, what: str) -> DataFrame:
    """key, before, role, place, node, n, component, fingerprints, largest: a row for each shingle and sizes by which a node may meet
    a similar one of another component; ``before`` is the key of the node's shingle before in these sizes, or null; ``largest`` is
    the largest of a key's components."""
    tokens = sets.join(named.select("node", "component"), "node").select("node", "component", F.explode("shingles").alias("token"))
    alive = tokens.join(_elsewhere(tokens, f"{what}-elsewhere"), "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("alive"))
    n, size = F.col("n"), lambda x: F.floor(F.log(x) / np.log(RATIO)).cast("int")
    rows = alive.join(named.select("node", "component", "n", *_WORDS), "node").withColumn("own", n - F.size("alive"))
    first = F.slice("alive", F.lit(1), F.greatest(n - F.ceil(SIMILARITY * n - 1e-9) + 1 - F.col("own"), F.lit(0)).cast("int"))
    rows = rows.select("node", "component", "n", *_WORDS, "own", F.posexplode(first).alias("i", "shingle"), first.alias("first")).withColumn("place", (F.col("own") + F.col("i")).cast("long"))
    least = lambda b: F.greatest(F.ceil(F.pow(F.lit(RATIO), b) - 1e-6), F.ceil(SIMILARITY * n - 1e-9))
    # role 0: the smaller of two sets, 1: the larger, 2: sizes are taken together
    smaller = F.transform(F.sequence(size(n), size(n / SIMILARITY + 1e-9)), lambda b: F.struct(F.when(b == size(n), 2).otherwise(0).alias("role"), size(n).alias("small"), b.alias("large"), least(b).alias("least")))
    larger = F.transform(F.filter(F.sequence(size(F.greatest(SIMILARITY * n - 1e-9, F.lit(1.0))), size(n)), lambda b: b < size(n)), lambda b: F.struct(F.lit(1).alias("role"), b.alias("small"), size(n).alias("large"), least(b).alias("least")))
    met = rows.select("*", F.inline(F.filter(F.concat(smaller, larger), lambda r: F.col("place") <= n - _overlap(n, r["least"]))))
    last = F.when(F.col("i") > 0, F.xxhash64(F.get("first", F.col("i") - 1)["token"], "small", "large"))
    met = written(met.select(F.xxhash64("shingle.token", "small", "large").alias("key"), last.alias("before"), "role", "place", "node", "n", "component", *_WORDS), what)
    sizes = met.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), *[F.bool_or(F.col("role") == r).alias(f"has{r}") for r in range(3)])
    keys = sizes.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("largest"), F.count(F.lit(1)).alias("kinds"), *[F.bool_or(f"has{r}").alias(f"has{r}") for r in range(3)])
    return met.join(written(keys.filter("kinds > 1 and (has2 or has0 and has1)").select("key", "largest"), f"{what}-keys"), "key")


def _may(a: str, b: str) -> Column:
    """Whether two rows of one key may be of similar sets of different components; a and b go before the columns' names."""
    of = lambda c: (F.col(f"{a}{c}"), F.col(f"{b}{c}"))
    (na, nb), (pa_, pb), (ra, rb), (ca, cb) = of("n"), of("place"), of("role"), of("component")
    return (ca != cb) & (F.least(na - pa_, nb - pb) >= _overlap(na, nb)) & ((ra != rb) | (ra == 2))


def near_copies(df: DataFrame) -> DataFrame:
    """doc_id, node, first (least doc_id of the component) of the distinct (doc_id, node) of ``df`` (doc_id, text)."""
    docs = in_small_batches(df).filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), node_of(F.col("text")).alias("node"), F.col("text").cast("string").alias("text"))
    printed = written(docs.mapInArrow(_printed, "doc_id long, node long, n long, prints array<long>, level long, coarse long, sample array<long>"), "prints")
    nodes = printed.groupBy("node").agg(F.min("doc_id").alias("rep"), *[F.any_value(c).alias(c) for c in ("n", "prints", "level", "coarse", "sample")])
    nodes = written(nodes.select("*", *[F.get("prints", F.lit(i)).alias(c) for i, c in enumerate(_WORDS)]), "nodes")
    together = np.zeros((PRINTS, 64, 64))
    for r in nodes.select("prints").mapInArrow(_together(PRINTS), "w int, i int, j int, n long").groupBy("w", "i", "j").agg(F.sum("n").alias("n")).collect():  # 2,080 rows a fingerprint
        together[r.w, r.i, r.j] = together[r.w, r.j, r.i] = r.n
    rows, wordless = nodes.agg(F.count(F.lit(1)), F.min(F.when(F.col("n") == 0, F.col("node")))).first()

    parts = [(w, group, t) for w in range(PRINTS) for group, t in plan(together[w], rows, MAX_BITS)]
    near = lambda k: _differing(_WORDS, [f"{k}.{c}" for c in _WORDS]) <= most_bits(64 * PRINTS)
    members = nodes.filter("n > 0").select("node", "n", *_WORDS, F.inline(_buckets(parts)))
    links = _verified(_stars(members, F.col("own"), near), docs, nodes, "star")
    links = links.union(nodes.filter((F.col("n") == 0) & (F.col("node") != F.lit(wordless))).select(F.lit(wordless).cast("long").alias("a"), F.col("node").alias("b")))

    named = _named(nodes.drop("rep", "prints"), links, "star-nodes")
    left = _left(named)
    sets, named = _shingled(left, docs, nodes, "left"), written(named.drop("sample").join(left, "node"), "left-named")
    stars = _stars(_prefixes(sets, named, "first").drop("largest", "before"), F.lit(True), lambda k: _may("", f"{k}."))
    more = _verified(stars, docs, nodes, "prefix-star", sets)
    links = links.union(more)
    named = _named(named.drop("component"), links, "prefix-nodes")
    rest = written(_prefixes(sets, named, "rest").drop(*_WORDS).join(sets.select("node", "map"), "node"), "rest-mapped")
    a, b = (rest.filter(F.col("role") != r).select("key", *[F.col(c).alias(f"{x}_{c}") for c in ("before", "node", "n", "role", "place", "component", "largest", "map")]) for x, r in (("a", 1), ("b", 0)))
    # shingles of one text alone, at least; a column for each word would make code too long to be compiled
    apart = F.aggregate(F.zip_with("a_map", "b_map", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    close = apart <= F.col("a_n") + F.col("b_n") - 2 * _overlap(F.col("a_n"), F.col("b_n"))
    new = ~F.coalesce(F.col("a_before") == F.col("b_before"), F.lit(False))  # else they have met by the shingle before
    once = (F.col("a_role") == 0) | (F.col("a_node") < F.col("b_node"))
    # what lies within a key's largest component is linked already and isn't looked at
    outside = lambda x: F.col(f"{x}_component") != F.col(f"{x}_largest")
    met = [x.join(y, "key").filter(once & new & _may("a_", "b_") & _sizes_fit("a_n", "b_n") & close).select("a_node", "b_node") for x, y in ((a.filter(outside("a")), b), (a.filter(~outside("a")), b.filter(outside("b"))))]
    pairs = met[0].union(met[1]).select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
    links = links.union(_verified(pairs, docs, nodes, "other", sets))

    found = nodes.select("node", "rep").join(components(links), "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    firsts = found.groupBy("component").agg(F.min("rep").alias("first"))
    return printed.select("doc_id", "node").distinct().join(found.join(firsts, "component").select("node", "first"), "node")

"""Substring deduplication by seed and extend.

A *window* is ``window`` consecutive words of one document. A word goes if a window over it has the same words as a window
that starts earlier: in a document of smaller doc_id, or before it in the same document. Windows are judged on the input.

1. Seeds. Each window has an anchor: the run of ``seed`` words within it with the least hash (winnowing; the rightmost among
   equals). Equal windows have equal anchors at equal places, so only documents that share an anchor can share a window.
   Anchors found once in the corpus drop out before anything else is looked at.
2. Extension. Around an anchor found twice or more, the windows that have it form a run, reaching up to ``window - seed``
   words to either side. Runs join on anchor and content; of equal runs the first stays, which settles the inside of every
   long repeat at once. What the first runs still share (at the borders of repeats, where contexts differ) is found by
   joining their windows.
3. Maximal repeats. The windows that are left over, merged where they touch, are the spans to remove.

Matches are not extended pair by pair: a passage in many documents would give all its pairs. Equal runs are what the pairs
of an anchor agree in when they are extended by up to a window to both sides, found by one aggregation; windows find the rest.

Every join is by a hash key that pre-aggregates before its shuffle (the first place of each run or window), so a
passage in a third of all documents costs one row for each task. Runs and windows are compared by 128 bits, in two halves that
rest on different hashes of the words.

Defined results: a null text has no words; a text without a repeated window stays; rows with null doc_id are
neither compared nor changed. A document is a doc_id with a text: rows that repeat both are one document and get the same
result, rows that repeat a doc_id with other texts are documents of their own, in the order of their texts' hashes. Other columns
are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .shared import documents, written

WINDOW, SEED = 20, 8
_GRAM, _W1, _W2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_PLACE = np.uint64(0xA0761D6478BD642F)


class _Slice:
    """The windows of a slice of texts: ``first`` word of each, its ``anchor``, and where runs of windows with one anchor begin."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, window: int, seed: int):
        self.buf, self.offsets = buf, offsets
        self.starts, self.ends, self.text = W.split(buf, offsets)
        self.h = h = W.hashes(buf, self.starts, self.ends)
        n = max(0, len(h) - window + 1)
        self.first = np.flatnonzero(self.text[:n] == self.text[window - 1 : window - 1 + n])
        gram = W.mix(W.grams(h, seed, _GRAM))
        self.anchor = W.sliding_argmin(gram, window - seed + 1)[: n][self.first] if len(self.first) else np.zeros(0, np.int64)
        self.hash = gram[self.anchor].view(np.int64) if len(self.anchor) else np.zeros(0, np.int64)
        new = np.ones(len(self.first), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.first[1:] != self.first[:-1] + 1)
        self.run = np.flatnonzero(new)
        self.size = np.diff(np.append(self.run, len(self.first)))
        self.word0 = np.searchsorted(self.text, np.arange(len(offsets)))  # a text's first word
        self.window = window

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each window's words, in two halves from two hashes of the words."""
        one = W.grams(self.h, self.window, _W1)[self.first]
        two = W.grams(W.hashes(self.buf, self.starts, self.ends, 1), self.window, _W2)[self.first]
        return W.mix(one), W.mix(two)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each distinct row, in order."""
    order = np.lexsort(columns[::-1])
    if not len(order):
        return order
    differs = np.zeros(len(order), bool)
    differs[0] = True
    for c in columns:
        differs[1:] |= c[order][1:] != c[order][:-1]
    return np.sort(np.minimum.reduceat(order, np.flatnonzero(differs)))


def _over(batches: Iterator[pa.RecordBatch], window: int, seed: int):
    """(slice, first row, row after the last, batch) for all batches."""
    for batch in batches:
        buf, offsets = W.flat(batch.column("text"))
        for a, b in W.slices(offsets):
            yield _Slice(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], window, seed), a, b, batch


def _places(column: pa.Array, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Row (from 0) and value of each element of a list column's rows a to b."""
    part = column.slice(a, b - a)
    n = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(b - a), n), part.flatten().to_numpy(zero_copy_only=False)


def _in(row: np.ndarray, value: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which (row, value) are among (rows, values)."""
    if not len(rows) or not len(row):
        return np.zeros(len(row), bool)
    both = np.concatenate([np.stack([rows, values], 1), np.stack([row, value], 1)])
    _, code = np.unique(both, axis=0, return_inverse=True)
    code = code.ravel()
    return np.isin(code[len(rows) :], code[: len(rows)])


def _lists(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """A list for each of the rows; ``row`` is sorted."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), pa.array(values))


def _anchors(window: int, seed: int):
    """The distinct anchors of each text, and those that lie in it more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, a, b, batch in _over(batches, window, seed):
            h, text = s.hash[s.run], s.text[s.first[s.run]]
            order = np.lexsort((h, text))
            h, text = h[order], text[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            at = np.flatnonzero(new)
            often = at[np.diff(np.append(at, len(h))) > 1]
            lists = [_lists(h[x], text[x], b - a) for x in (at, often)]
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(a, b - a) for c in ("doc_id", "t")] + lists, names=["doc_id", "t", "anchors", "often"])

    return run


def _runs(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, a, b, batch in _over(batches, window, seed):
            ids, texts = (batch.column(c).slice(a, b - a) for c in ("doc_id", "t"))
            if not len(s.run):
                continue
            text, h = s.text[s.first[s.run]], s.hash[s.run]
            keep = np.flatnonzero(_in(text, h, *_places(batch.column("seeds"), a, b)))
            if not len(keep):
                continue
            one, two = s.keys()
            place = (np.arange(len(s.first)) - np.repeat(s.run, s.size) + 1).astype(np.uint64)
            at = (s.first - s.anchor + window).astype(np.uint64)  # where the anchor lies counts too
            content = np.add.reduceat(W.mix(W.mix(one + place * _PLACE) ^ two) + at, s.run).view(np.int64)
            text, h, content, lo = text[keep], h[keep], content[keep], s.first[s.run][keep]
            new = _distinct(text, h, content)
            of = pa.array(text[new])
            yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(content[new]), ids.take(of), texts.take(of), pa.array((lo - s.word0[text])[new].astype(np.int32))], names=["h", "r", "doc_id", "t", "lo"])

    return run


def _windows(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, a, b, batch in _over(batches, window, seed):
            ids, texts = (batch.column(c).slice(a, b - a) for c in ("doc_id", "t"))
            if not len(s.run):
                continue
            text = s.text[s.first[s.run]]
            take = _in(text, s.first[s.run] - s.word0[text], *_places(batch.column("firsts"), a, b))
            take = np.flatnonzero(np.repeat(take, s.size))
            if not len(take):
                continue
            one, two = (k[take].view(np.int64) for k in s.keys())
            first = s.first[take]
            text = s.text[first]
            new = _distinct(text, one, two)
            of = pa.array(text[new])
            yield pa.RecordBatch.from_arrays([pa.array(one[new]), pa.array(two[new]), ids.take(of), texts.take(of), pa.array((first - s.word0[text])[new].astype(np.int32))], names=["w1", "w2", "doc_id", "t", "start"])

    return run


def _cleaned(window: int, seed: int, layout: bool):
    """Removes the words under repeated windows: (row, n_words, n_removed, text left, spans removed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, a, b, batch in _over(batches, window, seed):
            n = len(s.h)
            gone = np.zeros(n, bool)
            if len(s.run):
                text = s.text[s.first[s.run]]
                shared = np.repeat(_in(text, s.hash[s.run], *_places(batch.column("seeds"), a, b)), s.size)
                first = s.first[shared]
                text = s.text[first]
                again = first[~_in(text, first - s.word0[text], *_places(batch.column("starts"), a, b))]
                gone = W.covered(again, window, n)
            rows = b - a
            total = np.bincount(s.text, minlength=rows)
            lost = np.bincount(s.text[gone], minlength=rows)
            kept, spans, data = [], [], s.buf.tobytes()
            for i in range(rows):
                w0, w1 = s.word0[i], s.word0[i] + total[i]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[w0:w1].astype(np.int8), [0]])))
                spans.append(edge.astype(np.int32))
                x, y = s.starts[w0:w1], s.ends[w0:w1]
                if layout:  # cut the spans out, each with the white space after it
                    at, parts = int(s.offsets[i]), []
                    for first, after in edge.reshape(-1, 2).tolist():
                        parts.append(data[at : x[first]])
                        at = x[after] if after < len(x) else y[after - 1]
                    kept.append(b"".join([*parts, data[at : s.offsets[i + 1]]]))
                else:
                    stay = np.flatnonzero(~gone[w0:w1])
                    kept.append(b" ".join([data[p:q] for p, q in zip(x[stay].tolist(), y[stay].tolist(), strict=True)]))
            columns = [batch.column(c).slice(a, rows) for c in ("doc_id", "rest")]
            columns += [pa.array(total), pa.array(lost), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "rest", "n_words", "n_removed", "kept_text", "spans"])

    return run


def substring_dedup(df: DataFrame, window: int = WINDOW, seed: int = SEED, layout: bool = False) -> DataFrame:
    """One row for each row of ``df`` (doc_id long, text string): doc_id, n_words, n_removed, kept_text (the words left, joined by
    one space, or with ``layout`` the text with the spans cut out), spans (first word removed, first word after it, and so on,
    from 0) and rest (a struct of the other columns)."""
    docs = documents(df)
    anchors = docs.filter("doc_id is not null").select("doc_id", "t", "text").mapInArrow(_anchors(window, seed), "doc_id long, t long, anchors array<long>, often array<long>")
    anchors = written(anchors, "anchors")  # read twice, found once
    each = anchors.select("doc_id", "t", F.explode("anchors").alias("h"))
    counted = each.select("h", F.lit(1).alias("n")).unionAll(anchors.select(F.explode("often").alias("h"), F.lit(1).alias("n")))
    seeds = counted.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    seeds = written(seeds, "seeds")  # a table of its own, so that Spark can split a frequent anchor's rows in the join
    seeds_of = each.join(seeds, "h").groupBy("doc_id", "t").agg(F.collect_set("h").alias("seeds"))
    # the three joins below deal the texts out by document in the same way, so Spark does it once and reads it three times
    by = ["doc_id", "t"]
    runs = docs.join(seeds_of, by, "left").mapInArrow(_runs(window, seed), "h long, r long, doc_id long, t long, lo int")
    firsts = runs.groupBy("h", "r").agg(F.min(F.struct("doc_id", "t", "lo")).alias("at")).select("at.*")
    firsts_of = firsts.groupBy("doc_id", "t").agg(F.collect_list("lo").alias("firsts"))
    wins = docs.join(firsts_of, by, "left").mapInArrow(_windows(window, seed), "w1 long, w2 long, doc_id long, t long, start int")
    stays = wins.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "t", "start")).alias("at")).select("at.*")
    stays_of = stays.groupBy("doc_id", "t").agg(F.collect_list("start").alias("starts"))
    out = T.StructType([docs.schema["doc_id"], docs.schema["rest"]])
    out = out.add("n_words", "long").add("n_removed", "long").add("kept_text", "string").add("spans", T.ArrayType(T.IntegerType()))
    return docs.join(seeds_of, by, "left").join(stays_of, by, "left").mapInArrow(_cleaned(window, seed, layout), out)

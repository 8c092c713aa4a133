"""Quality classifier trained on weak labels.

1. Heuristic labellers, which overlap, vote good (1), bad (0) or abstain (-1) on every text.
2. Expectation-maximisation over the numbers of texts with each combination of votes (at most 3 ** 9 rows, counted over the
   whole corpus) estimates each labeller's accuracies without labels, and gives each combination a posterior.
3. A logistic model over hashed features (words, word shapes and a few text-level bands) is trained on the posteriors of a
   sample. The sample is the only bounded part: about ``SAMPLE`` texts, chosen by the hash of their id, each as whole text, of
   which at most ``BUCKETS`` numbers each reach the driver.
4. The model, a fixed number of weights, scores every whole text.

The table is read three times (votes, sample, scores) and nothing but counts is shuffled.

Defined results: a null or empty text, or one without words, has no features and is judged by the bias alone, as the labellers
all abstain; an empty table gives no rows; null doc_ids are scored but never in the sample; repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import in_small_batches

#: Texts that the model is trained on, about; hashed features of words.
SAMPLE, BUCKETS = 4000, 1 << 12
SHAPES, BANDS = 256, 80
FEATURES = BUCKETS + SHAPES + BANDS
ROUNDS, STEPS, RATE, DECAY = 25, 200, 0.1, 1e-5
#: Starting share of good texts, and the accuracies on good and on bad texts with their lower bounds, as rules rarely accuse
#: good texts, but each misses most bad ones.
THRESHOLD = 0.3
PRIOR, GOOD, BAD, MOST = 0.8, (0.97, 0.9), (0.4, 0.02), 0.999
_KINDS = np.zeros(256, np.uint8)  # a word's shape is the union of its bytes' kinds
_KINDS[97:123] = 1
_KINDS[65:91] = 2
_KINDS[48:58] = 4
_KINDS[128:] = 8
_KINDS[[*b".,;:?'\"()-"]] = 16
_KINDS[[*b"!"]] = 32
_KINDS[[*b"#*$%&|<>"]] = 64
_KINDS[[*b"/@[]\\^_`{}~+="]] = 128


def _counts(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of each text, and of each word its text, hash and shape."""
    n = len(offsets) - 1
    starts, ends, text = W.split(buf, offsets)
    h = W.hashes(buf, starts, ends)
    kinds = _KINDS[buf]
    shape = np.bitwise_or.reduceat(kinds, starts) if len(starts) else np.zeros(0, np.uint8)  # white space has no kind
    upto = lambda mask: np.concatenate([[0], np.cumsum(mask)])

    def of(mask: np.ndarray) -> np.ndarray:
        return np.diff(upto(mask)[offsets])

    words = np.bincount(text, minlength=n)
    def repeats(of: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of each text's values it has had before."""
        order = np.lexsort((value, of))
        again = (value[order][1:] == value[order][:-1]) & (of[order][1:] == of[order][:-1])
        return np.bincount(of[order][1:][again], minlength=n)

    m = max(0, len(h) - 4)
    inside = np.flatnonzero(text[:m] == text[4 : 4 + m])  # windows of five words
    g, of_text = W.grams(h, 5, 0x9E3779B97F4A7C15)[inside], text[inside]
    return {
        "text": text,
        "h": h,
        "shape": shape,
        "words": words,
        "windows": np.bincount(of_text, minlength=n),
        "repeats": repeats(of_text, g),
        "distinct": words - repeats(text, h),
        "stutters": np.bincount(text[1:][(h[1:] == h[:-1]) & (text[1:] == text[:-1])], minlength=n),
        "solid": of(kinds > 0),
        "capitals": of(kinds == 2),
        "marks": of(kinds >= 16),
        "symbols": of(kinds == 64),
        "calls": of(kinds == 32),
        "stops": of((buf == 0x2E) | (buf == 0x3F)),
        "lettered": np.bincount(text[(shape & 11) > 0], minlength=n),
    }


#: Each labeller: its name, when it votes bad, when it votes good.
LABELLERS = [
    ("symbols", lambda c: 10 * c["symbols"] > c["words"], lambda c: c["symbols"] == 0),
    ("marks", lambda c: (c["words"] >= 10) & (100 * c["marks"] > 9 * c["solid"]), lambda c: 100 * c["marks"] <= 7 * c["solid"]),
    ("capitals", lambda c: 100 * c["capitals"] > 40 * c["solid"], lambda c: 100 * c["capitals"] <= 20 * c["solid"]),
    ("calls", lambda c: 10 * c["calls"] > c["words"], lambda c: c["calls"] == 0),
    ("repetition", lambda c: 10 * c["repeats"] > c["windows"], lambda c: (c["windows"] > 0) & (c["repeats"] == 0)),
    ("stutter", lambda c: 20 * c["stutters"] > c["words"], lambda c: (c["words"] >= 10) & (c["stutters"] == 0)),
    ("variety", lambda c: (c["words"] >= 30) & (10 * c["distinct"] < 3 * c["words"]), lambda c: (c["words"] >= 10) & (10 * c["distinct"] > 4 * c["words"])),
    ("lettered", lambda c: (c["words"] >= 10) & (10 * c["lettered"] < 8 * c["words"]), lambda c: 100 * c["lettered"] >= 95 * c["words"]),
    ("sentences", lambda c: (c["words"] >= 50) & (100 * c["stops"] < c["words"]), lambda c: 30 * c["stops"] >= c["words"]),
]


def _votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """A row of votes for each text."""
    out = np.full((len(c["words"]), len(LABELLERS)), -1, np.int8)
    for j, (_, bad, good) in enumerate(LABELLERS):
        out[good(c), j] = 1
        out[bad(c), j] = 0
    out[c["words"] == 0] = -1
    return out


def _codes(votes: np.ndarray) -> np.ndarray:
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(votes.shape[1])).sum(1)


def _decoded(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


def _weights(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and value of all entries: words and shapes by their share of the text's words, bands as they are."""
    share = 1.0 / np.maximum(c["words"], 1)
    word = (c["h"] % np.uint64(BUCKETS)).astype(np.int64)
    has = np.flatnonzero(c["words"] > 0)
    levels = [c["symbols"] / np.maximum(c["words"], 1) * 10, c["marks"] / np.maximum(c["solid"], 1) * 40, c["capitals"] / np.maximum(c["solid"], 1) * 10, c["calls"] / np.maximum(c["words"], 1) * 10]
    levels += [c["repeats"] / np.maximum(c["windows"], 1) * 16, c["stutters"] / np.maximum(c["words"], 1) * 16, (1 - c["distinct"] / np.maximum(c["words"], 1)) * 8, (1 - c["lettered"] / np.maximum(c["words"], 1)) * 10, c["stops"] / np.maximum(c["words"], 1) * 30, np.log2(np.maximum(c["words"], 1)) / 2]
    bands = [8 * k + np.minimum(x[has].astype(np.int64), 7) for k, x in enumerate(levels)]
    text = np.concatenate([c["text"], c["text"], *[has] * len(bands)])
    feature = np.concatenate([word, BUCKETS + c["shape"].astype(np.int64), *[BUCKETS + SHAPES + b for b in bands]])
    value = np.concatenate([share[c["text"]], share[c["text"]], np.ones(len(has) * len(bands))])
    return text, feature, value


def _over(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        buf, offsets = W.flat(batch.column("text"))
        for a, b in W.slices(offsets):
            yield batch.column("doc_id").slice(a, b - a), _counts(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, c in _over(batches):
        code, n = np.unique(_codes(_votes(c)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], names=["code", "n"])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, c in _over(batches):
        text, feature, value = _weights(c)
        key, inverse = np.unique(text * FEATURES + feature, return_inverse=True)
        total = np.bincount(inverse, weights=value)
        ends = np.searchsorted(key // FEATURES, np.arange(len(ids) + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in ((key % FEATURES).astype(np.int32), total.astype(np.float32))]
        yield pa.RecordBatch.from_arrays([ids, pa.array(_codes(_votes(c))), *lists], names=["doc_id", "code", "features", "values"])


def accuracies(codes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good texts and the labellers' accuracies on good and on bad ones, by expectation-maximisation."""
    votes = _decoded(codes)
    prior, good, bad = PRIOR, np.full(votes.shape[1], GOOD[0]), np.full(votes.shape[1], BAD[0])
    for _ in range(ROUNDS):
        g = counts * posteriors(codes, prior, good, bad)
        b = counts - g
        prior = (g.sum() + 8) / (counts.sum() + 10)
        good = np.clip(((g[:, None] * (votes == 1)).sum(0) + 8) / ((g[:, None] * (votes >= 0)).sum(0) + 10), GOOD[1], MOST)
        bad = np.clip(((b[:, None] * (votes == 0)).sum(0) + 8) / ((b[:, None] * (votes >= 0)).sum(0) + 10), BAD[1], MOST)
    return prior, good, bad


def posteriors(codes: np.ndarray, prior: float, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    votes = _decoded(codes)
    odds = np.log(prior / (1 - prior)) + ((votes == 1) * np.log(good / (1 - bad)) + (votes == 0) * np.log((1 - good) / bad)).sum(1)
    return 1 / (1 + np.exp(-odds))


def trained(rows: np.ndarray, features: np.ndarray, values: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on soft targets, by full-batch gradient steps with adaptive rates."""
    w, bias, n = np.zeros(FEATURES), 0.0, max(len(target), 1)
    mean, square = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    balance = np.where(target >= 0.5, 0.5 / max(target.mean(), 0.01), 0.5 / max(1 - target.mean(), 0.01)) if len(target) else np.zeros(0)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(rows, weights=values * w[features], minlength=len(target))
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * balance / n
        grad = np.append(np.bincount(features, weights=values * e[rows], minlength=FEATURES) + DECAY * w, e.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _scores(c: dict[str, np.ndarray], model) -> tuple[np.ndarray, np.ndarray]:
    """Of a slice of texts: the posterior of their votes, and the model's probability that they are good."""
    w, bias, em = model
    text, feature, value = _weights(c)
    z = bias + np.bincount(text, weights=value * w[feature], minlength=len(c["words"]))
    return posteriors(_codes(_votes(c)), *em), 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, c in _over(batches):
            weak, p = _scores(c, shared.value)
            yield pa.RecordBatch.from_arrays([ids, pa.array(c["words"].astype(np.int64)), pa.array(weak), pa.array(p)], names=["doc_id", "n_words", "p_weak", "p_quality"])

    return run


def _kept(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [_scores(c, shared.value)[1] for _, c in _over([batch])]
            yield batch.filter(pa.array(np.concatenate(p) >= threshold if p else np.zeros(0, bool)))

    return run


def _texts(df: DataFrame) -> DataFrame:
    return in_small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fitted(df: DataFrame, sample: int = SAMPLE):
    """The model for ``df`` (doc_id, text), sent to the executors: a fixed number of weights."""
    docs = _texts(df)
    found = docs.mapInArrow(_vote, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()  # 3 ** 9 rows at most
    codes, counts = np.array([r.code for r in found], np.int64), np.array([r.n for r in found], np.float64)
    em = accuracies(codes, counts)
    one_in = max(1, int(counts.sum()) // sample)
    chosen = docs.filter("doc_id is not null").filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
    table = chosen.mapInArrow(_featurise, "doc_id long, code long, features array<int>, values array<float>").toArrow()
    table = table.take(np.lexsort((table.column("code").to_numpy(), table.column("doc_id").to_numpy())))
    sizes = pc.list_value_length(table.column("features")).to_numpy()
    at = np.repeat(np.arange(len(table)), sizes)
    features = pc.list_flatten(table.column("features")).to_numpy().astype(np.int64)
    values = pc.list_flatten(table.column("values")).to_numpy().astype(np.float64)
    target = posteriors(table.column("code").to_numpy(), *em)
    return df.sparkSession.sparkContext.broadcast((*trained(at, features, values, target), em))


def classify(df: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): doc_id, n_words, p_weak (posterior of the votes), p_quality (the model's
    probability of a good text) and kept (p_quality at least ``threshold``: only texts held bad with some certainty go)."""
    scored = _texts(df).mapInArrow(_scored(fitted(df, sample)), "doc_id long, n_words long, p_weak double, p_quality double")
    return scored.withColumn("kept", F.col("p_quality") >= threshold)


def keep_good(df: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``df``, with all their columns, that classify() keeps."""
    return df.mapInArrow(_kept(fitted(df, sample), threshold), df.schema)

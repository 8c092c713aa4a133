"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has bit i set where more than half of its shingles' 64-bit hashes have it. Fingerprints that differ in
at most ``max_bits`` bits are linked; linked documents form components.

Search. Bits are dealt into partitions, correlated bits together. If partition i gets the threshold t_i and the sum of
(t_i + 1) is max_bits + 1, two fingerprints within max_bits differ in at most t_i bits of some partition. A dynamic program
allots unequal thresholds, for each number of partitions, so that probes plus estimated candidates cost least; the estimate
comes from the bit frequencies over all fingerprints, so wide partitions with larger thresholds are chosen as the corpus
grows and buckets stay small. Then each distinct fingerprint is looked up by its own bits in a partition, probed with up to
t_i bits flipped, and candidates are verified on all bits inside the join, before any row leaves it.

Copies are one fingerprint, so a group of copies costs one node however large it is. Only 64 x 64 counts go to the driver.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any other; fewer words
than a shingle make one shingle; a null doc_id gets its fingerprint and component but is never a component's name; rows that
repeat a doc_id are linked by each of their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .shared import in_small_batches, written

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: A probe is dealt over the cluster and sorted, a candidate only compared: what one probe costs in candidates.
PROBE_COST = 20.0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprint(text: bytes, shingle: int) -> int:
    """Of a text in lower case."""
    words = text.split()  # bytes are split at space and U+0009 to U+000D
    if not words:
        return 0
    line, k = b" ".join(words), min(shingle, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.concatenate([[0], np.cumsum(size)])
    n = len(words) - k + 1
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 14):  # long texts by parts
        b = min(n, a + (1 << 14))
        part = zip(start[a:b].tolist(), (start[a + k : b + k] - 1).tolist(), strict=True)
        h = np.fromiter((hashed(line[x:y], SEED) for x, y in part), np.uint64, b - a)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = W.flat(batch.column("text"))
            out = np.zeros(batch.num_rows, np.uint64)
            for a, b in W.slices(offsets):
                part = _LOWER[buf[offsets[a] : offsets[b]]].tobytes()
                o = (offsets[a : b + 1] - offsets[a]).tolist()
                for i in range(b - a):
                    out[a + i] = _fingerprint(part[o[i] : o[i + 1]], shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for each row of ``df`` (doc_id, text)."""
    docs = in_small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often bits i and j are both set, over a task's rows."""
    n = np.zeros((64, 64), np.int64)
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        for a in range(0, len(fp), 1 << 14):
            bits = np.unpackbits(np.ascontiguousarray(fp[a : a + (1 << 14)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n += np.rint(bits.T @ bits).astype(np.int64)
    i, j = np.triu_indices(64)
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n[i, j])], names=["i", "j", "n"])


def grouped(correlation: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m groups of near equal size: each takes, one by one, the free bit that correlates most with it."""
    strength, free, groups = np.abs(correlation), set(range(len(correlation))), []
    for k in range(m):
        room = len(free) // (m - k) + (len(free) % (m - k) > 0)
        group: list[int] = []
        while len(group) < room:
            among = group or sorted(free)
            group.append(max(sorted(free), key=lambda b: strength[b, [x for x in among if x != b]].sum()))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def within(group: list[int], differ: np.ndarray, most: int) -> np.ndarray:
    """Probability that two fingerprints differ in 0, 1, ... ``most`` bits of a group at most, bits taken as independent."""
    exactly = np.zeros(most + 1)
    exactly[0] = 1
    for b in group:
        exactly = exactly * (1 - differ[b]) + np.concatenate([[0], exactly[:-1]]) * differ[b]
    return np.cumsum(exactly)


def ball(width: int, most: int) -> np.ndarray:
    """How many keys of ``width`` bits differ from one in 0, 1, ... ``most`` bits at most."""
    return np.cumsum([float(np.prod([(width - i) / (i + 1) for i in range(e)])) for e in range(most + 1)])


def cheapest(options: list[list[tuple[int, float]]], need: int) -> tuple[float, list[int]] | None:
    """One option of each group, as (gain, cost), so that gains add up to ``need`` or more at least cost: that cost and the
    options' numbers. None if they can't."""
    best: dict[int, tuple] = {0: (0.0, None)}  # by gain: cost, and the choices as a chain from the last one
    for group in options:
        step: dict[int, tuple] = {}
        for have, (c, chain) in best.items():
            for k, (gain, cost) in enumerate(group):
                got, x = min(need, have + gain), c + cost
                if got not in step or x < step[got][0]:
                    step[got] = (x, (k, chain))
        best = step
    if need not in best:
        return None
    cost, chain = best[need]
    taken = []
    while chain:
        k, chain = chain
        taken.append(k)
    return cost, taken[::-1]


def allotted(groups: list[list[int]], differ: np.ndarray, rows: int, max_bits: int) -> tuple[float, list[int]]:
    """The thresholds (-1: not looked at) of least cost whose (t + 1) add up to max_bits + 1, and that cost."""
    options = []
    for group in groups:
        costs = PROBE_COST * rows * ball(len(group), max_bits) + rows * rows / 2 * within(group, differ, max_bits)
        options.append([(0, 0.0), *((t + 1, c) for t, c in enumerate(costs))])
    cost, taken = cheapest(options, max_bits + 1)
    return cost, [k - 1 for k in taken]


def correlated(together: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The correlation of each two bits, and how often two fingerprints differ in each, from how often bits are both set."""
    p = np.diag(together) / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return (together / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread), 2 * p * (1 - p)


def plan(together: np.ndarray, rows: int, max_bits: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, the cheapest over all numbers of groups."""
    correlation, differ = correlated(together, rows)
    found = [(*allotted(g, differ, rows, max_bits), g) for g in (grouped(correlation, m) for m in range(1, max_bits + 4))]
    _, thresholds, groups = min(found, key=lambda x: x[0])
    return [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]


def _probe(k: int, part: Column):
    return lambda flip: F.struct(F.lit(k).alias("part"), part.bitwiseXOR(flip).alias("key"))


def linked(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of representatives of the distinct fingerprints in ``nodes`` (fp, rep) that differ in 1 to max_bits bits."""
    counts = nodes.mapInArrow(_together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()  # 2,080 rows at any size
    together = np.zeros((64, 64))
    for r in counts:
        together[r.i, r.j] = together[r.j, r.i] = r.n
    index, probes = [], []
    for k, (group, t) in enumerate(plan(together, nodes.count(), max_bits)):
        part = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))
        flips = [_signed(sum(1 << b for b in c)) for e in range(t + 1) for c in combinations(group, e)]
        index.append(F.struct(F.lit(k).alias("part"), part.alias("key")))
        many = F.from_json(F.lit(str(flips)), "array<long>")  # folded to one literal
        probes.append(F.transform(many, _probe(k, part)))
    left = nodes.select("fp", "rep", F.explode(F.array(*index)).alias("s")).select(F.col("fp").alias("fp_a"), F.col("rep").alias("a"), "s.part", "s.key")
    right = nodes.select("fp", "rep", F.explode(F.concat(*probes)).alias("s")).select(F.col("fp").alias("fp_b"), F.col("rep").alias("b"), "s.part", "s.key")
    near = (F.col("fp_a") < F.col("fp_b")) & (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= max_bits)
    same = (left.part == right.part) & (left.key == right.key)
    return left.join(right, same & near).select("a", "b")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): doc_id, fp, component_id (least doc_id reached by links, itself included)."""
    prints = written(fingerprints(df, shingle), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    found = components(linked(nodes, max_bits))
    named = nodes.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")

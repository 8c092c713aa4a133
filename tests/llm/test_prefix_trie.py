"""The prefix trie against a dictionary of prefixes, with nulls, copies, deep shared prefixes and several cuts into shards."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from factlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        leader = c - (c % 20 if c >= 0 else -(-c % 20))
        path = own.get(leader, [])[:h] + ts[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    below = defaultdict(list)
    for p in members:
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    saved = {p: (len(m) - 1) * len(WORDS.findall(p[-1][1])) if p else 0 for p, m in members.items()}
    out = []
    for p, m in members.items():
        up = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
        out.append((min(m), len(p), up, len(m), children[p], sum(not children[q] for q in below[p]), sum(saved[q] for q in below[p]), sha))
    return sorted(out, key=str)


def run(spark, rows, n=3):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(n)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    return sorted([tuple(r[c] for c in columns) for r in prefix_trie.prefix_trie(df).collect()], key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    turns = [(rng.choice(["user", "assistant", None, ""]), " ".join(rng.choice("ab cd") for _ in range(rng.randint(0, 6)))) for _ in range(12)] + [("u", None), ("user", "x " * 400)]
    deep = [("user", f"turn {i}") for i in range(60)]
    out = []
    for c in range(220):
        own = [rng.choice(turns) for _ in range(rng.randint(1, 5))] if rng.random() < 0.6 else turns[:2] * rng.randint(1, 3)
        out += [(c, i, *t) for i, t in enumerate(own)]
    for c in range(400, 440):
        out += [(c, i, *t) for i, t in enumerate(deep[: rng.choice([55, 59, 60])] + rng.choices(turns, k=rng.randint(0, 2)))]
    for c in range(460, 620):  # a third of all: copies
        out += [(c, 3 * i, *t) for i, t in enumerate(turns[:3])]
    out += [(-7, 1, "a", "neg"), (-20, 1, "a", "neg"), (-20, None, "b", "null first"), (-20, None, "a", "tie"), (-20, None, "a", "tie"), (None, 1, "a", "b"), (10**15 + 1, 1, "a", "lone")]
    return out


@pytest.mark.parametrize("shards", ["1", "4", "37"])
def test_trie_matches_brute_force(spark, rows, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_edges(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "a", "b")]) == []
    lone = [(1, 0, None, None)]
    assert run(spark, lone) == brute(lone)
    turnless = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert run(spark, [(turnless, 0, "a", "b")]) == brute([(turnless, 0, "a", "b")]) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_double_array_keeps_siblings_apart():
    rng = np.random.default_rng(0)
    seqs = sorted({tuple(rng.integers(0, 30, rng.integers(0, 6))) for _ in range(3000)})
    cut = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    ids = np.array([t for s in seqs for t in s], np.int64)
    trie = prefix_trie.DoubleArray(ids, cut)
    nodes = np.concatenate(trie.levels)
    assert len(nodes) == len(set(nodes.tolist())) == len({s[:d] for s in seqs for d in range(len(s) + 1)}) and len(set(trie.end.tolist())) == len(seqs)
    assert trie.top < 2 * len(nodes)  # packed
    where = {}
    for depth, who, at in trie.walk(ids, cut):
        for i, s in zip(who, at, strict=True):
            assert where.setdefault(int(s), seqs[i][:depth]) == seqs[i][:depth]

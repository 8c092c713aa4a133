"""Ranked lexical search against a plain scan, with nulls, ties, repeated rows, long items and small blocks."""

import random
import re
from collections import Counter
from math import floor, log

import pytest

from factlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, item_id int, score long, term string", "item_id long, text string, doc_id int, n int"


def found(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    terms = [(i, found(t)) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    n, length = len(terms), sum(len(t) for _, t in terms)
    df = Counter(x for _, t in terms for x in set(t))
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(found(t))
    out = []
    for i, want in asked.items():
        scores = []
        for d, t in terms:
            tf, m = Counter(t), 50 + 50 * len(t) * n // length
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[x] + 1))) * (1000000000 * tf[x] // (1000 * tf[x] + 20 * m)) for x in want if tf[x])
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, k):
    d = spark.createDataFrame([(*r, 1, 2, "x") for r in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS).repartition(2)
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in lexical.ranked(d, q, k).collect()], key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Été", "ÉTÉ", "日本", "A1b2", "x"]
    text = lambda n: rng.choice([" ", "-", "\x00"]).join(rng.choice(words[: rng.choice([20, 305])]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(400)] + [(500, "W1 w1 w2"), (500, "W1 w1 w2"), (500, "w3"), (None, "w1 w2"), (None, "w1 w2"), (501, None), (502, ""), (503, "--- \t"), (504, text(20000))]
    docs += [(600 + i, "w5 w6 w7") for i in range(80)]
    items = [(i, text(rng.randint(1, 30))) for i in range(20)] + [(30, "w5, W6"), (30, "w7"), (31, None), (32, "..."), (None, "w1"), (33, "nowhere"), (34, " ".join(words))]
    return docs, items


@pytest.mark.parametrize(("block", "most"), [(1 << 16, 1 << 20), (37, 1 << 20), (1 << 16, 100)])
def test_ranked_matches_brute_force(spark, tables, monkeypatch, block, most):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "MOST_TERMS", most)
    for k in (50, 3):
        assert run(spark, *tables, k) == brute(*tables, k)


def test_ranked_empty(spark, tables):
    docs, items = tables
    assert run(spark, [], items, 5) == [] and run(spark, docs, [], 5) == [] and run(spark, [(1, None)], items, 5) == []


def test_lengths_beyond_64_bits():
    import numpy as np

    n = np.array([3, 10**9], np.int64)
    assert lexical._length_part(n, 10**10, 10**12).tolist() == [50 + 50 * int(x) * 10**10 // 10**12 for x in n]

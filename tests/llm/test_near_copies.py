"""The pipeline's near-copy stage against brute force."""

import random

import corpus_pipeline
from factlake.llm import near_copies

WORDS = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in "nrst"]


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_copies(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "one two", "One  two"]
    for size in (40, 60, 150, 400):
        for _ in range(6):
            base = [rng.choice(WORDS) for _ in range(size)]
            for edits in (0, 1, 1, 2, 3, 4, 6):  # similarities around 0.8
                copy = list(base)
                for i in rng.sample(range(size), edits * size // 150 + (edits > 0)):
                    copy[i] = "edit" + str(rng.random())
                texts.append(" ".join(copy))
    base = [rng.choice(WORDS) for _ in range(200)]  # a large group, most of it similar to few of the others
    for _ in range(150):
        copy = list(base)
        for i in rng.sample(range(200), rng.randint(1, 8)):
            copy[i] = "edit" + str(rng.random())
        texts.append(" ".join(copy))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    sets, parent = {i: shingles(t) for i, t in zip(ids, texts, strict=True)}, {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = 0
    for a in ids:
        for b in ids:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                pairs += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert pairs > 500
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts, strict=True)], schema).repartition(3)
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in ids if root(i) == i)
    twice = [(1, "a b c d e f g h", "x"), (2, "a b c d e f g h", "x"), (2, "its own text is another", "x"), (None, "a b c d e f g h", "x")]
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(twice, schema), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, twice[3][1]), (1, twice[0][1]), (2, twice[2][1])]


def test_families_below_the_similarity_make_few_pairs(spark, monkeypatch):
    rng, seen = random.Random(8), {}
    base = [rng.choice(WORDS) + str(rng.randint(0, 50)) for _ in range(300)]
    rows = []
    for i in range(300):  # pairs have a similarity of 0.67 or so
        copy = list(base)
        for k in range(3, 300, 50):
            copy[k + rng.randint(0, 40)] = f"edit{i}-{k}"
        rows.append((i, " ".join(copy)))

    def written(df, what):
        out = near_copies_written(df, what)
        seen[what] = out.count()
        return out

    near_copies_written = near_copies.written
    monkeypatch.setattr(near_copies, "written", written)
    found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = {i: shingles(t) for i, t in rows}
    assert not any(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for a in sets for b in sets if a < b)
    assert all(r.doc_id == r.first for r in found) and len(found) == 300
    assert sum(n for what, n in seen.items() if what.endswith("-pairs")) <= 20 * 300

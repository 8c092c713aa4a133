"""Near copies among embeddings against all pairs: clusters of several widths, copies, odd vectors, many small blocks."""

import numpy as np
import pytest

from factlake.llm import embedding_dups as E

SCHEMA = "vec_id long, embedding array<double>, n long, cell long, d int, label int"


def brute(rows, cosine=0.9):
    good = [i for i, (_, e) in enumerate(rows) if e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    x = {i: np.array(rows[i][1], float) for i in good}
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            if i < j and len(x[i]) == len(x[j]) and E.exact_cosine(x[i], x[j]) >= cosine:
                links[i].add(j)
                links[j].add(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(links[j]), low, rows[j][0] is not None and rows[j][0] == low)
    return sorted(out, key=str)


def run(spark, rows, n=3):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(n)
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()], key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x)
    out = [rng.standard_normal(16) for _ in range(300)]
    for width, many in ((0.02, 120), (0.08, 60), (0.2, 150), (0.35, 150)):  # from tight to partly linked
        c = unit(rng.standard_normal(16))
        out += [(c + width * unit(rng.standard_normal(16)) * rng.random()) * rng.uniform(0.1, 9) for _ in range(many)]
    a, b = unit(rng.standard_normal(16)), unit(rng.standard_normal(16))
    out += [(1 - t) * a + t * b for t in np.linspace(0, 1, 40)]  # a chain
    rows = [(1000 + i, v.tolist()) for i, v in enumerate(out)]
    rows += [(3000 + i, rows[5][1]) for i in range(200)]  # copies
    rows += [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1e200, 2e200]), (4, [1e-200, 2e-200]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [-1.0, 0.0])]
    rows += [(6, None), (7, []), (8, [0.0, 0.0]), (9, [float("nan"), 1.0]), (10, [None, 1.0]), (11, [float("inf"), 1.0]), (None, [1.0, 2.0]), (None, [0.0, -3.0]), (None, None), (12, [3.0])]
    return rows


@pytest.mark.parametrize(("block", "centres"), [(8192, 1024), (64, 1024), (50, 3)])
def test_links_match_all_pairs(spark, rows, monkeypatch, block, centres):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "CENTRES", centres)
    assert run(spark, rows) == brute(rows)


def test_empty_and_lone(spark):
    assert run(spark, []) == []
    assert run(spark, [(4, [1.0, 1.0])]) == [(4, 0, 4, True)] and run(spark, [(4, None)]) == [(4, 0, 4, True)]


def test_leaders_cover_and_keep_apart():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    owner = E.leaders(x, 0.5)
    lead = np.unique(owner)
    apart = np.linalg.norm(x[lead][:, None] - x[lead][None], axis=2) + 9 * np.eye(len(lead))
    assert (np.linalg.norm(x - x[owner], axis=1) <= 0.5 + 1e-9).all() and (owner[lead] == lead).all() and apart.min() > 0.5 - 1e-9

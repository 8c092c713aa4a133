"""Nearest neighbours of equal and nearly equal scores."""

import numpy as np

from factlake.llm import ann


def test_nearest_of_many_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 16))
    ids = rng.permutation(3000)
    ids[0], ids[np.flatnonzero(ids == 1000)[0]] = 1000, ids[0]  # the query
    x[0] /= np.linalg.norm(x[0])
    x[1:401] = 9 * x[0]  # several hundred equal nearest vectors
    x[401:701] = 9 * x[0] * (1 - 1e-9 * np.arange(1, 301)[:, None])  # equal in single precision, not in double
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    got = ann.nearest(frame, lambda v: v == 1000).orderBy("rank").collect()
    assert [r.vec_id for r in got] == sorted(ids[1:401].tolist())[:20]
    few = ann.nearest(frame.filter(~frame.vec_id.isin(sorted(ids[1:401].tolist())[10:])), lambda v: v == 1000).orderBy("rank").collect()
    assert [r.vec_id for r in few] == sorted(ids[1:401].tolist())[:10] + ids[401:411].tolist()


def test_a_repeated_query_asks_once(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(1, 41)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), lambda v: v == 0).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(i + 1, 40 - i, 42.0 - i) for i in range(20)]

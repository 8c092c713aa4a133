"""Archives, nearest neighbours, the registered queries against their SQL, and the pipeline."""

import hashlib
import os
import tempfile

import duckdb
import numpy as np

from factlake.llm import ann, queries, warc

SF = "/root/testdata/sf0.001"


def test_warc(spark):
    big = "x" * 1500
    rows = [(1, "http://a/", big), (2, "http://b/", big), (2, "http://b/", big), (3, None, None), (4, "http://c\n/", "é" * 600), (5, "u", "é" * 600), (None, "n", big), (7, "s", "short"), (8, "s", "short"), (None, None, "q" * 2000), (9, "t", "")]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, shard int, sha string")
    made = []
    for n in (1, 5):
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/w"
        manifest = warc.write(pages.repartition(n), "file://" + root, file_bytes=600)
        files = {f: hashlib.sha256(open(f"{root}/{f}", "rb").read()).hexdigest() for f in os.listdir(root) if f.endswith(".gz")}
        assert {r.file: r.sha256 for r in manifest.collect()} == files and len(files) > 1 and not os.path.exists(f"{root}/_temporary")
        made.append(files)
        got = sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(spark, "file://" + root).collect()], key=str)
        sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
        kind = {1: ("revisit", 2), 4: ("revisit", 5)}
        expected = [(p, len((t or "").encode()), sha(t), *kind.get(p, ("response", None))) for p, _, t in rows]
        expected[2] = (2, 1500, sha(big), "revisit", 2)
        expected[6] = (None, 1500, sha(big), "revisit", 2)
        assert got == sorted(expected, key=str)
    assert made[0] == made[1]
    root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/w"
    assert warc.write(pages.limit(0), root).count() == 0 and warc.read(spark, root).count() == 0


def test_warc_ids_are_unique_and_referred_to(spark):
    rows = [(None, "n", "a" * 1200), (None, "n", "b" * 1200), (None, "m", "b" * 1200), (2, "p", "b" * 1200), (2, "p", "c"), (2, "p", "c"), (2, "q", "d" * 3_000_000), (1, "q", "d" * 3_000_000)]
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/w"
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), "file://" + root)
    found = [h for f in sorted(os.listdir(root)) if f.endswith(".gz") for h, _ in warc.records(open(f"{root}/{f}", "rb").read())]
    ids = [h["warc-record-id"] for h in found]
    responses = {h["warc-record-id"]: h["warc-payload-digest"] for h in found if h["warc-type"] == "response"}
    revisits = [(h["warc-refers-to"], h["warc-payload-digest"]) for h in found if h["warc-type"] == "revisit"]
    assert len(set(ids)) == len(ids) and len(revisits) == 3 and all(responses[to] == digest for to, digest in revisits)


def test_warc_shards_roll_and_split_a_page(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 1 << 18)
    rng = np.random.default_rng(1)
    rows = [(i if i % 3 else 5, "u", "".join(map(chr, rng.integers(32, 127, 3000)))) for i in range(600)]  # a third of one page
    made = []
    for n in (1, 4):
        root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/w"
        manifest = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(n), root).collect()
        made.append(sorted((r.file, r.sha256) for r in manifest))
        shards = {r.shard for r in manifest}
        assert len(shards) > 4 and len(manifest) > 3 * len(shards) and max(r.records for r in manifest) < 60
        got = sorted((r.page_id, bytes(r.payload).decode()) for r in warc.read(spark, root).collect())
        assert got == sorted((p, t) for p, _, t in rows)
    assert made[0] == made[1]


def test_warc_reader_is_linear():
    import time

    page = " ".join(map(str, np.random.default_rng(2).random(100))).encode()
    data = b"".join(warc.record(i, hashlib.sha256(page).digest(), 0, "u", page, None, False) for i in range(16000))
    began = time.process_time()
    assert sum(1 for _ in warc.records(data)) == 16000 and time.process_time() - began < 8  # well below a second where nothing else runs


def test_nearest_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = ann.nearest(frame, lambda v: v % 50 == 0).toPandas()
    hits = 0
    for q, own in got.groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & set(own["vec_id"]))
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own["score"], x[own["vec_id"]] @ x[q], rtol=1e-12) and (np.diff(own["score"]) <= 0).all()
    assert hits / (20 * 60) >= 0.9


def test_nearest_edges(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [None, 1.0]), (1, [2.0, 2.0]), (1, [2.0, 2.0]), (2, [2.0, 2.0]), (100, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (3, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(frame, lambda v: v % 20 == 0).orderBy("rank").collect()] == [(0, 1, 1, 6.0), (0, 2, 1, 6.0), (0, 3, 2, 6.0)]
    assert ann.nearest(frame.limit(0), lambda v: v % 20 == 0).count() == 0


def test_queries_match_sql(spark):
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    rows = lambda f: sorted(map(str, f[sorted(f.columns)].astype(object).where(f[sorted(f.columns)].notna(), None).values.tolist()))
    for name, sql in queries.SQL.items():
        a, b = queries.QUERIES[name](spark, SF).toPandas(), con.execute(sql).df()
        clean = lambda x: x.replace(".0,", ",").replace(".0]", "]")
        assert list(map(clean, rows(a))) == list(map(clean, rows(b))), name


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0

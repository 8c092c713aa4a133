"""The pipeline's line stage against brute force."""

import random
import re

import corpus_pipeline
from factlake.llm import line_dedup


def test_runs_of_repeated_lines_go_whole(spark):
    rng = random.Random(8)
    line = lambda: " ".join(rng.choice("abcdefgh") * 3 for _ in range(6))
    shared = [[line() for _ in range(n)] for n in (2, 2, 3, 4, 7, 20)] + [["", " "], ["x", ""]]
    texts = [None, "", "one", "x\nx\nx\nx", "a\n\n\nb\n\n\nb"]
    for _ in range(80):
        parts = [[line() for _ in range(rng.randint(0, 3))] for _ in range(4)] + rng.sample(shared, rng.randint(0, 3))
        rng.shuffle(parts)
        texts.append("\n".join(x for p in parts for x in p))
    texts += texts[5:15]
    seen, expected, whole = set(), {}, 0
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        gone = [False] * len(lines)
        for a in range(len(lines) - 1):
            if lines[a].strip() or lines[a + 1].strip():
                if (lines[a], lines[a + 1]) in seen:
                    gone[a] = gone[a + 1] = True
                seen.add((lines[a], lines[a + 1]))
        whole += sum(gone)
        expected[i] = None if t is None else "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
    assert whole > 300
    schema = "doc_id long, text string, lang string"
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    kept = corpus_pipeline.lines(spark, spark.createDataFrame(rows, schema).repartition(3), "")
    assert kept.columns == ["doc_id", "text", "lang"] and {r.doc_id: r.text for r in kept.collect()} == expected
    odd = [(1, "k l\nm n", "x"), (2, "k l\nm n\no p", "x"), (2, "q", "x"), (None, "k l\nm n", "x")]
    kept = corpus_pipeline.lines(spark, spark.createDataFrame(odd, schema), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "k l\nm n"), (1, "k l\nm n"), (2, "o p"), (2, "q")]


def test_the_stage_searches_chunks_first(spark, monkeypatch):
    """Repeats come from content-defined chunks, and the exact search has only the pairs of lines that these leave."""
    left, pairs_of = [], line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, what: left.append((what, pairs_of(df, what))) or left[-1][1])
    text = "\n".join(f"line {i} of it" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "a b\n" + text + "\nc d"), (4, "line 1 of it\nline 2 of it")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert kept == {1: text, 2: "", 3: "a b\nc d", 4: ""}
    found = dict(left)
    assert {r.doc_id for r in found["chunk-spans"].collect()} >= {2, 3} and found["repeated-pairs"].count() < 10


def test_texts_are_not_dealt_out_for_pairs(spark, monkeypatch):
    """Between the search for chunks and the last join no exchange carries a text, nor are pairs made anew from texts."""
    plans, write = {}, line_dedup.written

    def noted(df, what):
        plans[what] = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return write(df, what)

    monkeypatch.setattr(line_dedup, "written", noted)
    docs = spark.createDataFrame([(i, "a b\nc d\ne f\ng h\n" + "x\n" * i) for i in range(4)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        corpus_pipeline.lines(spark, docs, "")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for what in ("line-pairs", "repeated-pairs", "line-spans"):
        carried = re.findall(r"\) Exchange\s+Input \[\d+\]: \[(.*?)\]", plans[what])
        assert carried and not [c for c in carried if "text#" in c], what
    assert "text#" not in plans["repeated-pairs"] + plans["line-spans"]

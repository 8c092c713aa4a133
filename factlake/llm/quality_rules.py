"""Quality rules as weak supervision, in DataFrame functions only.

Eight rules look at a text's counts and vote good (1), bad (0) or abstain (-1). Expectation-maximisation estimates from their
agreement alone how common good texts are and how accurate each rule is on good and on bad texts; a text's posterior
probability of being good, given its votes, replaces the demand that all rules pass. Two base conditions stay hard: fewer than
ten words, or more than a fifth of the words in repeated five-word windows.

The texts are read once: counts and votes are written, a few numbers a row. The estimation needs no more than the number of
texts with each combination of votes, at most 3 ** 8 rows at any size, and runs as one SQL expression over them.

Defined results: a null or empty text has no words and fails the base; an empty table gives no rows; null doc_ids and repeated
rows are judged like any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expressions import WORD, let, words
from .shared import written

REPEAT_WINDOW = 5
#: Rounds of the estimation, the share of good texts that it starts from, and the pseudo-counts of right and wrong votes.
ROUNDS, PRIOR, RIGHT, WRONG = 20, 0.8, 8.0, 2.0
#: Where accuracies start, on good and on bad texts, and the bounds that they keep. A rule is better than chance on good texts,
#: which fixes which class is the good one; a bad text has few faults, so most rules miss it.
GOOD, BAD, MOST = (0.97, 0.9), (0.4, 0.02), 0.999
#: Each rule: its name, when it votes bad, when it votes good (of what is left); SQL that Spark and others read alike.
RULES = [
    ("length", "n_words < 10", "n_words >= 50"),
    ("marks", "100 * n_marks > 9 * word_chars", "100 * n_marks <= 7 * word_chars and n_words > 0"),
    ("symbols", "10 * n_symbols > n_words", "n_symbols = 0 and n_words > 0"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 and n_lines > 1"),
    ("repetition", "10 * n_repeat_words > n_words", "n_repeat_words = 0 and n_words > 0"),
    ("exclamation", "10 * n_exclamations > n_words", "n_exclamations = 0 and n_words > 0"),
    ("sentences", "n_words > 50 and 100 * n_stops < n_words", "30 * n_stops >= n_words and n_words > 0"),
    ("capitals", "100 * n_capitals > 40 * word_chars", "100 * n_capitals <= 20 * word_chars and n_words > 0"),
]
#: ASCII punctuation.
MARKS = "[!-/:-@\\[-`{-~]"
BASE = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def _repeated(w: Column, k: int = REPEAT_WINDOW) -> Column:
    """How many words lie in windows of k words that are found twice or more; windows are compared by 64-bit hashes."""

    def of_windows(g: Column) -> Column:
        def marked(s: Column) -> Column:
            """Places of windows that have an equal neighbour in the sorted order."""
            twin = lambda x, i: ((i > 0) & (F.get(s, i - 1)["g"] == x["g"])) | ((i < F.size(s) - 1) & (F.get(s, i + 1)["g"] == x["g"]))
            return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        add = lambda acc, i: F.struct((acc["n"] + i + k - F.greatest(acc["end"], i)).alias("n"), (i + k).alias("end"))
        covered = F.aggregate(marked_once(marked, g), start, add, lambda acc: acc["n"])
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered)

    def marked_once(marked, g: Column) -> Column:
        return let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))), marked)

    windows = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
    return F.when(F.size(w) < k, 0).otherwise(let(let(F.transform(w, lambda x: F.xxhash64(x)), windows), of_windows))


def counts(df: DataFrame) -> DataFrame:
    """doc_id and the counts of each text that the rules look at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    of_words = lambda w: F.struct(F.size(w).alias("n"), F.char_length(F.array_join(w, "")).alias("chars"), _repeated(w).alias("repeat"))
    of_lines = lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    found = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        let(words(text), of_words).alias("w"),
        let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), of_lines).alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("symbols"),
        F.regexp_count(text, F.lit("!")).alias("exclamations"),
        F.regexp_count(text, F.lit("[.?]")).alias("stops"),
        F.regexp_count(text, F.lit(MARKS)).alias("marks"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("capitals"),
    )
    columns = {"n_words": "w.n", "word_chars": "w.chars", "n_symbols": "symbols", "n_dup_lines": "l.dup", "n_repeat_words": "w.repeat", "n_lines": "l.n", "n_exclamations": "exclamations", "n_stops": "stops", "n_marks": "marks", "n_capitals": "capitals"}
    return found.select("doc_id", *[F.col(c).cast("long").alias(n) for n, c in columns.items()])


def votes() -> Column:
    return F.array(*[F.when(F.expr(bad), 0).when(F.expr(good), 1).otherwise(-1) for _, bad, good in RULES])


def estimate(patterns: DataFrame) -> DataFrame:
    """One row, ``p`` (prior, good: accuracies on good texts, bad: on bad texts), from ``patterns`` (v: votes, n: texts)."""
    m = len(RULES)
    each = F.sequence(F.lit(0), F.lit(m - 1))
    zero = F.lit(0.0)

    def total(items: Column, value) -> Column:
        return F.aggregate(items, zero, lambda s, x: s + value(x))

    def step(p: Column, _: Column) -> Column:
        gains = F.transform(each, lambda j: F.struct(F.log(F.get(p["good"], j) / (1 - F.get(p["bad"], j))).alias("yes"), F.log((1 - F.get(p["good"], j)) / F.get(p["bad"], j)).alias("no")))

        def shares(w: Column) -> Column:
            def share(t: Column) -> Column:
                odds = F.log(p["prior"] / (1 - p["prior"])) + total(each, lambda j: F.when(F.get(t["v"], j) == 1, F.get(w, j)["yes"]).when(F.get(t["v"], j) == 0, F.get(w, j)["no"]).otherwise(zero))
                return let(1 / (1 + F.exp(-odds)), lambda r: F.struct(t["v"].alias("v"), (t["n"] * r).alias("g"), (t["n"] * (1 - r)).alias("b")))

            return F.transform(F.col("patterns"), share)

        def params(s: Column) -> Column:
            def accuracy(kind: str, vote: int, least: float):
                def of(j: Column) -> Column:
                    right = total(s, lambda t: F.when(F.get(t["v"], j) == vote, t[kind]).otherwise(zero))
                    voted = total(s, lambda t: F.when(F.get(t["v"], j) >= 0, t[kind]).otherwise(zero))
                    return F.least(F.greatest((right + RIGHT) / (voted + RIGHT + WRONG), F.lit(least)), F.lit(MOST))

                return F.transform(each, of)

            good, bad = total(s, lambda t: t["g"]), total(s, lambda t: t["b"])
            return F.struct(((good + RIGHT) / (good + bad + RIGHT + WRONG)).alias("prior"), accuracy("g", 1, GOOD[1]).alias("good"), accuracy("b", 0, BAD[1]).alias("bad"))

        return let(let(gains, shares), params)

    begin = F.struct(F.lit(PRIOR).alias("prior"), F.array_repeat(F.lit(GOOD[0]), m).alias("good"), F.array_repeat(F.lit(BAD[0]), m).alias("bad"))
    whole = patterns.agg(F.array_sort(F.collect_list(F.struct("v", F.col("n").cast("double").alias("n")))).alias("patterns"))
    return whole.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step).alias("p"))


def posterior(v: Column, p) -> Column:
    """Probability of a good text given its votes; ``p`` is the row that estimate() gives."""
    import math

    odds = F.lit(math.log(p["prior"] / (1 - p["prior"])))
    for j, (a, b) in enumerate(zip(p["good"], p["bad"], strict=True)):
        odds = odds + F.when(F.get(v, F.lit(j)) == 1, math.log(a / (1 - b))).when(F.get(v, F.lit(j)) == 0, math.log((1 - a) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): doc_id, the counts, votes, base_failed, p_quality and kept."""
    seen = written(counts(df).withColumn("votes", votes()), "quality-counts")
    p = estimate(seen.groupBy(F.col("votes").alias("v")).agg(F.count(F.lit(1)).alias("n"))).first()["p"]  # one row of 17 numbers
    judged = seen.withColumn("base_failed", F.expr(BASE)).withColumn("p_quality", posterior(F.col("votes"), p))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= threshold))


def sql() -> str:
    """DuckDB SQL for the rows of op1_quality_rules."""
    m = range(len(RULES))
    votes_sql = ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END AS v{j}" for j, (_, bad, good) in enumerate(RULES))
    vs = ", ".join(f"v{j}" for j in m)

    def odds(p: str) -> str:
        terms = [f"CASE v{j} WHEN 1 THEN ln({p}.a{j} / (1 - {p}.b{j})) WHEN 0 THEN ln((1 - {p}.a{j}) / {p}.b{j}) ELSE 0.0 END" for j in m]
        return f"1 / (1 + exp(-(ln({p}.prior / (1 - {p}.prior)) + {' + '.join(terms)})))"

    steps = []
    for k in range(ROUNDS):
        acc = []
        for j in m:
            for name, kind, vote, least in (("a", "g", 1, GOOD[1]), ("b", "b", 0, BAD[1])):
                acc.append(f"least(greatest((coalesce(sum({kind}) FILTER (v{j} = {vote}), 0) + {RIGHT}) / (coalesce(sum({kind}) FILTER (v{j} >= 0), 0) + {RIGHT + WRONG}), {least}), {MOST}) AS {name}{j}")
        steps.append(f"""p{k + 1} AS MATERIALIZED (SELECT (sum(g) + {RIGHT}) / (sum(g) + sum(b) + {RIGHT + WRONG}) AS prior, {', '.join(acc)}
  FROM (SELECT {vs}, n * r AS g, n * (1 - r) AS b FROM (SELECT {vs}, n, {odds(f'p{k}')} AS r FROM patterns, p{k})))""")
    start = ", ".join(f"{GOOD[0]}::DOUBLE AS a{j}, {BAD[0]}::DOUBLE AS b{j}" for j in m)
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_extract_all(coalesce(text, ''), '{WORD}+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM documents),
  g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM t)),
  twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
  rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, generate_series(0, 4) AS s(j) GROUP BY doc_id),
  c AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
    len(regexp_extract_all(text, '!'))::BIGINT AS n_exclamations, len(regexp_extract_all(text, '[.?]'))::BIGINT AS n_stops,
    len(regexp_extract_all(text, '{MARKS}'))::BIGINT AS n_marks, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals FROM t LEFT JOIN rep USING (doc_id)),
  v AS MATERIALIZED (SELECT *, {votes_sql} FROM c),
  patterns AS MATERIALIZED (SELECT {vs}, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
  p0 AS MATERIALIZED (SELECT {PRIOR}::DOUBLE AS prior, {start}),
  {', '.join(steps)},
  j AS (SELECT v.*, ({BASE}) AS base_failed, {odds(f'p{ROUNDS}')} AS p FROM v, p{ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND p >= 0.5) AS kept, round(p * 1000000)::BIGINT AS quality_ppm FROM j"""

"""Line deduplication over content-defined chunks, in DataFrame functions only.

A rolling hash over the last ``ROLL`` line hashes of a text says where it may be cut: after each line at which the hash, of the
order of the lines too, lies in the lowest ``divisor``-th of its range. Cuts depend on nearby lines alone, so they come back
after any shift. A chunk begins at each cut (and at the text's first line) and ends at the first cut at least two lines on (or
at the last line), so no line is left alone in a chunk. A chunk with a word that is found before (in a document of smaller
doc_id, or earlier in the same one) is removed, together with the lines before and after it that equal those around the first
place, as far as the chunks that end and begin there reach.

1. Chunk hashes and places (no text) are counted, pre-aggregated before the shuffle; hashes found once drop out.
2. The chunks left are cut out of their texts, with 128 bits of the SHA-256 of each line around them, and grouped by their bytes, so
   that a chunk's equality does not rest on a hash; the first place of each stays. The others meet it by the SHA-256 of the bytes
   alone, and are extended by lines whose 128 bits agree.
3. Texts lose the union of what is found. Texts are dealt out once, for both steps.

Runs of repeated lines that hold no whole chunk are not found; ``repeats_removed`` then finds them too, exactly.

Defined results: null texts stay null and have no lines; an empty text is one line; rows with null doc_id are not compared and
stay as they are. A document is a doc_id with a text: rows that repeat both get the same result, rows that repeat a doc_id with
other texts are documents of their own, in the order of their texts' hashes. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expressions import WORD, let
from .shared import documents, written

#: The rolling hash is polynomial, to FACTOR, modulo the prime RANGE.
DIVISOR, ROLL, FACTOR, RANGE = 2, 3, 65599, 2147483647


def _hashes(lines: Column) -> Column:
    """The first 32 bits of each line's MD5."""
    return F.transform(lines, lambda x: F.conv(F.left(F.md5(x.cast("binary")), F.lit(8)), 16, 10).cast("long"))


def _cuts(h: Column, divisor: int) -> Column:
    """The numbers of lines after which a text is cut, from 0 (before its first line) to all lines."""

    def rolled(i: Column) -> Column:
        out = F.lit(0).cast("long")
        for k in range(ROLL, 0, -1):
            out = (out * FACTOR + F.get(h, i - k)) % RANGE
        return out

    inside = F.when(F.size(h) > ROLL, F.sequence(F.lit(ROLL), F.size(h) - 1)).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(0)), F.filter(inside, lambda i: rolled(i) * divisor < RANGE), F.array(F.size(h)))


def _spans(cuts: Column) -> Column:
    """Array of (start, n, low, high) of the chunks of two lines or more between cuts; low and high are the cuts before its start and
    after its end."""
    at = lambda i: F.get(cuts, i)

    def of(i: Column) -> Column:
        j = F.when(at(i + 1) - at(i) >= 2, i + 1).otherwise(i + 2)  # cuts are a line apart at least
        end = at(j)
        low, high = F.when(i > 0, at(F.greatest(i - 1, F.lit(0)))).otherwise(0), F.coalesce(at(j + 1), end)
        return F.struct(at(i).alias("start"), (end - at(i)).alias("n"), low.alias("low"), high.alias("high"))

    return F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.size(cuts) - 2, F.lit(0))), of), lambda c: c["n"] > 1)


def _chunks(text: Column, divisor: int) -> Column:
    """Array of (start, n, low, high, h) of a text's chunks with a word."""

    def of(lines: Column) -> Column:
        def cut(h: Column) -> Column:
            worded = F.filter(let(_cuts(h, divisor), _spans), lambda c: F.exists(F.slice(lines, c["start"] + 1, c["n"]), lambda x: x.rlike(WORD)))
            return F.transform(worded, lambda c: F.struct(*[c[k].alias(k) for k in ("start", "n", "low", "high")], F.xxhash64(F.slice(h, c["start"] + 1, c["n"])).alias("h")))

        return let(_hashes(lines), cut)

    return let(F.split(text, "\n"), of)


def _digests(lines: Column) -> Column:
    """The first 128 bits of each line's SHA-256, as two numbers in a row: they decide what goes, so no weaker hash will do."""
    half = lambda d, at: F.conv(F.substring(d, at, 16), 16, -10).cast("long")
    return F.flatten(F.transform(lines, lambda x: let(F.sha2(x.cast("binary"), 256), lambda d: F.array(half(d, 1), half(d, 17)))))


def _joint(a: Column, b: Column) -> Column:
    """How many elements two arrays begin with in common."""
    n = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(0), n), lambda i: (i == n) | (F.get(a, i) != F.get(b, i)))
    return F.get(differs, F.lit(0))


def line_dedup(df: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): doc_id, n_lines, removed (array of (start, n) lines, in order), kept_text
    and rest (a struct of the other columns)."""
    docs, by = documents(df), ["doc_id", "t"]
    out = docs.join(_found(docs, divisor), by, "left").select("doc_id", "text", "rest", F.split("text", "\n").alias("lines"), _union("s").alias("removed"))
    return _without_removed(out)


def _found(docs: DataFrame, divisor: int) -> DataFrame:
    """doc_id, t, s: sorted array of (start, end) of the lines of each chunk that is found before, with what is extended around it."""
    by = ["doc_id", "t"]
    chunks = docs.filter("doc_id is not null and text is not null").select(*by, F.inline(_chunks(F.col("text"), divisor)))
    often = chunks.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    often = written(often, "repeated-chunks")  # a table of its own, so that Spark can split a frequent chunk's rows in the join
    candidates = chunks.join(often, "h").groupBy(*by).agg(F.array_sort(F.collect_set(F.struct("start", "n", "low", "high"))).alias("candidates"))

    def around(lines: Column) -> Column:
        part = lambda a, n: _digests(F.slice(lines, a + 1, n))
        return F.transform(
            "candidates",
            lambda c: F.struct(
                c["start"].alias("start"),
                c["n"].alias("n"),
                F.reverse(part(c["low"], c["start"] - c["low"])).alias("before"),
                part(c["start"] + c["n"], c["high"] - c["start"] - c["n"]).alias("after"),
                F.array_join(F.slice(lines, c["start"] + 1, c["n"]), "\n").alias("chunk"),
            ),
        )

    # the same join as the last one, so that Spark deals the texts out once for both; inline leaves out what has no candidates
    bytes_of = docs.join(candidates, by, "left").select(*by, F.inline(let(F.split("text", "\n"), around)))
    bytes_of = bytes_of.withColumn("sha", F.unhex(F.sha2(F.col("chunk").cast("binary"), 256)))
    place = F.struct("doc_id", "t", "start", "before", "after")
    firsts = bytes_of.groupBy("chunk").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c"), F.any_value("sha").alias("sha")).filter("c > 1").select("sha", "first")
    again = bytes_of.drop("chunk").join(firsts, "sha").filter(F.struct("doc_id", "t", "start") != F.struct("first.doc_id", "first.t", "first.start"))
    joint = lambda side: F.floor(_joint(F.col(side), F.col(f"first.{side}")) / 2).cast("int")
    more = again.select(*by, "start", "n", joint("before").alias("up"), joint("after").alias("down"))
    return more.groupBy(*by).agg(F.array_sort(F.collect_set(F.struct((F.col("start") - F.col("up")).alias("start"), (F.col("start") + F.col("n") + F.col("down")).alias("end")))).alias("s"))


def _union(spans: str) -> Column:
    """Array of (start, n) of the union of sorted spans (start, end); spans that overlap or touch become one."""
    pair = "struct<start:int,end:int>"

    def add(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (s["start"] <= last["end"]), joined).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    merged = F.aggregate(F.coalesce(spans, F.array().cast(f"array<{pair}>")), F.array().cast(f"array<{pair}>"), lambda d, s: add(d, s).cast(f"array<{pair}>"))
    return F.transform(merged, lambda s: F.struct(s["start"].alias("start"), (s["end"] - s["start"]).alias("n")))


def _starts(lines: Column) -> Column:
    """Where two consecutive lines begin of which one has a word."""
    worded = F.transform(lines, lambda x: x.rlike(WORD))
    return let(worded, lambda w: F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i + 1 < F.size(w)) & (F.get(w, i) | F.coalesce(F.get(w, i + 1), F.lit(False)))))


def _inside(start: Column) -> Column:
    """Whether two lines lie within one of the spans ``s``."""
    return F.coalesce(F.exists("s", lambda x: (x["start"] <= start) & (start + 2 <= x["end"])), F.lit(False))


def _pairs(text: Column) -> Column:
    """Array of (start, h) of each two consecutive lines of a text of which one has a word."""

    def of(lines: Column) -> Column:
        return F.transform(_starts(lines), lambda i: F.struct(i.alias("start"), F.unhex(F.md5(F.array_join(F.slice(lines, i + 1, 2), "\n").cast("binary"))).alias("h")))

    return let(F.split(text, "\n"), of)


def repeats_removed(df: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """Like ``line_dedup``, and also what its cuts leave: any run of two lines or more that an earlier place has too goes whole,
    wherever it begins. Chunks are searched first. What lies within one that was found has the same lines at an earlier place, so it
    is no first place of anything; the exact search then takes the other pairs of consecutive lines alone. Places are judged on the
    input; pairs are compared by 128 bits. Pairs are made where the texts are read and meet what was found without their texts,
    which are dealt out twice in all: for the chunks and for what is left of them."""
    docs, by = documents(df), ["doc_id", "t"]
    found = written(_found(docs, divisor), "chunk-spans")
    pairs = docs.filter("doc_id is not null and text is not null").select(*by, _pairs(F.col("text")).alias("pairs")).join(found, by, "left")
    pairs = written(pairs.select(*by, F.inline(F.filter("pairs", lambda p: ~_inside(p["start"])))), "line-pairs")  # read twice, made once
    place = F.struct("doc_id", "t", "start")
    often = written(pairs.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("h", "first"), "repeated-pairs")
    again = pairs.join(often, "h").filter(place != F.col("first")).groupBy(*by).agg(F.collect_set("start").alias("p"))
    spans = written(again.join(found, by, "full_outer"), "line-spans")  # a table whose size Spark knows
    none = F.array().cast("array<int>")
    starts = F.concat(F.coalesce("p", none), F.when(F.col("s").isNull(), none).otherwise(F.filter(_starts(F.col("lines")), _inside)))
    runs = F.transform(F.array_sort(starts), lambda i: F.struct(i.alias("start"), (i + 2).alias("end")))
    out = docs.join(spans, by, "left").withColumn("lines", F.split("text", "\n")).withColumn("runs", runs)
    return _without_removed(out.select("doc_id", "text", "rest", "lines", _union("runs").alias("removed")))


def _without_removed(out: DataFrame) -> DataFrame:
    end = lambda k: F.when(k == 0, 0).otherwise(F.get("removed", k - 1)["start"] + F.get("removed", k - 1)["n"])
    upto = lambda k: F.coalesce(F.get("removed", k)["start"], F.size("lines"))
    segments = F.transform(F.sequence(F.lit(0), F.size("removed")), lambda k: F.slice("lines", end(k) + 1, upto(k) - end(k)))
    kept = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(F.flatten(segments), "\n"))
    return out.select("doc_id", F.coalesce(F.array_size("lines"), F.lit(0)).alias("n_lines"), "removed", kept.alias("kept_text"), "rest")


SQL = f"""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
  lines AS (SELECT doc_id, l, i, ('0x' || md5(l[i])[1:8])::BIGINT AS h FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM d)),
  rolled AS (SELECT doc_id, l, i, ((lag(h, 2) OVER w * {FACTOR} + lag(h) OVER w) % {RANGE} * {FACTOR} + h) % {RANGE} AS r FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  cuts AS (SELECT doc_id, l, i AS c FROM rolled WHERE i = len(l) OR r * {DIVISOR} < {RANGE} UNION ALL SELECT doc_id, l, 0 FROM d WHERE l IS NOT NULL),
  near AS (SELECT doc_id, l, c, lag(c) OVER w AS b, lead(c) OVER w AS e1, lead(c, 2) OVER w AS e2, lead(c, 3) OVER w AS e3 FROM cuts WINDOW w AS (PARTITION BY doc_id ORDER BY c)),
  spans AS (SELECT doc_id, l, c AS s, coalesce(b, 0) AS low, CASE WHEN e1 - c >= 2 THEN e1 ELSE e2 END AS e, CASE WHEN e1 - c >= 2 THEN coalesce(e2, e1) ELSE coalesce(e3, e2) END AS high FROM near),
  chunks AS (SELECT doc_id, s, e, list_reverse(l[low + 1:s]) AS up, l[e + 1:high] AS down, array_to_string(l[s + 1:e], chr(10)) AS x FROM spans WHERE e IS NOT NULL),
  firsts AS (SELECT *, first_value(doc_id) OVER w AS fd, first_value(s) OVER w AS fs, first_value(up) OVER w AS fu, first_value(down) OVER w AS fn FROM chunks WHERE regexp_matches(x, '{WORD}') WINDOW w AS (PARTITION BY x ORDER BY doc_id, s)),
  again AS (SELECT doc_id, s - len(list_filter(range(1, least(len(up), len(fu)) + 1), lambda k: up[1:k] = fu[1:k])) AS a, e + len(list_filter(range(1, least(len(down), len(fn)) + 1), lambda k: down[1:k] = fn[1:k])) AS z FROM firsts WHERE doc_id <> fd OR s <> fs),
  gone AS (SELECT DISTINCT doc_id, unnest(range(a + 1, z + 1)) AS i FROM again),
  runs AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE p IS NULL OR p < i - 1) AS c FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM gone) GROUP BY doc_id),
  kept AS (SELECT doc_id, string_agg(l[i], chr(10) ORDER BY i) AS kept FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed_lines, coalesce(c, 0)::BIGINT AS n_removed_runs,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256 FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)"""

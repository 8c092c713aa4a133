"""The operators on texts against brute force, with nulls, empty and very long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from factlake.llm import bpe, line_dedup, packing, quality_classifier, quality_rules, sharding, simhash, substring_dedup
from factlake.llm import words as W

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "  \t\n", "a", "ÉA é́  x y don't 日本語 😀", "x" * 3000, "w " * 3000, "a\x0bb\x0cc\r\nd", "one two three\none two three"]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) + rng.choice(["", "", ".", ","]) for _ in range(n))


def corpus(seed=1):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (20, 21, 19, 60, 200)]
    texts = list(ODD)
    for _ in range(60):
        parts = [prose(rng, rng.randint(0, 80)) for _ in range(3)] + rng.sample(shared, rng.randint(0, 2))
        rng.shuffle(parts)
        texts.append(rng.choice([" ", "\n"]).join(parts))
    texts += texts[10:30] + [t[:-3] + "zzz" for t in texts[30:40]] + [prose(rng, 20000)]
    return list(enumerate(texts))


def frame(spark, rows, n=3):
    """With columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, "s", 1, "x") for i, t in rows], "doc_id long, text string, h string, n int, lang string").repartition(n)


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_words_and_hashes():
    texts = [t or "" for _, t in corpus()]
    import pyarrow as pa

    buf, offsets = W.flat(pa.array([t for _, t in corpus()]))
    starts, ends, text = W.split(buf, offsets)
    got = defaultdict(list)
    for a, b, t in zip(starts, ends, text, strict=True):
        got[t].append(buf[a:b].tobytes().decode())
    assert [got[i] for i in range(len(texts))] == [WORDS.findall(t) for t in texts]
    by_hash = dict(zip(W.hashes(buf, starts, ends).tolist(), (buf[a:b].tobytes() for a, b in zip(starts, ends, strict=True)), strict=True))
    assert len(by_hash) == len({w for t in texts for w in WORDS.findall(t)})
    v = np.array([3, 1, 2, 1, 5, 0, 0], np.uint64)
    assert W.sliding_argmin(v, 3).tolist() == [1, 3, 3, 5, 6]
    assert [r for r in W.slices(np.array([0, 5, 5, 30, 31]), 10)] == [(0, 2), (2, 3), (3, 4)]


def removed_by_brute_force(rows, k):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            if key in seen:
                gone[a : a + k] = [True] * k
            seen.add(key)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_substring_dedup(spark, rows):
    for n in (1, 5):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(frame(spark, rows, n)).collect()}
        assert got == removed_by_brute_force(rows, 20)


def test_substring_dedup_edges(spark):
    same = [(7, "a " * 40), (7, "a " * 40), (None, "a " * 40), (9, "a " * 40)]
    got = [(r.doc_id, r.n_removed) for r in substring_dedup.substring_dedup(frame(spark, same)).collect()]
    assert sorted(got, key=str) == [(7, 39), (7, 39), (9, 40), (None, 0)]
    assert substring_dedup.substring_dedup(frame(spark, same).limit(0)).count() == 0
    text = "keep  this\n" + prose(random.Random(3), 30)
    (first, second) = sorted(substring_dedup.substring_dedup(frame(spark, [(1, text), (2, "own\twords " + text.split("\n")[1] + " end")]), layout=True).collect())
    assert first.kept_text == text and second.kept_text == "own\twords end" and second.rest.lang == "x"


def lines_by_brute_force(rows):
    """Texts left by chunks of content-defined cuts, extended line by line; rows are (document, text) in order."""
    h = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:8], 16)
    chunks, firsts, out = [], {}, {}
    for doc, t in sorted(rows, key=lambda r: r[0]):
        if t is None:
            continue
        lines = t.split("\n")
        rolled = lambda i: sum(h(lines[i - 1 - k]) * 65599**k for k in range(3)) % 2147483647
        cuts = [0, *[i for i in range(3, len(lines)) if rolled(i) * 2 < 2147483647], len(lines)]
        for i, start in enumerate(cuts[:-1]):
            end = next((k for k, c in enumerate(cuts) if c >= start + 2), None)
            if end is None or not WORDS.search("\n".join(lines[start : cuts[end]])):
                continue
            before, after = lines[cuts[max(i - 1, 0)] : start][::-1], lines[cuts[end] : cuts[min(end + 1, len(cuts) - 1)]]
            chunks.append((doc, start, cuts[end], before, after, tuple(lines[start : cuts[end]])))
            firsts.setdefault(chunks[-1][5], chunks[-1])
        out[doc] = [lines, [False] * len(lines)]
    joint = lambda x, y: next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))  # noqa: E731, B905
    for doc, start, end, before, after, key in chunks:
        first = firsts[key]
        if (doc, start) != first[:2]:
            for i in range(start - joint(before, first[3]), end + joint(after, first[4])):
                out[doc][1][i] = True
    return {doc: "\n".join(x for x, g in zip(*both, strict=True) if not g) for doc, both in out.items()}


def lined(seed=2):
    """Texts of lines with shared runs of lines, whole copies, and copies after a shift."""
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice("abcdefgh") * 3 for _ in range(6))
    shared = [[line() for _ in range(n)] for n in (2, 3, 5, 8, 20)] + [["", " ", ""], ["x", ""]]
    texts = [None, "", "one", "x\nx\nx\nx\nx\nx", "a\n\n\nb\n\n\nb"]
    for _ in range(80):
        parts = [[line() for _ in range(rng.randint(0, 3))] for _ in range(4)] + rng.sample(shared, rng.randint(0, 3))
        rng.shuffle(parts)
        texts.append("\n".join(x for p in parts for x in p))
    return texts + texts[5:15] + ["shift\n" + t for t in texts[20:30]]


def test_line_dedup(spark, rows):
    rows = rows + [(len(rows) + i, t) for i, t in enumerate(lined())]
    out = {r.doc_id: r for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    expected = {i: None for i, t in rows if t is None} | lines_by_brute_force(rows)
    assert {i: r.kept_text for i, r in out.items()} == expected
    for i, t in rows:  # the spans say what the text lacks
        lines, gone = (t or "").split("\n"), {j for s in out[i].removed for j in range(s.start, s.start + s.n)}
        assert t is None or out[i].kept_text == "\n".join(x for j, x in enumerate(lines) if j not in gone)
    assert line_dedup.line_dedup(frame(spark, rows).limit(0)).count() == 0


def test_rows_that_repeat_a_doc_id(spark):
    """Documents are a doc_id with a text, in the order of doc_id and the text's hash."""
    rng = random.Random(6)
    block, other, words = "\n".join(prose(rng, 4) for _ in range(40)), prose(rng, 30), prose(rng, 40)
    hashed = lambda pairs: sorted((i, xxhash.xxh64_intdigest(t.encode(), 42) - ((1 << 64) if xxhash.xxh64_intdigest(t.encode(), 42) >> 63 else 0), t) for i, t in set(pairs))
    for extra in ([], [(7, other)], [(7, other + "\nm"), (7, block + "\n" + other)]):
        pairs = [(1, block), (7, block), *extra, (7, block)]
        names = {t: i for i, (_, _, t) in enumerate(hashed(pairs))}  # one text stands under two ids
        expected = lines_by_brute_force([((i, h), t) for i, h, t in hashed(pairs)])
        got = line_dedup.line_dedup(frame(spark, pairs)).collect()
        assert len(names) and len(got) == len(pairs)
        assert sorted((r.doc_id, r.kept_text) for r in got) == sorted([(i, expected[(i, h)]) for i, h, t in hashed(pairs)] + [(7, expected[next((i, h) for i, h, t in hashed(pairs) if i == 7 and t == block)])])
        assert all(r.kept_text == "" for r in got if r.doc_id == 7 and r.n_lines == 40)
    for pairs in ([(7, "z " + words), (7, words)], [(1, words), (7, "z " + words), (7, words + " end"), (7, "own")]):
        expected = removed_by_brute_force([((i, h), t) for i, h, t in hashed(pairs)], 20)
        got = substring_dedup.substring_dedup(frame(spark, pairs)).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == sorted((i, *expected[(i, h)]) for i, h, _ in hashed(pairs))


def test_columns_of_any_name(spark):
    odd = spark.createDataFrame([(1, "a b\nc d", "u", 2, {"k": 1}), (2, None, "v", 3, None)], "doc_id long, text string, `source url` string, `x``y.z` int, `t` map<string,int>")
    for f in (line_dedup.line_dedup, line_dedup.repeats_removed, substring_dedup.substring_dedup, lambda d: substring_dedup.substring_dedup(d, layout=True)):
        first, second = sorted(f(odd).collect())
        assert first.kept_text.split() == ["a", "b", "c", "d"] and first.rest["source url"] == "u" and second.rest["x`y.z"] == 3 and first.rest["t"] == {"k": 1}


def test_simhash(spark, rows):
    def fingerprint(t):
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        if not w:
            return 0
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: fingerprint(t) for i, t in rows}
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3 and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: (prints[i], root(i)) for i in prints}
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    odd = [(None, "q r s t"), (3, "q r s t"), (3, "q r s t")]
    assert sorted([(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame(spark, odd)).collect()], key=str) == [(3, 3), (3, 3), (None, 3)]


def test_simhash_search_loses_no_link(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(12)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame(list(zip(signed, range(len(values)), strict=True)), "fp long, rep long")
    expected = {(i, j) for i in range(len(values)) for j in range(len(values)) if i < j and (values[i] ^ values[j]).bit_count() <= 3}
    got = {tuple(sorted((r.a, r.b))) for r in simhash.linked(nodes).collect()}
    assert got == expected
    for m, rows_ in ((2, 10**10), (3, 10**7), (4, 1000)):
        cost, t = simhash.allotted(simhash.grouped(np.eye(64), m), np.full(64, 0.5), rows_, 3)
        assert sum(x + 1 for x in t) == 4 and cost > 0


def test_components(spark):
    from factlake.llm.components import components

    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 200), (None, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    from factlake.llm.vocabulary import ranks_of

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(f.read()), special_tokens={})


def test_bpe(spark, rows, tiktoken_encoding):
    rng = random.Random(2)
    wild = ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0xA1, 0x2FFF), 0x1F600 + rng.randint(0, 40), 0x85, 0x1C, 0xA0, 0x2003])) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    data = list(enumerate([t for _, t in rows] + wild + ["<|endoftext|> ౜࢏"]))
    vocabulary = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe.encode(frame(spark, data), vocabulary)
    back = {r.doc_id: r for r in bpe.decode(ids, vocabulary).collect()}
    for i, t in data:
        r, t = back[i], t or ""
        tokens = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert tokens == tiktoken_encoding.encode_ordinary(t) and bytes(r.decoded) == t.encode()
        pos, upto = 0, np.cumsum([0, *[len(c.encode()) for c in t]])
        for k, token in enumerate(tokens):
            width = len(tiktoken_encoding.decode_single_token_bytes(token))
            assert r.starts[k] == np.searchsorted(upto, pos, side="right") - 1 and r.ends[k] == np.searchsorted(upto, pos + width)
            pos += width
    assert bpe.decode(bpe.encode(frame(spark, rows).limit(0), vocabulary), vocabulary).count() == 0
    split = spark.createDataFrame([(1, bytearray(np.array(tiktoken_encoding.encode_ordinary("😀")[:1], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in bpe.decode(split, vocabulary, as_text=True).collect()} == {1: "�", 2: ""}


def test_packing(spark, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    data = [*rows, (500, "×a÷b aİb ŒuvRE ÀÉ12,3!! Don'T <|endoftext|> x<|endoftext|>Y …,a ’tis áb Ŀ1 µm ª"), (None, "b c"), (None, "b c")]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(frame(spark, data), path, window=256).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in data:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces[i], key=lambda r: (r.start, r.sequence_id))
        if i is None:
            assert sorted(np.frombuffer(bytes(r.ids), "<u4").tolist() for r in own) == [ids, ids]
            continue
        assert [x for r in own for x in np.frombuffer(bytes(r.ids), "<u4").tolist()] == ids
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist() and {r.doc_tokens for r in own} == {len(ids)}
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist() and total <= 256
        padding += 0 if total & (total - 1) == 0 else 256 - total
    assert padding < 0.02 * sum(r.length for own in sequences.values() for r in own)
    assert packing.pack(frame(spark, rows).limit(0), path).count() == 0


def test_best_fit_decreasing_takes_the_tightest():
    rng = random.Random(9)
    lengths = [rng.randint(1, 64) for _ in range(300)]
    room, expected = [], []
    for i in sorted(range(300), key=lambda i: (-lengths[i], i)):
        fits = [(r, w) for w, r in enumerate(room) if r >= lengths[i]]
        if not fits:
            room.append(64)
            expected.append(0)
            fits = [(64, len(room) - 1)]
        w = min(fits)[1]
        room[w] -= lengths[i]
        expected[w] += lengths[i]
    got = packing.best_fit_decreasing(lengths, 64)
    assert sorted(sum(lengths[i] for i in w) for w in got) == sorted(expected) and sorted(i for w in got for i in w) == list(range(300))


def test_sharding(spark, rows):
    data = [*rows, *[(1000 + i, "hot " * 90) for i in range(200)], (None, "hot " * 90), (3, "dup"), (3, "dup")]
    groups = defaultdict(int)
    for _, t in data:
        groups[hashlib.md5((t or "").encode()).digest()] += len((t or "").encode()) + 1
    sizes = [groups[g] for g in sorted(groups)]

    def shards(c):
        n, s = 1, 0
        for x in sizes:
            if s + x > c:
                n, s = n + 1, 0
            s += x
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if shards(mid) <= 16 else (mid + 1, high)
    out = sharding.shard(frame(spark, data, 7)).collect()
    total, slots, of = defaultdict(int), defaultdict(list), defaultdict(set)
    texts = defaultdict(list)
    for i, t in data:
        texts[i].append(t or "")
    for r in out:
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert any(zlib.crc32(t.encode()) == r.text_crc32 and len(t.encode()) + 1 == r["size"] for t in texts[r.doc_id])
        of[r.text_crc32].add(r.shard)
    assert len(out) == len(data) and max(total.values()) == low and all(len(s) == 1 for s in of.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(frame(spark, rows).limit(0)).count() == 0


def test_quality_rules(spark, rows):
    rng = random.Random(6)
    data = [(i, prose(rng, rng.randint(60, 200)).replace(",", "") + ".") for i in range(80)] + [(100 + i, " ".join(x + "%%%" for x in prose(rng, 80).split())) for i in range(15)] + [(200 + i, (prose(rng, 6) + " ") * 30) for i in range(15)] + [(300 + i, t) for i, t in rows[:9]]
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, data)).collect()}
    for i, t in data:
        w, r = WORDS.findall(t or ""), got[i]
        grams = defaultdict(list)
        for a in range(len(w) - 4):
            grams[tuple(w[a : a + 5])].append(a)
        covered = {a + k for places in grams.values() if len(places) > 1 for a in places for k in range(5)}
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r.n_symbols == sum((t or "").count(c) for c in "#*$%&|<>") and r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
    assert all(got[i].kept for i in range(80)) and not any(got[100 + i].kept or got[200 + i].kept for i in range(15))
    assert quality_rules.judge(frame(spark, rows).limit(0)).count() == 0


def test_quality_classifier_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_classifier.classify(docs).join(labels, "doc_id").select(F.col("kept").alias("k"), (F.col("quality") == 1).alias("q")).collect()
    assert sum(r.k == r.q for r in out) / len(out) > 0.97 and sum(r.k for r in out if r.q) / sum(r.q for r in out) > 0.99
    kept = quality_classifier.keep_good(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_classifier_edges(spark, rows):
    data = [*rows, (None, "ab cd"), (3, "x y"), (3, "x y")]
    out = quality_classifier.classify(frame(spark, data)).collect()
    assert len(out) == len(data) and all(0 <= r.p_quality <= 1 for r in out)
    assert quality_classifier.classify(frame(spark, rows).limit(0)).count() == 0

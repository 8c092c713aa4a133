"""Packing of tokenised documents into training sequences by best-fit decreasing.

A document's ids (its tokens, then the end id) are cut into full windows and a rest. Full windows are sequences as they are.
Rests, longest first, each go to the open window with the least room that still holds them; a segment tree over remaining
capacities finds it in log2(window) steps, and a new window opens where none fits.

Packing is a streaming pass: each task packs its own rests, about ``block`` tokens at a time, so nothing is shuffled, no task
holds more than a block, and a lost task is simply run again. Within a block only the last windows stay ill filled; such a
window is cut at powers of two, at which sequences need no padding.

Words are looked up, not encoded again: the tokenizer drops white space and never joins over it, so distinct words are
encoded by the library once, kept up to a bound, and ids are gathered from them with numpy.

Defined results: a null or empty text is a document of the end id alone; a null doc_id and repeated rows are documents like any
other; an empty table has no sequences.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import chain
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocabulary as V
from . import words as W
from .shared import in_small_batches

WINDOW, END = 4096, 2
#: Tokens of rests that a task gathers before it packs them: what bounds its memory.
BLOCK = 1 << 23
#: Words kept with their ids in each Python process.
CACHED = 400_000
#: New words encoded as one text.
JOINED = 512
#: Kinds of bytes: white space (0), letters (1; lead bytes of U+00C0 to U+017F and all that follow a lead byte too), digits (2),
#: marks (3). Odd are those of other characters, and the apostrophe.
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = 1
_KIND[0x30:0x3A] = 2
_ODD = np.zeros(256, bool)
_ODD[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x27, 0x7F, 0xC0, 0xC1, 0xC2, *range(0xC6, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class OpenWindows:
    """Open windows by remaining capacity: a segment tree of counts with a stack of windows at each leaf."""

    def __init__(self, window: int):
        self.leaves = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def add(self, room: int, window: int) -> None:
        self.at.setdefault(room, []).append(window)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes the window with the least room of at least ``least``: (room, window)."""
        i = least + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up until a right neighbour holds something
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._change(room, -1)
        return room, self.at[room].pop()

    def _change(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Which of the pieces (by place in ``lengths``) go into each window, in order."""
    tree, windows = OpenWindows(window), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            windows.append([])
            found = window, len(windows) - 1
        room, w = found
        windows[w].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], w)
    return windows


class _Encoder:
    """Ids of texts, word by word, from a tokenizer of the library."""

    def __init__(self, data: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        model = json.loads(data)["model"]
        suffix = model.get("end_of_word_suffix")
        self.last = np.zeros(max(model["vocab"].values()) + 1, bool)  # tokens that end a word of the model
        if suffix:
            self.last[[i for name, i in model["vocab"].items() if name.endswith(suffix)]] = True
        self.joins = bool(suffix)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {b"": 0}
        self.begin, self.size, self.flat = array("q", [0]), array("q", [0]), array("i")

    def _learn(self, parts: list[bytes]) -> None:
        """Runs of Latin letters are one word of the model each: many are encoded as one text, which costs half as much, and
        cut where a token ends a word. All other parts are encoded one by one."""
        texts = [x.decode("utf-8", "replace") for x in parts]
        letters = [self.joins and x.isalpha() and max(x) < "\u0180" for x in texts]
        whole = [x for x, yes in zip(texts, letters, strict=True) if yes]
        lines = [whole[i : i + JOINED] for i in range(0, len(whole), JOINED)]
        found: list[list[int]] = []
        for own, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = e.ids
            ends = (np.flatnonzero(self.last[np.array(ids, np.int64)]) + 1).tolist()
            if len(ends) == len(own):
                found += [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            else:
                found += [x.ids for x in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]
        keys = [x for x, yes in zip(parts, letters, strict=True) if yes] + [x for x, yes in zip(parts, letters, strict=True) if not yes]
        rest = [x for x, yes in zip(texts, letters, strict=True) if not yes]
        found += [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        sizes = list(map(len, found))
        self.known.update(zip(keys, range(len(self.begin), len(self.begin) + len(keys)), strict=True))
        self.begin.extend((len(self.flat) + np.cumsum(sizes) - sizes).tolist())
        self.size.extend(sizes)
        self.flat.extend(chain.from_iterable(found))

    @staticmethod
    def _parts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges of the parts, which of them lie between two edges with something other than white space, and the bytes.

        The model never joins over white space, nor letters with digits or marks, so words of Latin letters, digits and ASCII
        marks are cut there and put in lower case, which leaves fewer different parts. Words with anything else, an apostrophe
        or the start of a special token stay whole and as they are."""
        kind = _KIND[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[offsets] = True
        low = _LOWER[buf]
        odd = _ODD[buf]
        odd[:-1] |= ((buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))) | ((buf[:-1] == 0xC4) & (buf[1:] == 0xB0)) | ((buf[:-1] == 0x3C) & (buf[1:] == 0x7C))
        if odd.any():
            outer = np.zeros(len(buf) + 1, bool)
            outer[1:-1] = (kind[1:] == 0) != (kind[:-1] == 0)
            outer[offsets] = True
            cuts = np.flatnonzero(outer)
            for k in np.unique(np.searchsorted(cuts, np.flatnonzero(odd), side="right") - 1).tolist():
                a, b = cuts[k], cuts[k + 1]
                edge[a + 1 : b] = False
                low[a:b] = buf[a:b]
        cuts = np.flatnonzero(edge)
        return cuts, kind[cuts[:-1]] != 0, low

    def of_texts(self, buf: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end``, and where each text's ids start (n + 1 offsets)."""
        n = len(offsets) - 1
        if len(self.known) > CACHED:
            self.clear()
        number, starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(buf):
            cuts, solid, low = self._parts(buf, offsets)
            parts = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(low)])
            coded = parts.dictionary_encode()
            spelled = coded.dictionary.to_pylist()
            blank = np.zeros(len(spelled), bool)
            code = coded.indices.to_numpy(zero_copy_only=False)
            blank[code[~solid]] = True  # white space is a part of its own
            new = [x for x, b in zip(spelled, blank.tolist(), strict=True) if not b and x not in self.known]
            if new:
                self._learn(new)
            of = np.fromiter((0 if b else self.known[x] for x, b in zip(spelled, blank.tolist(), strict=True)), np.int64, len(spelled))
            number, starts = of[code[solid]], cuts[:-1][solid]
        begin, size, flat = np.frombuffer(self.begin, np.int64), np.frombuffer(self.size, np.int64), np.frombuffer(self.flat, np.int32)
        each = size[number]
        text = np.searchsorted(starts, offsets)  # parts before each text
        upto = np.concatenate([[0], np.cumsum(each)])
        total = np.diff(upto[text]) + 1
        out = np.full(int(upto[-1]) + n, end, np.int32)
        if len(number):
            before = np.repeat(np.arange(n), np.diff(text))  # one end id for each text before
            to = np.arange(int(upto[-1]))
            out[to + np.repeat(before, each)] = flat[np.repeat(begin[number] - upto[:-1], each) + to]
        result = out, np.concatenate([[0], np.cumsum(total)])
        del begin, size, flat  # arrays can't grow while they are looked at
        return result


def _sequences(lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, length): best fit, with an ill filled window cut at powers of two."""
    for pieces in best_fit_decreasing(lengths, window):
        total = sum(lengths[i] for i in pieces)
        if window - total <= window // 64 or total & (total - 1) == 0:
            yield [(i, 0, lengths[i]) for i in pieces]
            continue
        todo = [(i, 0, lengths[i]) for i in pieces]
        while todo:
            room = 1 << (sum(x[2] for x in todo).bit_length() - 1)
            now: list[tuple[int, int, int]] = []
            while room:
                i, a, n = todo[0]
                now.append((i, a, min(n, room)))
                todo[:1] = [(i, a + room, n - room)] if n > room else []
                room -= now[-1][2]
            yield now


def _packed(tokenizer, window: int, end: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = tokenizer.value
        encoder = V.once(f"words {hash(data)}", lambda: _Encoder(data))
        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # rests: doc_id, start, ids, ids of the document
        tokens = 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, doc_tokens, sequence, offset = zip(*rows, strict=True)
            blob = [x.astype("<u4").tobytes() for x in ids]
            columns = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(list(map(len, ids)), pa.int64()), pa.array(doc_tokens, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), pa.array(blob, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        def packed(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for sequence in _sequences([len(x[2]) for x in pieces], window):
                at = 0
                for i, a, n in sequence:
                    doc, start, ids, doc_tokens = pieces[i]
                    rows.append((doc, start + a, ids[a : a + n], doc_tokens, number, at))
                    at += n
                number += 1
                if len(rows) > 4000:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)

        for batch in batches:
            buf, offsets = W.flat(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            for a, b in W.slices(offsets):
                ids, starts = encoder.of_texts(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end)
                rows = []
                for k in range(b - a):
                    own = ids[starts[k] : starts[k + 1]]
                    whole = len(own) - len(own) % window
                    for x in range(0, whole, window):
                        rows.append((docs[a + k], x, own[x : x + window], len(own), number, 0))
                        number += 1
                    if whole < len(own):
                        held.append((docs[a + k], whole, own[whole:].copy(), len(own)))
                        tokens += len(own) - whole
                if rows:
                    yield out(rows)
                if tokens >= block:
                    yield from packed(held)
                    held, tokens = [], 0
        if held:
            yield from packed(held)

    return run


def pack(df: DataFrame, tokenizer_file: str, window: int = WINDOW, end: int = END, block: int = BLOCK) -> DataFrame:
    """One row for each piece of a document of ``df`` (doc_id, text): doc_id, start (the document's ids before it), length,
    doc_tokens (the document's ids, the end id included), sequence_id, offset (in the sequence) and ids (binary, little-endian
    unsigned 32-bit). ``tokenizer_file`` is read by the driver; ``window`` is a power of two."""
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer = df.sparkSession.sparkContext.broadcast(file.read())  # a file of fixed size
    docs = in_small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return docs.mapInArrow(_packed(tokenizer, window, end, block), schema)

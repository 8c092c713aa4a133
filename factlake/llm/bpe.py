"""Byte-level BPE encoding and decoding over Arrow batches.

Encoding. A text is split by the vocabulary's pattern; each match is merged by itself. The tokenizers library merges, with a
model made from the rank file: bytes are mapped to stand-in characters, and merges are read off the ranks. Distinct matches
are encoded once for a batch and kept, up to a bound, for the next ones; ids are then gathered with numpy. Each token gets the
half-open range of characters that it touches; where a character's bytes lie in several tokens, each of them has it.

Decoding maps a token's characters back to bytes and joins the bytes of all tokens before any character is formed, so that
characters split over tokens come back whole.

The classes of the pattern (letters, numbers, spaces) are those of the tiktoken library, whose Unicode version may differ
from that of the regex library: the driver asks tiktoken for every code point and corrects the classes.

Defined results: a null text is empty and has no tokens; null ids decode to no bytes; a null doc_id and repeated rows are rows
like any other; bytes that form no character become U+FFFD in decoded text only. An id outside the vocabulary is an error.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocabulary as V
from . import words as W
from .shared import in_small_batches

#: Matches kept with their ids in each Python process.
CACHED = 150_000
#: Rows decoded at once.
ROWS = 500


def _set(chars: set[str]) -> str:
    """A character class of the regex library, by ranges."""
    codes = np.array(sorted(map(ord, chars)))
    if not len(codes):
        return "[^\\U00000000-\\U0010ffff]"
    cut = np.flatnonzero(np.diff(codes) != 1)
    first, last = codes[np.concatenate([[0], cut + 1])], codes[np.concatenate([cut, [-1]])]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True)) + "]"


def _classes(pattern: str) -> tuple[str, int]:
    """The pattern with tiktoken's character classes, and the least code point at which the regex library's own differ."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    first = 0x110000
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        if name not in pattern:
            continue
        theirs = set(bytes(tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode())
        ours = set(regex.findall(name, every))
        if theirs != ours:
            first = min(first, *map(ord, theirs ^ ours))
            pattern = pattern.replace(name, f"[[{name}--{_set(ours - theirs)}]||{_set(theirs - ours)}]")
    return "(?V1)" + pattern, first


class _Encoder:
    def __init__(self, tokenizer: str, pattern: str, exact: str, first: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.plain, self.exact = regex.compile(pattern), exact
        self.lead = chr(first).encode()[0] if first < 0x110000 else 256
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.width[i] = len(name)  # a character for each byte
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.begin, self.size, self.flat = array("q"), array("q"), array("I")

    def ids(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and how many each text has."""
        if len(self.known) > CACHED:
            self.clear()
        find = self.plain
        if len(buf) and buf.max() >= self.lead:
            if isinstance(self.exact, str):
                self.exact = regex.compile(self.exact)
            find = self.exact
        data, o = buf.tobytes(), offsets.tolist()
        found = [find.findall(data[o[i] : o[i + 1]].decode("utf-8", "replace")) for i in range(len(o) - 1)]
        matches = list(chain.from_iterable(found))
        known = self.known
        new = list(dict.fromkeys(m for m in matches if m not in known))
        if new:
            for m, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                known[m] = len(self.begin)
                self.begin.append(len(self.flat))
                ids = e.ids
                self.size.append(len(ids))
                self.flat.extend(ids)
        code = np.fromiter(map(known.__getitem__, matches), np.int64, len(matches))
        begin, size, flat = (np.array(x) for x in (self.begin, self.size, self.flat))
        each = size[code] if len(code) else np.zeros(0, np.int64)
        ends = np.cumsum(each)
        out = flat[np.repeat(begin[code] - (ends - each), each) + np.arange(int(each.sum()))] if len(code) else np.zeros(0, np.uint32)
        upto = np.concatenate([[0], ends])[np.cumsum([0, *map(len, found)])]
        return out.astype(np.uint32), np.diff(upto)

    def characters(self, buf: np.ndarray, offsets: np.ndarray, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last, within its text."""
        end = np.cumsum(self.width[ids])  # texts lie end to end, and tokens cover all their bytes
        start = end - self.width[ids]
        begun = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # characters begun before each byte
        own = np.repeat(begun[offsets[:-1]], count)
        return (begun[start + 1] - 1 - own).astype(np.int32), (begun[end] - own).astype(np.int32)


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(values))


def _blobs(data: bytes, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _encode(shared, offsets_too: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        encoder = V.once(f"bpe {hash(made)}", lambda: _Encoder(*made))
        for batch in batches:
            buf, offsets = W.flat(batch.column("text"))
            for a, b in W.slices(offsets, W.SLICE_BYTES // 2):
                part, o = buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                ids, count = encoder.ids(part, o)
                columns = [batch.column("doc_id").slice(a, b - a), _blobs(ids.astype("<u4").tobytes(), 4 * count)]
                if offsets_too:
                    columns += [_lists(x, count) for x in encoder.characters(part, o, ids, count)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "starts", "ends"][: len(columns)])

    return run


def _table(tokenizer: str) -> list[bytes]:
    """The bytes of each id: its characters, mapped back."""
    back = {c: b for b, c in enumerate(V.bytes_to_chars())}
    vocab = json.loads(tokenizer)["model"]["vocab"]
    table = [b""] * (max(vocab.values()) + 1)
    for name, i in vocab.items():
        table[i] = bytes(back[c] for c in name)
    return table


def _decode(shared, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        of = V.once(f"bytes {hash(made)}", lambda: _table(made[0])).__getitem__
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                whole = [b"".join(map(of, np.frombuffer(x or b"", "<u4").tolist())) for x in part.column("ids").to_pylist()]
                out = pa.array([x.decode("utf-8", "replace") for x in whole]) if as_text else pa.array(whole, pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, "decoded"])

    return run


def vocabulary(spark: SparkSession, rank_file: str, pattern: str):
    """What encode() and decode() need of a rank file and its pattern, read by the driver and sent to the executors."""
    with open(rank_file, "rb") as file:
        data = file.read()
    return spark.sparkContext.broadcast((V.byte_level(data).to_str(), pattern, *_classes(pattern)))  # a file of fixed size


def encode(df: DataFrame, shared, offsets: bool = True) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and, with ``offsets``, starts and ends (array<int>, characters) for
    each row of ``df`` (doc_id, text)."""
    docs = in_small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_encode(shared, offsets), "doc_id long, ids binary" + ", starts array<int>, ends array<int>" * offsets)


def decode(df: DataFrame, shared, as_text: bool = False) -> DataFrame:
    """The columns of ``df``, which has ids (binary) and no column decoded, and decoded: the bytes, or the text."""
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType() if as_text else T.BinaryType())])
    return df.mapInArrow(_decode(shared, as_text), schema)

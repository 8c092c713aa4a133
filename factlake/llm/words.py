"""Vectorised word handling for Arrow batches: split, hash and combine words with numpy inside Spark tasks.

A word is a maximal run of bytes other than space and the five ASCII controls U+0009 to U+000D. All functions work on one
flat UTF-8 buffer holding many texts, so that a batch costs a fixed number of numpy calls, not one per text or word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Odd 64-bit multipliers and shifts of a usual finaliser; any odd constants would do.
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_KEEP = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 9)], dtype=np.uint64)
#: Words longer than this are hashed one by one.
LONG_WORD = 128
#: Texts are taken in slices of about so many bytes, which bounds the memory of the numpy arrays.
SLICE_BYTES = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after the other, and the n + 1 offsets into them. Null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    base = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return base, (ends - ends[0] if len(column) else np.zeros(1, np.int64))


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (a, b) of at most about ``limit`` bytes; a single longer text gets a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def split(buf: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (in bytes of ``buf``) and text numbers of all words, in order; ``apart`` says which bytes are in no word."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~apart[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)  # a text begins here
    cut[offsets[:-1]] = True
    before = np.zeros(len(buf), dtype=bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.zeros(len(buf), dtype=bool)
    after[:-1] = word[1:]
    cut[len(buf)] = True
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes in lanes of eight."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    out = mix(out ^ (lanes[starts] & _KEEP[np.minimum(size, 8)]))
    more, at = np.flatnonzero(size > 8), 8
    while len(more) and at < LONG_WORD:
        left = size[more] - at
        out[more] = mix(out[more] ^ (lanes[starts[more] + at] & _KEEP[np.minimum(left, 8)]))
        at += 8
        more = more[left > 8]
    for i in more:
        out[i] = xxhash.xxh64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed)
    return out


def grams(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of each k consecutive hashes, by doubling: out[i] covers h[i : i + k]; empty if there are fewer."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    power = lambda e: np.uint64(pow(base, e, 1 << 64))
    level, span, out, done = h, 1, None, 0
    while True:
        if k & span:
            if out is None:
                out, done = level, span
            else:
                m = len(h) - (done + span) + 1
                out, done = out[:m] * power(span) + level[done : done + m], done + span
        if span * 2 > k:
            return out
        m = len(level) - span
        level, span = level[:m] * power(span) + level[span : span + m], span * 2


def sliding_argmin(v: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each w consecutive values, the rightmost among equals."""
    if len(v) < w:
        return np.zeros(0, np.int64)
    low, pos, span = v, np.arange(len(v), dtype=np.int64), 1
    while span < w:
        step = min(span, w - span)
        m = len(v) - (span + step) + 1
        right = low[step : step + m] <= low[:m]
        low, pos = np.where(right, low[step : step + m], low[:m]), np.where(right, pos[step : step + m], pos[:m])
        span += step
    return pos


def covered(first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places are covered by a run of ``length`` that starts at one of ``first``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, np.minimum(first + length, n), -1)
    return np.cumsum(step[:n]) > 0

"""Tokenizers of the installed library in Spark's Python workers: built once a process from a file's text, which the driver sends."""

from __future__ import annotations

import base64
import hashlib
import os

# One task uses one core; the library's own threads would take those of other tasks.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_BUILT: dict = {}


def once(key: str, build):
    """What ``build()`` gives, made once in a process for each key."""
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def bytes_to_chars() -> list[str]:
    """The usual stand-in character of each byte in byte-level vocabularies: printable Latin-1 characters stand for
    themselves, the rest for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {b: chr(b) for b in own}, 0x100
    for b in range(256):
        if b not in table:
            table[b] = chr(extra)
            extra += 1
    return [table[b] for b in range(256)]


def ranks_of(data: bytes) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base64 and its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The merges behind the ranks, in order: a token's last merge joins the two parts that lower ranks leave of it."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = min(((r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank), default=None)
            if found is None:
                break
            i = found[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def byte_level(data: bytes):
    """A tokenizer of the library for a rank file; each text given to it is one piece, and is merged as a whole."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    ranks, table = ranks_of(data), bytes_to_chars()
    chars = lambda t: "".join(table[b] for b in t)
    model = models.BPE({chars(t): r for t, r in ranks.items()}, [(chars(a), chars(b)) for a, b in merges_of(ranks)])
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer

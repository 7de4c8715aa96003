"""Character n-grams of a batch of texts, as arrays of hashed features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daytally.llm import bytes_np as B

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, its lower-cased letter, or a space where it is no letter (once per process)."""
    if not _letters:
        table = np.full(0x110000, 0x20, dtype=np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c <= 0xDFFF and (ch := chr(c)).isalpha():
                table[c] = ord(low) if len(low := ch.lower()) == 1 else c
        _letters.append(table)
    return _letters[0]


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of a string column; a null text is empty."""
    texts = pc.fill_null(column, "").to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), offsets


def letter_runs(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters with one space between words and around a text; (code points, document)."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    low = letters()[points]
    space = low == 0x20
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1] & (doc[1:] == doc[:-1]))
    low, doc = low[keep], doc[keep]
    # A space before each text's first and after its last letter, so that word edges count there too.
    n = len(offsets) - 1
    start, end = np.searchsorted(doc, np.arange(n)), np.searchsorted(doc, np.arange(n), side="right")
    at = np.concatenate([start, end])
    return (np.insert(low, at, np.uint32(0x20)), np.insert(doc, at, np.concatenate([np.arange(n), np.arange(n)])))


def ngrams(low: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of n code points inside one document, word gaps included."""
    m = len(low) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = low[:m].astype(np.uint64)
    for k in range(1, n):
        value = value * np.uint64(0x1FFFFFB) + low[k : k + m]
    inside = doc[:m] == doc[n - 1 :]
    return B.mix(value[inside] + np.uint64(n << 56)), doc[:m][inside]

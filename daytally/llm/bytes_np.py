"""Vectorised work on a batch of texts as one UTF-8 byte array with document offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# An odd multiplier with few factors of two in B-1 and B+1 keeps the polynomial hash mod 2^64 well spread.
BASE = 0x9E3779B97F4A7C15
_INV = pow(BASE, -1, 1 << 64)

# White space and the ASCII bytes that are neither digit nor letter.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_OTHER = np.zeros(256, dtype=bool)
ASCII_OTHER[:0x80] = True
ASCII_OTHER[0x30:0x3A] = ASCII_OTHER[0x61:0x7B] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i mod 2^64 for i < n, kept between calls."""
    if len(_powers["up"]) < n:
        for key, base in (("up", BASE), ("down", _INV)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes (a longer document stands alone)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] the polynomial sum of the first i bytes; windows come from ``window_hash``."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever the bytes stand; the length takes part."""
    _, down = powers(len(prefix))
    value = (prefix[end] - prefix[start]) * down[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each maximal run of non-separator bytes; runs end with their document."""
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~separator[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    edges = offsets[:-1]
    before[edges[edges < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    ends = offsets[1:] - 1
    after[ends[ends >= 0]] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1

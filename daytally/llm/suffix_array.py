"""Suffix arrays of a shard of byte strings, in numpy.

A shard holds many strings; suffixes end with their string.  ``suffix_array`` refines ranks as
Larsson and Sadakane do: suffixes are ordered by their first h bytes, only groups that are still
undecided are sorted again by the rank h places on, and h doubles until all are decided; equal
suffixes of different strings stay in the order of their strings, as the walk below needs.
``common_prefixes`` is Kasai's walk: along a string the common prefix with the suffix array's
predecessor shrinks by at most one byte per step, so it only ever extends.  All strings of the
shard are walked side by side.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """Strings as one array, with the suffix array and its inverse."""

    def __init__(self, strings: list[bytes], depth: int):
        self.depth = depth
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.end = np.repeat(self.first + self.size, self.size)
        self.order = suffix_array(self.data, self.end, int(self.size.max(initial=0)))
        self.rank = np.empty_like(self.order)
        self.rank[self.order] = np.arange(len(self.order))
        # The bytes from any position on can be read past the end.
        self.padded = np.concatenate([self.data, np.zeros(depth, np.uint8)])


def suffix_array(data: np.ndarray, end: np.ndarray, longest: int) -> np.ndarray:
    """Positions by their suffix, then by position; a suffix stops at ``end`` and has at most ``longest`` bytes."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    # Seven symbols of nine bits: bytes are 1 to 256, 0 is past the end.
    symbol = np.zeros(n + 7, dtype=np.int64)
    symbol[:n] = data
    symbol[:n] += 1
    at = np.arange(n)
    key = np.zeros(n, dtype=np.int64)
    for k in range(7):
        key <<= 9
        key |= np.where(at + k < end, symbol[k : k + n], 0)
    order = np.argsort(key)
    rank, open_slots = _ranks(key[order], order, np.arange(n), np.empty(n, np.int64))
    h = 7
    while h < longest and len(open_slots):
        part = order[open_slots]
        ahead = part + h
        inside = ahead < end[part]
        second = np.zeros(len(part), np.int64)
        second[inside] = rank[ahead[inside]] + 1
        key = rank[part] * (n + 1) + second  # read before the ranks are renewed
        key, part = _sorted(key, part)
        order[open_slots] = part
        rank, open_slots = _ranks(key, part, open_slots, rank)
        h *= 2
    # What is left are equal suffixes of different strings.
    part = order[open_slots]
    order[open_slots] = part[np.argsort(rank[part] * n + part)]
    return order


def _sorted(key: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, with their positions; sorting both in one number is much faster than an argsort."""
    bits = int(len(part) - 1).bit_length()
    if int(key.max()).bit_length() + bits > 63:
        moved = np.argsort(key)
        return key[moved], part[moved]
    both = np.sort((key << bits) | np.arange(len(part)))
    return both >> bits, part[both & ((1 << bits) - 1)]


def _ranks(key: np.ndarray, part: np.ndarray, slots: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of the sorted positions (the first slot of their group), and the slots still undecided."""
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(fresh)
    group = np.cumsum(fresh) - 1
    rank[part] = slots[starts][group]
    sizes = np.diff(np.append(starts, len(key)))
    return rank, slots[sizes[group] > 1]


def common_prefixes(shard: Shard) -> np.ndarray:
    """For every slot of a suffix with ``depth`` bytes, the bytes it shares with the slot before, up to ``depth``."""
    n, depth = len(shard.order), shard.depth
    lcp = np.zeros(n, dtype=np.int64)
    if n == 0:
        return lcp
    live = np.arange(len(shard.size))
    shared = np.zeros(len(shard.size), dtype=np.int64)
    step = 0
    while True:
        live = live[shard.size[live] - step >= depth]
        if not len(live):
            return lcp
        pos = shard.first[live] + step
        slot = shard.rank[pos]
        other = shard.order[slot - 1]
        have = np.maximum(shared[live] - 1, 0)
        have[slot == 0] = 0
        most = np.minimum(np.minimum(shard.end[pos] - pos, shard.end[other] - other), depth)
        grow = np.flatnonzero((slot > 0) & (have < most))
        while len(grow):
            same = shard.data[pos[grow] + have[grow]] == shard.data[other[grow] + have[grow]]
            grow = grow[same]
            have[grow] += 1
            grow = grow[have[grow] < most[grow]]
        lcp[slot] = have
        shared[live] = have
        step += 1


def repeated(shard: Shard) -> np.ndarray:
    """Whether the first ``depth`` bytes at a position also stand at another position of the shard."""
    n = len(shard.order)
    reach = common_prefixes(shard) >= shard.depth
    out = np.zeros(n, dtype=bool)
    out[shard.order] = reach | np.append(reach[1:], False) if n else reach
    return out


def found_in(shard: Shard, windows: np.ndarray) -> np.ndarray:
    """Which windows (rows of ``depth`` bytes) begin a suffix of the shard, by binary search in its suffix array."""
    n, depth = len(shard.order), shard.depth
    out = np.zeros(len(windows), dtype=bool)
    reach = np.arange(depth)
    for at in range(0, len(windows), 4096):
        part = windows[at : at + 4096]
        low, high = np.zeros(len(part), np.int64), np.full(len(part), n, np.int64)
        while (low < high).any():
            mid = np.minimum((low + high) // 2, n - 1)
            less = _compare(shard, shard.order[mid], part, reach) < 0
            going = low < high
            low = np.where(going & less, mid + 1, low)
            high = np.where(going & ~less, mid, high)
        hit = low < n
        out[at : at + 4096] = hit
        out[at : at + 4096][hit] = _compare(shard, shard.order[low[hit]], part[hit], reach) == 0
    return out


def _compare(shard: Shard, pos: np.ndarray, windows: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """-1, 0 or 1: the suffix's first bytes against each window."""
    text = shard.padded[pos[:, None] + reach].astype(np.int16)
    text[pos[:, None] + reach >= shard.end[pos][:, None]] = -1
    differ = text != windows
    where = differ.argmax(axis=1)
    rows = np.arange(len(pos))
    return np.sign(text[rows, where] - windows[rows, where].astype(np.int16))

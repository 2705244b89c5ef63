"""Burrows-Wheeler order and common prefixes of a collection, built column by column.

Round j inserts the suffix of length j of every string at once (one symbol per string): its
place among the suffixes so far follows from its first symbol and the place of the suffix of
length j - 1, and its common prefix with the neighbours from a range minimum over theirs.
"""

from __future__ import annotations

import numpy as np

_LOW = np.int64(0xFFFFFFFF)
_BLOCK = 64


class _RangeMinimum:
    def __init__(self, values: np.ndarray):
        self.values = values
        padded = np.full(-(-len(values) // _BLOCK) * _BLOCK, np.iinfo(values.dtype).max, dtype=values.dtype)
        padded[:len(values)] = values
        self.levels = [padded.reshape(-1, _BLOCK).min(axis=1)]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(self.levels[0]):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of values[low..high], ends included."""
        step = np.arange(_BLOCK)
        out = np.minimum(self.values[np.minimum(low[:, None] + step, high[:, None])].min(axis=1),
                         self.values[np.maximum(high[:, None] - step, low[:, None])].min(axis=1))
        first, stop = (low + _BLOCK - 1) // _BLOCK, (high + 1) // _BLOCK
        inner = np.flatnonzero(stop > first)
        level = np.frexp((stop - first)[inner])[1] - 1
        for k in np.unique(level):
            at = inner[level == k]
            table = self.levels[k]
            out[at] = np.minimum(out[at], np.minimum(table[first[at]], table[stop[at] - (1 << k)]))
        return out


def sorted_suffixes(symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every suffix, in sorted order, and its common prefix with the one before it.

    Strings are symbols[begin:begin + size]; symbols are small non-negative integers. Ends of
    strings sort first, by string, and are all different.
    """
    count = len(begin)
    place = np.arange(count)  # of the last inserted suffix of each string
    keys = np.arange(count, dtype=np.int64)  # first symbol (0: the end) and place of the rest
    prefix = np.zeros(count, dtype=np.int32)
    start = np.full(count, -1, dtype=np.int64)
    for length in range(1, int(size.max(initial=0)) + 1):
        active = np.flatnonzero(size >= length)
        where = begin[active] + size[active] - length
        new = (symbols[where].astype(np.int64) + 1) << 32 | place[active]
        order = np.argsort(new)
        active, where, new = active[order], where[order], new[order]
        at = np.searchsorted(keys, new)
        index = at + np.arange(len(at))
        minimum = _RangeMinimum(prefix)
        merged = np.insert(keys, at, new)
        before, after = merged[index - 1], merged[np.minimum(index + 1, len(merged) - 1)]
        own = np.zeros(len(at), dtype=np.int32)
        same = np.flatnonzero(before >> 32 == new >> 32)
        own[same] = 1 + minimum.least((before[same] & _LOW) + 1, new[same] & _LOW)
        follow = np.zeros(len(at), dtype=np.int32)
        same = np.flatnonzero((after >> 32 == new >> 32) & (index + 1 < len(merged)))
        follow[same] = 1 + minimum.least((new[same] & _LOW) + 1, after[same] & _LOW)
        prefix = np.insert(prefix, at, own)
        old_next = np.flatnonzero((index + 1 < len(merged)) & ~np.isin(index + 1, index))
        prefix[index[old_next] + 1] = follow[old_next]
        start = np.insert(start, at, where)
        moved = np.arange(len(keys)) + np.cumsum(np.bincount(at, minlength=len(keys) + 1))[:len(keys)]
        keys = merged >> 32 << 32 | moved[merged & _LOW]
        place[active] = index
    return start[count:], prefix[count:]

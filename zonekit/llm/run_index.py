"""Run-length index over a group of short byte strings (used inside tasks).

The strings of a group are sorted as one text with separators (suffix array by
prefix doubling), whose Burrows-Wheeler transform is kept by runs: one symbol
and length per run, with the suffix positions sampled at both ends of each.

Matching statistics are streamed from the samples alone: inside a run, the
longest match of a suffix with its neighbour in sorted order is one shorter than
that of the suffix one position to the left, so only the run ends' matches are
compared byte by byte, and one pass over the text fills in the rest. Several
groups share one index for speed; suffixes of different groups never match.
"""

from __future__ import annotations

import numpy as np

_PACK = 7  # symbols of 9 bits in one comparison


class RunIndex:
    def __init__(self, data: np.ndarray, starts: np.ndarray, groups: np.ndarray):
        """``data``: the strings back to back; ``starts``: where each begins;
        ``groups``: the group of each, in increasing order."""
        m = len(starts)
        lengths = np.diff(np.append(starts, len(data)))
        n = len(data) + m
        self.end = np.repeat((starts + np.arange(m) + lengths).astype(np.int32), lengths + 1)  # the separator after each string
        symbol = np.zeros(n, np.int16)
        symbol[self.end > np.arange(n, dtype=np.int32)] = data.astype(np.int16) + 1
        group = np.repeat(np.asarray(groups, np.int32), lengths + 1)
        self.pack = self._packs(symbol)
        order = self._sorted(group)
        # the transform, by runs; a separator is a symbol of its own each time
        before = symbol[order - 1]  # the last place of all is a separator, as it were before the first
        head = np.ones(n, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0) | (group[order[1:]] != group[order[:-1]])
        at = np.flatnonzero(head)
        tail = np.append(at[1:], n) - 1
        self.run_symbol, self.run_length = before[at], tail - at + 1
        self.head_sample, self.tail_sample = order[at], order[tail]
        # the sampled ends' neighbours in sorted order (-1: none in the group)
        self.head_before = np.where((at > 0) & (group[order[at - 1]] == group[order[at]]), order[at - 1], -1)
        after = order[np.minimum(tail + 1, n - 1)]
        self.tail_after = np.where((tail + 1 < n) & (group[after] == group[order[tail]]), after, -1)

    def _packs(self, symbol: np.ndarray) -> np.ndarray:
        """The next symbols of each position as one number, zeros after the separator."""
        out = np.zeros(len(symbol), np.int64)
        alive = np.ones(len(symbol), bool)
        for j in range(_PACK):
            out <<= 9
            out[:len(symbol) - j] |= np.where(alive[:len(symbol) - j], symbol[j:], np.int16(0))
            alive[:len(symbol) - j] &= symbol[j:] != 0
            alive[len(symbol) - j:] = False
        return out

    def _sorted(self, group: np.ndarray) -> np.ndarray:
        """Positions in sorted order of their suffixes, by group."""
        n = len(group)
        order = np.lexsort((self.pack, group)).astype(np.int32)
        place = np.arange(n, dtype=np.int32)
        whole = self.end - place < _PACK  # reaches its separator: differs from all others
        new = np.ones(n, bool)
        new[1:] = (self.pack[order][1:] != self.pack[order][:-1]) | (group[order][1:] != group[order][:-1]) | whole[order][1:]
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, place, 0))
        tied = order[~new | np.append(~new[1:], False)]
        step = _PACK
        while len(tied):
            key = rank[tied].astype(np.int64) * n + rank[tied + step]
            tied = tied[np.argsort(key, kind="stable")]
            old, second = rank[tied], rank[tied + step]
            bucket = np.ones(len(tied), bool)
            bucket[1:] = old[1:] != old[:-1]
            index = np.arange(len(tied), dtype=np.int32)
            slot = old + index - np.maximum.accumulate(np.where(bucket, index, 0))
            new = bucket.copy()
            # a second part that reaches its separator has a rank of its own, so equal ranks are equal symbols
            new[1:] |= second[1:] != second[:-1]
            rank[tied] = np.maximum.accumulate(np.where(new, slot, 0))
            tied = tied[~new | np.append(~new[1:], False)]
            step *= 2
        order = np.empty(n, np.int32)
        order[rank] = place
        return order

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at a and b agree."""
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        out = np.zeros(len(a), np.int32)
        live = np.arange(len(a))
        while len(live):
            x = self.pack[a[live] + out[live]] ^ self.pack[b[live] + out[live]]
            same = np.zeros(len(live), np.int32)
            for j in range(1, _PACK + 1):
                same += (x >> (9 * (_PACK - j))) == 0
            out[live] += same
            live = live[(same == _PACK) & (out[live] < most[live])]
        return np.minimum(out, most)

    def matches(self) -> np.ndarray:
        """For each byte of the data, the length of the longest string from there (within
        its own string) that also starts elsewhere in the group."""
        best = np.zeros(len(self.end), np.int32)
        for sample, neighbour in ((self.head_sample, self.head_before), (self.tail_sample, self.tail_after)):
            reach = np.zeros(len(self.end), np.int32)
            reach[sample] = sample
            has = neighbour >= 0
            reach[sample[has]] += self._match(sample[has], neighbour[has])
            np.maximum(best, np.maximum.accumulate(reach), out=best)
        length = np.maximum(best - np.arange(len(best), dtype=np.int32), 0)
        return np.delete(length, np.unique(self.end))


__all__ = ["RunIndex"]

"""A compressed full-text index over sequences of words: suffix order, wavelet matrix, least owner per interval.

Small and in memory: one index serves one shard. All searches of a shard run side by side as arrays.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes, in the order of their first ``depth`` symbols at least (prefix doubling)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, reach = np.argsort(rank, kind="stable"), 1
    while reach < depth:
        second = np.zeros(n, np.int64)
        second[: n - reach] = rank[reach:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        reach *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


class Bits:
    """A packed bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])

    def rank(self, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & low)


class WaveletMatrix:
    """Symbols by bit levels; counts of a symbol before a place in one step per level."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(alphabet)
        self.begin = self._down(every, np.zeros(alphabet, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            r = ones.rank(i)
            i = np.where(symbol >> bit & 1, zeros + r, i - r)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._down(symbol, i) - self.begin[symbol]


class FMIndex:
    """Backward search over the given sequences, each with an owner (a number below 2^31); symbol 0 closes a sequence.

    Intervals hold for patterns shorter than ``depth``.
    """

    def __init__(self, text: np.ndarray, owners: np.ndarray, depth: int):
        order = suffix_order(text, depth)
        alphabet = int(text.max()) + 1
        self.bwt = WaveletMatrix(text[order - 1], alphabet)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))[:-1]])
        # Least owner of 2**j suffixes from each place.
        least = [owners[order].astype(np.int32)]
        while 2 << (len(least) - 1) <= len(text):
            last, half = least[-1], 1 << (len(least) - 1)
            least.append(np.minimum(last[:-half], last[half:]))
        self.log = np.zeros(len(text) + 1, np.int8)
        for j in range(1, len(least)):
            self.log[1 << j :] = j
        self.flat = np.concatenate(least)
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in least])[:-1]])
        self.size = len(text)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        both = self.bwt.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        begin = self.first[symbol]
        return begin + both[: len(lo)], begin + both[len(lo) :]

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of non-empty intervals."""
        j = self.log[hi - lo].astype(np.int64)
        row = self.at[j]
        return np.minimum(self.flat[row + lo], self.flat[row + hi - (1 << j)])


def matched_windows(index: FMIndex, text: np.ndarray, start: np.ndarray, length: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """For each place of ``text``: does a window of ``width`` symbols begin there that also occurs under a smaller owner.

    Sequence q lies at ``start[q]``; windows lie inside sequences. A search runs backward from the end
    of a candidate window as long as a smaller owner has what it read. Where it breaks off, every
    window over the break is ruled out at once, so unmatched text is mostly skipped. After a
    match the rest of the sequence is tried in one long search.
    """
    found = np.zeros(len(text), bool)
    q = np.flatnonzero(length >= width)
    s, last = start[q], start[q] + length[q] - width  # undecided windows begin at s..last
    who, long = owner[q], np.zeros(len(q), bool)
    place = s + width
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), index.size, np.int64)
    while len(s):
        place = place - 1
        lo, hi = index.extend(text[place], lo, hi)
        alive = lo < hi
        alive[alive] = index.least_owner(lo[alive], hi[alive]) < who[alive]
        done = alive & (place == s)
        over = done | ~alive
        if over.any():
            # A whole search: its windows begin at s (or s..last).
            for k in np.flatnonzero(done):
                found[s[k] : (last[k] if long[k] else s[k]) + 1] = True
            for k in np.flatnonzero(~alive & long):
                found[place[k] + 1 : last[k] + 1] = True
            broke, reach = ~alive & long, ~alive & ~long
            last = np.where(broke, np.where(place < last, place, last - 1), last)
            s = np.where(reach, place + 1, np.where(done, np.where(long, last + 1, s + 1), s))
            long = np.where(over, done & ~long, long)
            place = np.where(over, np.where(long, last, s) + width, place)
            lo, hi = np.where(over, 0, lo), np.where(over, index.size, hi)
            go = s <= last
            s, last, who, long, place, lo, hi = (x[go] for x in (s, last, who, long, place, lo, hi))
    return found

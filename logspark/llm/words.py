"""Words of whole Arrow batches as numpy arrays: places in the text and 64-bit hashes.

All work is on the UTF-8 bytes of a batch at once. Two words are taken as equal when their hashes
are; users that need certainty compare the bytes of the few words that matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about this size, so that memory does not follow the batch.
SLICE_BYTES = 1 << 21
_PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)


def byte_class(spaces: bytes = b"\t\n\x0b\x0c\r ") -> np.ndarray:
    """Table of the bytes that make words: all but the given ones."""
    table = np.ones(256, bool)
    table[list(spaces)] = False
    return table


#: Words of the benchmark contract: digits, letters and everything beyond ASCII.
ALPHANUMERIC = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
#: Words between white space.
NOT_SPACE = byte_class()
#: Byte values with A-Z taken as a-z, and as they are.
FOLDED = _RANDOM[np.frombuffer(bytes(range(256)).lower(), np.uint8)]
EXACT = _RANDOM


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


def string_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and where each text begins (one more entry at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or places[0] == places[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches where their texts pass SLICE_BYTES; a longer text is a slice of its own."""
    for batch in batches:
        lengths = np.diff(string_bytes(batch.column(text))[1])
        group = np.cumsum(lengths) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class Words:
    """Words of a run of texts: ``start``/``end`` byte places, ``hash``, and ``first`` word of each text."""

    def __init__(self, data: np.ndarray, places: np.ndarray, classes: np.ndarray, values: np.ndarray):
        self.data, self.places = data, places
        inside = classes[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = places[:-1][np.diff(places) > 0]
        begins[at] = inside[at]
        after = np.ones(len(data), bool)
        after[:-1] = ~inside[1:] | begins[1:]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.start, places)
        self.hash = self._hashes(values)

    def _hashes(self, values: np.ndarray) -> np.ndarray:
        """Sums over the bytes of a word, each mixed with its place in the word before it is added."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + _PIECE, "right")))
            begin, length = self.start[i:j], self.end[i:j] - self.start[i:j]
            if j == i + 1:
                pieces = range(0, length[0], _PIECE)
                out[i] = np.array([self._mixed(values, begin[0] + k, k, min(_PIECE, length[0] - k)).sum() for k in pieces]).sum()
            else:
                first = np.cumsum(length) - length
                place = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
                out[i:j] = np.add.reduceat(self._mixed(values, np.repeat(begin, length) + place, place), first)
            out[i:j] = scramble(out[i:j] + length.astype(np.uint64))
            i = j
        return out

    def _mixed(self, values: np.ndarray, at, place, count: int | None = None) -> np.ndarray:
        """Of the bytes at the given places, or of ``count`` bytes from one place on."""
        if count is not None:
            at, place = slice(at, at + count), np.arange(place, place + count)
        return scramble(values[self.data[at]] + (place.astype(np.uint64) + np.uint64(1)) * _ODD)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self, i: int, j: int) -> bytes:
        """Bytes from word i to the end of word j - 1."""
        return self.data[self.start[i] : self.end[j - 1]].tobytes() if j > i else b""


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive words, regardless of where texts end."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    up = _powers(_ODD, len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:-1], out=sums[1:])
    n = len(words) - width + 1
    return scramble((sums[width:] - sums[:n]) * _powers(_INVERSE, n))

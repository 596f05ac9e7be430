"""Fill-in-middle transformation of whole texts, with cuts between tokens.

A token is a run of ASCII letters or any other single character. A text of n tokens is cut at two
places into prefix, middle and suffix, and put together again with a sentinel before each part, so
that a model learns to write the middle from both sides. Draws are digits of a digest of the seed
and the doc_id: they depend on neither partitions nor tries.

Texts stay UTF-8 bytes. Where they are ASCII, byte places are code points; a sparse index holds
only the characters of more than one byte, by their places and by the excess bytes summed so far.
``CharIndex`` turns cuts of one kind into the other by a binary search in it.

Defined cases: a null or empty text is plain with no tokens; a text that holds a sentinel is plain;
a null doc_id draws like an empty one; repeated rows give repeated rows; an empty table gives an
empty result; further columns are dropped. Of a batch only slices of about 2 MB are in work; a
longer text is a slice of its own and takes about ten times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import only
from logspark.llm.words import string_bytes, text_slices

#: Before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Texts in a hundred that are cut, and of these the ones with the suffix first.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


class CharIndex:
    """Characters of more than one byte in UTF-8 ``data``: their places and the excess bytes so far."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(excess)))
        self.char = self.at - self.excess[:-1]

    def chars(self, byte_places: np.ndarray) -> np.ndarray:
        """Code points before each byte place, which is the start of a character or the end."""
        return byte_places - self.excess[np.searchsorted(self.at, byte_places)]

    def bytes(self, char_places: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return char_places + self.excess[np.searchsorted(self.char, char_places)]


def token_starts(data: np.ndarray, places: np.ndarray, index: CharIndex) -> np.ndarray:
    """Code points at which tokens start; texts end at ``places`` (bytes)."""
    letter = _LETTER[data]
    starts = ~letter
    starts &= (data & 0xC0) != 0x80
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    first = places[:-1][np.diff(places) > 0]
    begins[first] = letter[first]
    return index.chars(np.flatnonzero(starts | begins))


def _assembled(parts: tuple[bytes, bytes, bytes], form: str, sentinels: Sequence[bytes]) -> bytes:
    (before, middle, after), (p, s, m) = parts, sentinels
    return p + before + s + after + m + middle if form == PSM else s + after + p + before + m + middle


def _transform(
    batches: Iterator[pa.RecordBatch], sentinels: Sequence[str], cut_percent: int, suffix_first_percent: int
) -> Iterator[pa.RecordBatch]:
    marks = [s.encode() for s in sentinels]
    for batch in text_slices(batches):
        data, places = string_bytes(batch.column("text"))
        index = CharIndex(data)
        starts = token_starts(data, places, index)
        ends = index.chars(places)
        first = np.searchsorted(starts, ends)
        n = np.diff(first)
        h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5))
        a, b = h1 % (n + 1), h2 % (n + 1)
        # The cut after the last token is the end of the text, which is where the next text starts.
        edges = np.append(starts, ends[-1])
        cuts = [np.where(k == n, ends[1:], edges[first[:-1] + k]) for k in (np.minimum(a, b), np.maximum(a, b))]
        low, high = (index.bytes(c) for c in cuts)
        raw, outputs, forms = data.tobytes(), [], []
        for i in range(len(n)):
            text = raw[places[i] : places[i + 1]]
            plain = not text or h3[i] % 100 >= cut_percent or any(mark in text for mark in marks)
            forms.append(PLAIN if plain else SPM if h4[i] % 100 < suffix_first_percent else PSM)
            parts = (raw[places[i] : low[i]], raw[low[i] : high[i]], raw[high[i] : places[i + 1]])
            outputs.append(text if plain else _assembled(parts, forms[-1], marks))
        plain = np.array([form == PLAIN for form in forms], bool)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                pa.array(cuts[0] - ends[:-1], pa.int64(), mask=plain), pa.array(cuts[1] - cuts[0], pa.int64(), mask=plain),
                pa.array(outputs, pa.binary()).cast(pa.string(), safe=False),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def draws(seed: int, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex digest of seed and doc_id, as integers h1, h2, ..."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(count)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    sentinels: Sequence[str] = SENTINELS,
    cut_percent: int = CUT_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): tokens ``n``, ``form``, lengths in code points, and the ``output`` text."""
    if len(set(sentinels)) != 3 or any(not s or s[0] in s[1:] for s in sentinels) or len({s[0] for s in sentinels}) != 1:
        raise ValueError("three different sentinels are needed, with one first character that stands nowhere else in them")
    rows = only(docs, doc_id="long", text="string").select("doc_id", "text", *draws(seed))
    made = partial(
        _transform, sentinels=list(sentinels), cut_percent=cut_percent, suffix_first_percent=suffix_first_percent
    )
    return rows.mapInArrow(made, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored_text(output: str = "output", form: str = "form", sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that an output was made from, found by the sentinels alone.

    No text with a sentinel is cut, and a sentinel cannot begin inside another, so each is found where it was put.
    """
    p, s, m = sentinels
    text, size = F.col(output), F.length(output)

    def between(start: Column, end: Column) -> Column:
        return F.substr(text, start, end - start)

    def place(mark: str) -> Column:
        return F.locate(mark, text)

    lengths = {mark: len(mark) for mark in sentinels}
    middle = between(place(m) + lengths[m], size + 1)
    psm = F.concat(
        between(F.lit(lengths[p] + 1), place(s)), middle, between(place(s) + lengths[s], place(m))
    )
    spm = F.concat(
        between(place(p) + lengths[p], place(m)), middle, between(F.lit(lengths[s] + 1), place(p))
    )
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(text)

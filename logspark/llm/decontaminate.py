"""Benchmark passages inside documents, found by Wu-Manber search over words.

Patterns are windows of consecutive benchmark words. For patterns of m words a shift table over
blocks of two words tells how far a search may jump without missing a pattern; where the jump is
zero, the hash of the block that ends there selects the test strings, and these are compared with
the document's words directly. Many documents are searched at a time, each slice of a document at a
place of its own. Patterns shorter than the window (items with few words) have tables of their own.

The benchmark is a stated query set: it is cut into blocks of bounded size, and each block is
searched for in all documents. Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import only, saved
from logspark.llm.words import ALPHANUMERIC, FOLDED, Words, scramble, string_bytes, text_slices, window_hashes

#: Windows of a document that one lane of a search walks over.
LANE = 256
#: Blocks of the benchmark that are searched for before the spans found so far are written.
BLOCKS_PER_STAGE = 4
SPANS = "doc_id long, text string, spans binary, items binary"


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return scramble(left * np.uint64(0x9E3779B97F4A7C15) + right)


class WuManber:
    """Search for patterns of ``m`` words each.

    ``rows``: an array of distinct patterns, one row of word hashes each; ``texts``: the words as
    bytes; ``items``: for each pattern the ids of the items that hold it.
    """

    def __init__(self, rows: np.ndarray, texts: list[list[bytes]], items: list[list[str]]):
        self.m = rows.shape[1]
        self.block = min(2, self.m)
        whole = np.array([window_hashes(r, self.m)[0] for r in rows], np.uint64)
        order = np.argsort(whole)
        self.whole = whole[order]
        self.texts, self.items = [texts[i] for i in order], [items[i] for i in order]
        bits = int(np.clip(np.ceil(np.log2(len(rows) * self.m)) + 5, 12, 24))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.m - self.block + 1, np.uint8 if self.m < 250 else np.int64)
        for j in range(self.m - self.block + 1):
            keys = self._key(rows[:, j], rows[:, j + 1] if self.block == 2 else None) >> self.down
            np.minimum.at(self.shift, keys, self.m - self.block - j)

    def _key(self, left: np.ndarray, right: np.ndarray | None) -> np.ndarray:
        return scramble(left) if right is None else _pairs(left, right)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First words of the occurrences, and the pattern of each."""
        h = words.hash
        lanes = [(np.arange(a + self.m - 1, b, LANE), b) for a, b in zip(words.first, words.first[1:]) if b - a >= self.m]
        if not lanes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate([a for a, _ in lanes])
        stop = np.minimum(at + LANE, np.repeat([b for _, b in lanes], [len(a) for a, _ in lanes]))
        ends = []
        while len(at):
            key = self._key(h[at - 1], h[at]) if self.block == 2 else self._key(h[at], None)
            jump = self.shift[key >> self.down]
            ends.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        begin = np.sort(np.concatenate(ends)) - (self.m - 1)
        # The bucket: patterns whose words have the hash of the words that end here.
        value = np.zeros(len(begin), np.uint64)
        step = np.uint64(1)
        for j in range(self.m):
            value += h[begin + j] * step
            step = np.uint64(int(step) * 0x9E3779B97F4A7C15 % 2**64)
        value = scramble(value)
        slot = np.minimum(np.searchsorted(self.whole, value), len(self.whole) - 1)
        hit = self.whole[slot] == value
        begin, slot = begin[hit], slot[hit]
        same = np.fromiter((self._same(words, i, p) for i, p in zip(begin, slot)), bool, len(begin))
        return begin[same], slot[same]

    def _same(self, words: Words, i: int, pattern: int) -> bool:
        return all(words.text_of(i + j, i + j + 1).lower() == w for j, w in enumerate(self.texts[pattern]))


def build_tables(items: list[tuple[str | None, str]], width: int) -> list[WuManber]:
    """One search for each pattern length of the given (item id, text) pairs."""
    data, places = string_bytes(pa.array([t for _, t in items], pa.string()))
    words = Words(data, places, ALPHANUMERIC, FOLDED)
    by_length: dict[int, dict[tuple, tuple]] = {}
    for (name, _), a, b in zip(items, words.first, words.first[1:]):
        m = min(width, b - a)
        for i in range(a, b - m + 1 if m else a):
            text = tuple(words.text_of(i + j, i + j + 1).lower() for j in range(m))
            found = by_length.setdefault(m, {}).setdefault(text, (words.hash[i : i + m], []))
            if name is not None and (not found[1] or found[1][-1] != name):
                found[1].append(name)
    return [WuManber(np.array([v[0] for v in p.values()]), [list(k) for k in p], [v[1] for v in p.values()]) for p in by_length.values()]


def _search(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        words = Words(*string_bytes(batch.column("text")), ALPHANUMERIC, FOLDED)
        spans = [[s.as_py() or b""] for s in batch.column("spans")]
        items: list[set] = [set(filter(None, (s.as_py() or b"").decode().split("\0"))) for s in batch.column("items")]
        for table in tables.value:
            begin, pattern = table.find(words)
            doc = np.searchsorted(words.first, begin, "right") - 1
            for d in np.unique(doc):
                of = doc == d
                begins = begin[of] - words.first[d]
                spans[d].append(np.stack([begins, begins + table.m], 1).astype("<i8").tobytes())
                items[d].update(n for p in np.unique(pattern[of]) for n in table.items[p])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array([b"".join(s) for s in spans], pa.binary()),
             pa.array(["\0".join(sorted(i)).encode() for i in items], pa.binary())],
            names=["doc_id", "text", "spans", "items"],
        )


def _report(batches: Iterator[pa.RecordBatch], carry: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        words = Words(*string_bytes(batch.column("text")), ALPHANUMERIC, FOLDED)
        counts = words.counts()
        hit, ids = [], []
        for n, s, i in zip(counts, batch.column("spans"), batch.column("items")):
            edges = np.frombuffer(s.as_py(), "<i8").reshape(-1, 2)
            covered = np.zeros(n + 1, np.int64)
            np.add.at(covered, edges[:, 0], 1)
            np.add.at(covered, edges[:, 1], -1)
            hit.append(int((np.cumsum(covered)[:n] > 0).sum()) if len(edges) else 0)
            ids.append([x for x in i.as_py().decode().split("\0") if x])
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in carry]
            + [pa.array(counts, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
               pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids]), pa.array([x > 0 for x in hit])],
            names=[*carry, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def _clean(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    """The rows whose texts hold no pattern."""
    for batch in text_slices(batches):
        words = Words(*string_bytes(batch.column("text")), ALPHANUMERIC, FOLDED)
        clean = np.ones(batch.num_rows, bool)
        for table in tables.value:
            begin, _ = table.find(words)
            clean[np.searchsorted(words.first, begin, "right") - 1] = False
        yield batch.filter(pa.array(clean))


def pattern_blocks(benchmark: DataFrame, width: int, block_bytes: int) -> Iterator[list[WuManber]]:
    """Search tables for the benchmark (item_id, text), block by block; each is made from ``block_bytes`` on average."""
    asked = only(benchmark, item_id="string", text="string").where(F.length("text") > 0)
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for k in range(blocks):
        of = asked.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("item_id", "text")
        if tables := build_tables([(r.item_id, r.text) for r in of.collect()], width):
            yield tables


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 4_000_000) -> DataFrame:
    """Per document: words, words inside benchmark windows, items with such windows.

    Words are runs of digits, letters and non-ASCII characters, A-Z taken as a-z. A null or empty
    text has no words. Items without words have no windows; a null item id counts for hits, but is
    not listed. Repeated documents are judged one by one, repeated items are one. Extra columns are
    dropped. ``block_bytes`` bounds the benchmark text that is broadcast at a time.
    """
    spark = docs.sparkSession
    found = only(docs, doc_id="long", text="string").withColumns(
        {"spans": F.lit(b""), "items": F.lit(b"")}
    )
    for k, tables in enumerate(pattern_blocks(benchmark, width, block_bytes)):
        if k and k % BLOCKS_PER_STAGE == 0:
            found = saved(found, "contamination")
        found = found.mapInArrow(partial(_search, tables=spark.sparkContext.broadcast(tables)), SPANS)
    return found.mapInArrow(
        partial(_report, carry=["doc_id"]),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 4_000_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``text`` holds no benchmark window."""
    for k, tables in enumerate(pattern_blocks(benchmark, width, block_bytes)):
        if k and k % BLOCKS_PER_STAGE == 0:
            docs = saved(docs, "uncontaminated")
        docs = docs.mapInArrow(partial(_clean, tables=docs.sparkSession.sparkContext.broadcast(tables)), docs.schema)
    return docs

"""Long passages that an earlier document holds too, removed word by word.

Documents are streamed against FM-indexes, one per shard. So that a window of words meets its
repeats in one shard, and is searched there only, shards are made by content: each window belongs
to its anchor, the least hash of its short word runs, and a shard holds the segments (runs of windows
with one anchor) of some anchors. Equal segments are one, filed under their smallest document, before any
text moves; anchors of one document, or of one segment, need no search at all. What is left is
indexed, and each segment is streamed backward through its shard's index: the length that a smaller
document matches at each place (its matching statistic) tells the windows that are repeats.

An anchor with very many different segments would make a shard too large. Its windows are decided
by 128-bit digests with grouped minima instead, which is as exact and has no limit.

Words are compared by 64-bit hashes, segments and windows of many words by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import only, saved
from logspark.llm.fm_index import FMIndex, matched_windows
from logspark.llm.words import EXACT, NOT_SPACE, Words, scramble, string_bytes, text_slices, window_hashes

#: Words of the runs that anchors are chosen from; windows of a segment at most.
RUN, SEGMENT = 8, 64
#: Words of a shard on average; segments of an anchor that are indexed, at most.
SHARD_WORDS, ANCHOR_SEGMENTS = 300_000, 2_000
KEY = ["anchor", "s1", "s2"]
SEGMENTS = "anchor long, s1 long, s2 long, doc_id long, row long, start int, windows int"
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _digests(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each run of words, as two signed integers."""
    out = []
    for base in _BASES:
        up = np.full(len(words) + 1, base, np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        down = np.full(len(words) + 1, pow(base, -1, 2**64), np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(scramble(words ^ np.uint64(base)) * up[:-1], out=sums[1:])
        out.append(scramble((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _segments(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, anchor, first window and number of windows of each segment of all texts."""
    none = np.zeros(0, np.int64)
    counts = words.counts()
    n = np.maximum(counts - width + 1, 0)
    if not n.sum():
        return none, none, none, none
    run = min(RUN, width)
    least = _sliding_min(window_hashes(words.hash, run), width - run + 1)
    text = np.repeat(np.arange(len(n)), n)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = words.first[text] + rank
    anchor = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
    since = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= since % SEGMENT == 0
    first = np.flatnonzero(new)
    return text[first], anchor[first].view(np.int64), at[first], np.diff(np.append(first, len(at)))


def _list_segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        words = Words(*string_bytes(batch.column("text")), NOT_SPACE, EXACT)
        text, anchor, at, windows = _segments(words, width)
        s1, s2 = _digests(words.hash, at, at + windows + width - 1)
        of = pa.array(text)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(s1), pa.array(s2), batch.column("doc_id").take(of), batch.column("row").take(of),
             pa.array((at - words.first[text]).astype(np.int32)), pa.array(windows.astype(np.int32))],
            names=[*KEY, "doc_id", "row", "start", "windows"],
        )


def _cut_segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The words, as hashes, of the segments (in ``wanted``) of each text."""
    names = [*KEY, "owner", "many", "hashes"]
    for batch in text_slices(batches):
        words = Words(*string_bytes(batch.column("text")), NOT_SPACE, EXACT)
        out: dict[str, list] = {n: [] for n in names}
        for first, doc, wanted in zip(words.first, batch.column("doc_id").to_pylist(), batch.column("wanted").to_pylist()):
            for w in wanted:
                begin = first + w["start"]
                row = (w["anchor"], w["s1"], w["s2"], doc, w["many"], words.hash[begin : begin + w["windows"] + width - 1].tobytes())
                for name, value in zip(names, row):
                    out[name].append(value)
        kinds = {"many": pa.bool_(), "hashes": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(out[n], kinds.get(n, pa.int64())) for n in names], names=names)


def _search_shard(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Index all segments of a partition and stream them through the index."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    shard = pa.Table.from_batches(parts)
    hashes = [np.frombuffer(h.as_py(), np.uint64) for h in shard.column("hashes")]
    length = np.array([len(h) for h in hashes])
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    text = np.zeros(int((length + 1).sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[start + length] = False
    text[inside] = np.unique(np.concatenate(hashes), return_inverse=True)[1] + 1
    owner = np.unique(shard.column("owner").to_numpy(), return_inverse=True)[1].astype(np.int64)
    index = FMIndex(text, np.repeat(owner, length + 1), width + 2 * SEGMENT)
    found = matched_windows(index, text, start, length, owner, width)
    edge = np.diff(np.concatenate([[False], found, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # never over a sequence's end: no window begins there
    of = np.searchsorted(start, begin, "right") - 1
    taken = shard.select(KEY).take(pa.array(of))
    yield from taken.append_column("a", pa.array((begin - start[of]).astype(np.int32))).append_column(
        "b", pa.array((end - start[of]).astype(np.int32))
    ).combine_chunks().to_batches()


def _expand_windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = [np.frombuffer(h.as_py(), np.uint64) for h in batch.column("hashes")]
        n = np.array([len(h) - width + 1 for h in hashes])
        of = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        length = np.array([len(h) for h in hashes])
        begin = (np.cumsum(length) - length)[of] + place
        w1, w2 = _digests(np.concatenate(hashes), begin, begin + width) if len(of) else (np.zeros(0, np.int64),) * 2
        at = pa.array(of)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(at) for c in [*KEY, "owner"]), pa.array(place.astype(np.int32)), pa.array(w1), pa.array(w2)],
            names=[*KEY, "owner", "place", "w1", "w2"],
        )


def _by_digest(cut: DataFrame, width: int) -> DataFrame:
    """Windows of the given segments that a smaller owner has too, by digest."""
    windows = cut.mapInArrow(
        partial(_expand_windows, width=width),
        "anchor long, s1 long, s2 long, owner long, place int, w1 long, w2 long",
    )
    least = windows.groupBy("w1", "w2").agg(F.min("owner").alias("least"), F.max("owner").alias("most")).where("least < most")
    return windows.join(least.drop("most"), ["w1", "w2"]).where("least < owner").select(
        *KEY, F.col("place").alias("a"), (F.col("place") + 1).alias("b")
    )


def _matching(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by document row."""
    return left.join(right, [left["doc_id"].eqNullSafe(right["k_doc"]), left["row"] == right["k_row"]], how)


def _keys() -> list[Column]:
    return [F.col("doc_id").alias("k_doc"), F.col("row").alias("k_row")]


def repeated_spans(docs: DataFrame, width: int = 50) -> DataFrame:
    """Spans of words [a, b) of windows that a smaller doc_id has too: (k_doc, k_row, spans), one row per document.

    ``docs`` has doc_id, text and ``row``, which tells texts with one doc_id apart.
    """
    known = docs.where("doc_id is not null and text is not null")
    listed = saved(known.mapInArrow(partial(_list_segments, width=width), SEGMENTS), "segments")
    # Written, as are the other small sides below: a join splits a hot key only where both its sides are dealt for it.
    shared = saved(
        listed.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("anchor"),
        "shared-anchors",
    )
    one = F.struct("doc_id", "row", "start", "windows")
    # A segment's words name its anchor. Grouped by the digest alone, the rows of a common anchor are
    # combined where the join, split if need be, leaves them, and then dealt anew.
    segments = saved(
        listed.join(shared, "anchor", "left_semi").groupBy("s1", "s2")
        .agg(F.min("anchor").alias("anchor"), F.min(one).alias("at")), "distinct-segments",
    )
    per_anchor = saved(segments.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    wanted = saved(
        segments.join(per_anchor, "anchor")
        .select("at.doc_id", "at.row", F.struct(*KEY, "at.start", "at.windows", (F.col("n") > ANCHOR_SEGMENTS).alias("many")).alias("w"))
        .groupBy(*_keys()).agg(F.array_sort(F.collect_list("w")).alias("wanted")), "wanted",
    )
    # One shuffle of the texts: rows that are equal lie where the join has dealt them.
    holders = known.join(wanted, (known["doc_id"] == wanted["k_doc"]) & (known["row"] == wanted["k_row"]))
    cut = saved(
        holders.dropDuplicates(["doc_id", "row"]).select("doc_id", "text", "wanted")
        .mapInArrow(partial(_cut_segments, width=width), "anchor long, s1 long, s2 long, owner long, many boolean, hashes binary"),
        "cut",
    )
    indexed = cut.where("not many")
    size = indexed.agg(F.sum(F.length("hashes"))).first()[0] or 0
    shards = max(1, -(-size // (8 * SHARD_WORDS)))
    found = indexed.repartition(shards, "anchor").mapInArrow(
        partial(_search_shard, width=width), "anchor long, s1 long, s2 long, a int, b int"
    ).unionAll(_by_digest(cut.where("many"), width))
    ranges = found.groupBy(*KEY).agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    facts = saved(segments.select(*KEY, F.col("at.doc_id").alias("least")).join(ranges, KEY, "left"), "facts")
    hit = F.when(F.col("doc_id") > F.col("least"), F.array(F.struct(F.lit(0).alias("a"), F.col("windows").alias("b")))).otherwise(F.col("ranges"))
    return (
        listed.join(facts, KEY).select(*_keys(), "start", F.explode(hit).alias("r"))
        .select("k_doc", "k_row", F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + width - 1).alias("b")).alias("span"))
        .groupBy("k_doc", "k_row").agg(F.collect_set("span").alias("spans"))
    )


def _keep(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        counts, removed, digests, kept_texts = [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            n = len(words)
            if spans:
                edge = np.zeros(n + 1, np.int64)
                at = np.array([(s["a"], s["b"]) for s in spans])
                np.add.at(edge, at[:, 0], 1)
                np.add.at(edge, at[:, 1], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:n] == 0)]
            kept = b" ".join(words)
            counts.append(n)
            removed.append(n - len(words))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept if texts else b"")
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if texts:
            columns, names = [*columns, pa.array([k.decode("utf-8", "surrogatepass") for k in kept_texts])], [*names, "kept_text"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeated(docs: DataFrame, width: int = 50, texts: bool = False) -> DataFrame:
    """Per document: its words, those removed, the digest of the rest, and with ``texts`` the rest itself.

    A word goes if a window of ``width`` words over it also begins in a document with a smaller
    doc_id. Windows are judged on the input. A null text has no words; rows with a null doc_id lose
    nothing and cost others nothing; repeated rows are treated alike. Extra columns are dropped.
    """
    rows = only(docs, doc_id="long", text="string").withColumn("row", F.xxhash64("text"))
    spans = saved(repeated_spans(rows, width), "spans")
    return _matching(rows, spans, "left").select("doc_id", "text", "spans").mapInArrow(
        partial(_keep, texts=texts),
        "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts,
    )

"""Documents as tokens, packed into sequences of a fixed length; each partition's bin count is certified.

Pieces are dealt evenly to partitions of bounded size. Each runs best-fit decreasing, and compares
its bins with lower bounds from dual feasible functions of its lengths. Where they are equal, no packing of the
partition is better and it is done, but for its last bin. Where there is a gap, its least filled bins are opened and their
pieces exchanged with those of other such partitions, which run best-fit decreasing again. What is
exchanged is a few bins per partition, so a round or two end in one small partition, whatever the
size of the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import only, saved
from logspark.llm.words import text_slices

#: Id that ends a document.
END = 0
#: Pieces of a partition, at most on average; bins that a partition opens, at least and per bin of its gap.
PARTITION_PIECES, LEAST_OPEN, OPEN_PER_GAP = 50_000, 16, 8
MAX_ROUNDS = 4
#: Texts below this code point are split alike by both libraries; others go to the slower one.
COMMON = "ɐ"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, ranks: str | None):
    """Text to ids. ``ranks`` names the same vocabulary in the form of a faster library."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True

    def exact(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if ranks is None:
        return exact
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def either(text: str) -> list[int]:
        return fast.encode_ordinary(text) if not text or max(text) < COMMON else exact(text)

    return either


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Pieces (start, length) of a document: full ones, after a first one that may be shorter."""
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, ranks: str | None, capacity: int, ids: bool):
    encode = _encoder(vocabulary, ranks)
    for batch in text_slices(batches):
        out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids)}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            tokens = np.array([*encode(text.as_py() or ""), END], "<u4")
            for piece, (start, length) in enumerate(cut(len(tokens), capacity)):
                part = tokens[start : start + length]
                for column, value in zip(out, (doc, piece, start, length, zlib.crc32(part.tobytes()), part.astype(np.int32))):
                    out[column].append(value)
        kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], names=list(out))


def tokenised(docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = 2048, ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; with ``ids`` also the tokens themselves."""
    return only(docs, doc_id="long", text="string").mapInArrow(
        partial(_pieces, vocabulary=vocabulary, ranks=ranks, capacity=capacity, ids=ids),
        PIECE + ", ids array<int>" * ids,
    )


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, each into the fullest bin that has room."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms, n = 0, 0  # bit r of rooms: a bin has exactly r tokens of room
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        if fits := rooms >> length:
            room = length + (fits & -fits).bit_length() - 1
            of = by_room[room]
            k = of.pop()
            if not of:
                rooms ^= 1 << room
        else:
            k, room, n = n, capacity, n + 1
        bins[i], offsets[i] = k, capacity - room
        if room := room - length:
            by_room.setdefault(room, []).append(k)
            rooms |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of two families of dual feasible functions: no packing has fewer bins.

    The first drops items below k and counts those above capacity - k as full; the second rounds
    to multiples of 1/k where (k + 1) x is no multiple of the capacity. Integer arithmetic throughout.
    """
    if not len(lengths):
        return 0
    x = np.arange(capacity + 1)
    n = np.bincount(lengths, minlength=capacity + 1)
    count, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * x)])
    k = np.arange(0, capacity // 2 + 1)
    above = count[-1] - count[capacity - k + 1]
    between = total[capacity - k + 1] - total[k]
    best = int((above + -(-between // capacity)).max())
    for k in range(1, 101):
        exact = (k + 1) * x % capacity == 0
        weight = np.where(exact, k * x, (k + 1) * x // capacity * capacity)  # times 1 / (k * capacity)
        best = max(best, -(-int((n * weight).sum()) // (k * capacity)))
    return best


def _pack(batches: Iterator[pa.RecordBatch], capacity: int, stage: int) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).select(["doc_id", "piece", "start", "length", "ids_crc32"])
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
    lengths = table.column("length").to_numpy()
    bins, offsets = best_fit_decreasing(lengths, capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    gap = len(fill) - lower_bound(lengths, capacity)
    opened = np.zeros(len(fill), bool)
    # A certified partition gives only its last bin, which the rounding of its bound leaves part-filled.
    least = np.argsort(fill, kind="stable")[: LEAST_OPEN + OPEN_PER_GAP * gap if gap else 1]
    opened[least[fill[least] < capacity]] = True
    first = (stage << 56) + (TaskContext.get().partitionId() << 32)
    table = table.append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets))
    table = table.append_column("open", pa.array(opened[bins]))
    yield from table.combine_chunks().to_batches(max_chunksize=20_000)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Place every piece of ``tokenised`` in a sequence; adds ``sequence_id`` and ``offset``.

    Lengths are 1 to ``capacity``. Pieces are never cut, dropped or moved apart from their tokens;
    repeated rows are packed each. An empty table gives an empty one.
    """
    left = saved(pieces, "pieces")
    done: list[DataFrame] = []
    before = None
    for stage in range(MAX_ROUNDS):
        n = left.count()
        parts = max(1, -(-n // PARTITION_PIECES))
        packed = saved(
            left.repartition(parts).mapInArrow(
                partial(_pack, capacity=capacity, stage=stage),
                PIECE + ", sequence_id long, offset long, open boolean",
            ), "packed",
        )
        # A single partition has nobody to exchange with.
        if parts == 1 or stage + 1 == MAX_ROUNDS or n == before:
            done.append(packed)
            break
        done.append(packed.where("not open"))
        left, before = packed.where("open").drop("sequence_id", "offset", "open"), n
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.drop("open")


def packed_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = 2048) -> DataFrame:
    """Tokenise and pack. A null text is empty: one token. Extra columns are dropped."""
    return pack(tokenised(docs, vocabulary, ranks, capacity), capacity)


def sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids``, from ``tokenised(..., ids=True)``.

    doc_id must tell documents apart. A group is one sequence, so it holds ``capacity`` tokens at most.
    """
    return (
        placed.join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"))
    )

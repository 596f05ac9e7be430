"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

Fingerprints are made in one pass over the texts; equal ones are one from then on, so a group of
copies weighs as much as a single document. A 64-bit fingerprint is cut into two segments of 32 bits: of
two fingerprints with at most three differing bits, one segment differs in at most one bit. Each
fingerprint is filed under both its segments and asks for every value in the Hamming ball of radius
one around them; each hit is verified by its complete distance. A pair is asked for from one side
only: by the fingerprint that has the differing bit set.

Values of one segment that very many fingerprints share are told apart by the other segment: it
differs in three bits at most, so one of its four bytes is equal, and the byte joins the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import ensure_checkpoints, hex64, only
from logspark.llm.components import components
from logspark.llm.words import text_slices

SEED = 42
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """A bit is set where it is set in over half of the shingle hashes; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    pairs = zip(starts, ends[width - 1 :])
    n = len(words) - width + 1
    for _ in range(0, n, COUNTED):
        hashes = np.array([digest(joined[a:b], SEED) for (a, b), _ in zip(pairs, range(COUNTED))], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], carry: list[str], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carry), pa.array(bits.view(np.int64))], names=[*carry, "bits"]
        )


def with_fingerprints(docs: DataFrame, carry: list[str], shingle: int = 3) -> DataFrame:
    """The named columns and ``bits``, the fingerprint as a signed integer; ``docs`` has ``text``."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select("text", *[c for c in carry if c != "text"]).mapInArrow(
        partial(_fingerprints, carry=carry, shingle=shingle), f"{kinds}, bits long"
    )


def _segments(bits: str) -> list[tuple[F.Column, F.Column]]:
    """Both 32-bit segments, each with the rest of the fingerprint."""
    high = F.shiftrightunsigned(bits, 32)
    low = F.col(bits).bitwiseAND(F.lit(0xFFFFFFFF))
    return [(high, low), (low, high)]


def _keys(value: F.Column, rest: F.Column, segment: int) -> list[F.Column]:
    """A key per byte of the rest: segment number, byte number, byte and segment value, in one integer."""
    return [
        F.shiftleft(F.lit(segment * 4 + b).cast("long"), 40)
        + F.shiftleft(F.shiftrightunsigned(rest, 8 * b).bitwiseAND(F.lit(255)), 32) + value
        for b in range(4)
    ]


def _ball_keys(value: F.Column, rest: F.Column, segment: int) -> F.Column:
    """The keys of the segment's value and of all values with one of its set bits cleared."""
    bits_set = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.getbit(value, i) == 1)
    ball = F.concat(
        F.array(value),
        F.transform(bits_set, lambda i: value - F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    return F.flatten(F.transform(ball, lambda v: F.array(*_keys(v, rest, segment))))


def near_pairs(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs (u, v) of distinct ``bits`` at most ``distance`` (up to 3) bits apart."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one find distances up to 3")
    # A fingerprint becomes over a hundred rows, so they are dealt to all tasks before that, however few bytes they are.
    prints = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bits")
    filed, asked = [], []
    for segment, (value, rest) in enumerate(_segments("bits")):
        filed += _keys(value, rest, segment)
        asked.append(_ball_keys(value, rest, segment))
    table = prints.select("bits", F.explode(F.array(*filed)).alias("key"))
    probes = prints.select(F.col("bits").alias("ask"), F.explode(F.concat(*asked)).alias("key"))
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("ask")))
    return (
        probes.join(table, "key")
        .where((F.col("bits") != F.col("ask")) & (apart <= distance))
        .select(F.least("bits", "ask").alias("u"), F.greatest("bits", "ask").alias("v"))
    )


def fingerprint_groups(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """The rows of ``distinct``, one per fingerprint (``bits``), with ``root``, one fingerprint of their group."""
    roots = components(near_pairs(distinct.select("bits"), distance))
    labelled = distinct.join(roots.select(F.col("u").alias("bits"), F.col("v").alias("root")), "bits", "left")
    return labelled.withColumn("root", F.coalesce("root", "bits"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """Per document: its fingerprint and the smallest doc_id that links of at most ``distance`` bits reach.

    A null or empty text has fingerprint zero and is linked like any other. Repeated rows are in one
    component. A null doc_id is never the smallest: a component of such rows alone has a null
    component_id. Extra columns are dropped.
    """
    prints = with_fingerprints(only(docs, doc_id="long", text="string"), ["doc_id"], shingle)
    ensure_checkpoints(docs.sparkSession)
    prints = prints.checkpoint()
    distinct = prints.groupBy("bits").agg(F.min("doc_id").alias("least")).checkpoint()
    labelled = fingerprint_groups(distinct, distance)
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(smallest, "root").select("bits", "component_id")
    return prints.join(classes, "bits").select("doc_id", hex64("bits").alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """All columns of ``docs`` (doc_id, text and any others), one row of each group of ``near_duplicates``.

    The smallest doc_id of a group stays, a null one only where there is no other; of rows that share it, one.
    """
    ensure_checkpoints(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"), F.struct("*").alias("whole")
    )
    prints = with_fingerprints(rows.select("doc_id", "text", "row"), ["doc_id", "row"], shingle).checkpoint()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    distinct = prints.groupBy("bits").agg(first).checkpoint()
    kept = fingerprint_groups(distinct, distance).groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.row")
    kept = kept.checkpoint()
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["row"] == kept["row"])
    stay = rows.join(kept, same, "left_semi")
    repeated = prints.groupBy("doc_id", "row").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "row").checkpoint()
    if not repeated.isEmpty():
        same = stay["doc_id"].eqNullSafe(repeated["doc_id"]) & (stay["row"] == repeated["row"])
        once = stay.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "row"])
        stay = stay.join(repeated, same, "left_anti").unionAll(once)
    return stay.select("whole.*")

"""Repeatable random picks: a digest of (seed, id) gives the numbers, so any task can make any row
again after a failure, and another engine can make the same ones."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

# A digest has 32 hex digits and gives four 32-bit numbers.
DIGITS = 8
PER_DIGEST = 4


def add_digests(df: DataFrame, seed: int, count: int, column: str = "id") -> DataFrame:
    """Columns ``_d0 .. _d<count-1>``, each a digest of seed, id and its own number."""
    made = {
        f"_d{i}": F.md5(F.concat(F.lit(f"{seed}:{i}:"), F.col(column).cast("string")).cast("binary"))
        for i in range(count)
    }
    return df.withColumns(made)


def number(slot: int) -> Column:
    """The 32-bit number in ``slot``."""
    at = 1 + DIGITS * (slot % PER_DIGEST)
    return F.conv(F.substring(f"_d{slot // PER_DIGEST}", at, DIGITS), 16, 10).cast("long")


def between(slot: int, low: int, high: int) -> Column:
    """A whole number from low to high, both included."""
    return low + number(slot) % (high - low + 1)


def choice(slot: int, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (1 + number(slot) % len(values)).cast("int"))


def address(first_slot: int) -> Column:
    """An IPv4 address from four numbers in a row."""
    ranges = ((1, 255), (0, 255), (0, 255), (1, 254))
    octets = [between(first_slot + i, low, high).cast("string") for i, (low, high) in enumerate(ranges)]
    return F.concat_ws(".", *octets)


def address_pool(seed: int, name: str, size: int) -> list[str]:
    """``size`` addresses for a pool; pools of different names share none."""
    first = {"source": range(1, 128), "destination": range(128, 256)}[name]
    pool = []
    for i in range(size):
        digest = hashlib.md5(f"{seed}:{name}:{i}".encode()).digest()
        pool.append(f"{first[digest[0] % len(first)]}.{digest[1]}.{digest[2]}.{1 + digest[3] % 254}")
    return pool

"""Joins in which one key may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_SHARE = 1000
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_SHARE, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold more than ``min_rows`` rows and more than one ``share``-th of all rows.

    There can be fewer than ``share`` of them, whatever the data. ``parts`` says into how many
    parts a key has to go for each to stay below that size.
    """
    counts = df.groupBy(*on).agg(F.count("*").alias("_n"))
    fair = counts.agg((F.sum("_n") / share).alias("fair")).scalar()
    limit = F.greatest(fair, F.lit(float(min_rows)))
    parts = F.ceil(F.col("_n") / limit).cast("int")
    return counts.filter(F.col("_n") > limit).select(*on, parts.alias("_parts"))


def join_splitting_hot_keys(
    many: DataFrame,
    few: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    count_in: DataFrame | None = None,
    share: int = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner equi-join in which the hot keys of ``many`` are split over tasks.

    Rows of a hot key get a part number from a digest of ``spread_by``; the rows of ``few`` with
    that key are copied once per part, those of all other keys stay single. The hot keys are
    broadcast: their number is below ``share``. They are counted in ``count_in``, by default ``many``
    itself; give what ``many`` is made from to count before costly steps, which reads only the keys.
    """
    hot = F.broadcast(hot_keys(many if count_in is None else count_in, on, share, min_rows))
    keys = list(on)
    part = F.when(F.col("_parts").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")
    )
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    left = many.join(hot, keys, "left").withColumn("_part", part).drop("_parts")
    right = few.join(hot, keys, "left").withColumn("_part", F.explode(parts)).drop("_parts")
    return left.join(right, [*keys, "_part"]).drop("_part")

"""Totals over a whole stream, with no window: rows and exact distinct values per group.

Such totals change with every batch and never close, so no watermark bounds their state. Each
micro-batch is counted per (group, column, value) and stored; totals add up the stored counts. A
batch costs what its own rows cost, and nothing is held in memory between batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.operators.levels import FAN, LeveledTable
from logspark.streaming.sinks import start
from logspark.streaming.windows import entry_totals, tagged_entries


def stored_entries(path: str, by: Sequence[str], fan: int = FAN) -> LeveledTable:
    """Counts per (group, tag, item); those of old batches are added up as new ones come."""

    def add_up(counts: DataFrame) -> DataFrame:
        return counts.groupBy(*by, "tag", "item").agg(F.sum("n").alias("n"))

    return LeveledTable(path, add_up, fan=fan)


def store_entries(
    df: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str],
    distinct: Mapping[str, str] | None = None,
    available_now: bool = True,
    **trigger,
) -> StreamingQuery:
    """Count each micro-batch of a stream and store the counts; a replayed batch replaces its own."""
    table = stored_entries(path, by)

    def step(batch: DataFrame, batch_id: int) -> None:
        entries = tagged_entries(batch, by, list((distinct or {}).values()))
        table.write(entries.groupBy(*by, "tag", "item").agg(F.count("*").alias("n")), batch_id)

    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return start(writer, available_now, trigger)


def fold_entries(spark: SparkSession, path: str, new_path: str, by: Sequence[str]) -> None:
    """Add up the stored counts of many batches into one folder below ``new_path``.

    Do it while nothing writes; the stream may then go on with the new path and its checkpoint.
    """
    stored_entries(new_path, by).write(stored_entries(path, by).read(spark), -1)


def running_totals(
    spark: SparkSession,
    path: str,
    by: Sequence[str],
    distinct: Mapping[str, str] | None = None,
    min_count: int = 0,
) -> DataFrame:
    """Totals of all batches stored so far, of one version of the stored counts; groups with more than ``min_count`` rows."""
    totals = stored_entries(path, by).read(spark).groupBy(*by).agg(*entry_totals(list(distinct or {})))
    return totals.filter(F.col("event_count") > min_count)

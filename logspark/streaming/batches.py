"""Runs of rows that end in a given row, on a stream, by scanning each micro-batch as a table.

The keyed form in ``streaming.pattern`` hands every row to a Python state of its key and slot.
This form runs the batch scan over the rows of a micro-batch that the watermark has passed: hot
keys and hot instants are cut into stretches, and a row costs what it costs in batch. Between
micro-batches it keeps rows still ahead of the watermark and the open run of each key, in tables
below a shared folder. Every table has one folder per batch id, which is overwritten as a whole
and read by the next batch only, so a batch that runs again after a failure gives the same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.functions.time import period_interval
from logspark.operators.keyed import upsert_latest
from logspark.operators.pattern import (
    LOGIN_ORDER, TAIL, classify, link_stretches, login_pattern, match_run_then, matches_of, scan_runs,
)
from logspark.streaming.sinks import BatchTable, start
from logspark.streaming.windows import WATERMARK


def match_run_then_batches(
    df: DataFrame,
    state: str,
    checkpoint: str,
    on_matches: Callable[[DataFrame, int], None],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    run_pred: Column,
    end_pred: Column,
    min_run: int = 3,
    measures: Mapping[str, str] | None = None,
    count_as: str = "run_length",
    watermark: str = WATERMARK,
    partitions: int | None = None,
    available_now: bool = True,
    **trigger,
) -> StreamingQuery:
    """Start the stream form of ``operators.pattern.match_run_then`` on a stream with ``event_ts``.

    ``on_matches(matches, batch_id)`` stores the matches of a batch; it must replace what an
    earlier attempt at the same batch has stored. ``order_by`` must follow ``event_ts``. Rows
    behind the watermark, or without a time, are too late for their runs: their keys are stored
    (``late_keys``), and ``repaired_matches`` scans these keys again. ``state`` and ``checkpoint``
    belong together.
    """
    measures = dict(measures or {})
    waiting, linked, clock, late = (BatchTable(f"{state}/{name}") for name in ("waiting", "linked", "clock", "late"))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, batch_id - 1
        rows = classify(batch, partition_by, order_by, run_pred, end_pred, measures, also=["event_ts"])
        passed = clock.read(spark, "watermark timestamp", before)
        last_mark = passed.agg(F.coalesce(F.max("watermark"), F.lit("1900-01-01").cast("timestamp"))).scalar()
        early_enough = F.coalesce(F.col("event_ts") > last_mark, F.lit(False))
        late.write(batch.filter(~early_enough).groupBy(*partition_by).agg(F.count("*").alias("late_rows")), batch_id)
        in_time = rows.filter(early_enough)
        pending = in_time.unionByName(waiting.read(spark, rows.schema, before)).persist()
        try:
            newest = pending.agg(F.max("event_ts").alias("newest")).select(F.col("newest") - period_interval(watermark))
            mark = F.greatest(newest.scalar(), last_mark).alias("watermark")
            clock.write(spark.range(1).select(mark), batch_id)
            now = clock.read(spark, "watermark timestamp", batch_id).scalar()
            waiting.write(pending.filter(F.col("event_ts") > now), batch_id)
            ripe = pending.filter(F.col("event_ts") <= now).drop("event_ts")
            scanned = scan_runs(ripe, min_run, partitions, every_key=True)
            linked_schema = link_stretches(scanned).schema
            tails = linked.read(spark, linked_schema, before).filter(F.col("_kind") == TAIL)
            open_runs = upsert_latest(tails, "_key", ["_stretch"]).filter(F.col("_run") > 0)
            # What a key carries over stands before its first stretch.
            carried = open_runs.withColumns({"_stretch": F.lit(-1), "_reset": F.lit(1).cast("byte")})
            linked.write(link_stretches(scanned.unionByName(carried)), batch_id)
        finally:
            pending.unpersist()
        stored = linked.read(spark, linked_schema, batch_id)
        on_matches(matches_of(stored, batch, partition_by, list(measures), min_run, count_as), batch_id)
        # A batch that runs again reads the one before it; older ones are done with.
        for table in (waiting, linked, clock):
            table.drop(spark, before - 1)

    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return start(writer, available_now, trigger)


def late_keys(spark: SparkSession, state: str, keys: Sequence[str]) -> DataFrame:
    """Keys with rows that came too late, and how many (``late_rows``)."""
    return spark.read.parquet(f"{state}/late").groupBy(*keys).agg(F.sum("late_rows").alias("late_rows"))


def repaired_matches(
    matches: DataFrame, late: DataFrame, rows: DataFrame, partition_by: Sequence[str], **pattern
) -> DataFrame:
    """Matches of a stream, with those of late keys found anew in ``rows``, the stored rows of the stream."""
    keys = list(partition_by)
    touched = late.select(*[F.col(k).alias(f"late_{k}") for k in keys])

    def same(df: DataFrame) -> Column:
        return reduce(Column.__and__, (df[k].eqNullSafe(touched[f"late_{k}"]) for k in keys))

    again = match_run_then(rows.join(touched, same(rows), "left_semi"), keys, **pattern)
    return matches.join(touched, same(matches), "left_anti").unionByName(again)


def suspicious_logins_batches(
    json: DataFrame,
    state: str,
    checkpoint: str,
    on_matches: Callable[[DataFrame, int], None],
    scope: str = "same_type",
    min_run: int = 3,
    keep: Sequence[str] = (),
    order_by: Sequence[str] = LOGIN_ORDER,
    **options,
) -> StreamingQuery:
    """Runs of login warnings that end in a failure, per user, on a stream."""
    pattern = login_pattern(scope, min_run, keep, order_by)
    return match_run_then_batches(json, state, checkpoint, on_matches, **pattern, **options)

"""Runs of rows that end in a given row, on a stream.

Three keyed steps. The first holds rows by key and instant until the watermark passes them, so rows
behind it are left out. The second collects them by (key, time slot) and hands a slot on when the
watermark passes its end. Both are Spark's own aggregations. Slots are scanned in Arrow batches, many
side by side, which gives the matches that lie in a slot and for its edges at most two summary rows.
The third step is keyed by key and holds one number per key, the length of the run that is still
open; slots reach it in order, so it needs no buffer. A hot key is thus spread over its slots, and
only summaries meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logspark.functions.time import period_micros, slot_offset
from logspark.operators.pattern import (
    END, HEAD, LOGIN_ORDER, MATCH, RUN, TAIL, login_pattern, row_class, run_before,
)
from logspark.session import use_rocksdb_state
from logspark.streaming.windows import WATERMARK


# Python workers hold times as nanoseconds, which end in 2262.
LATEST = "2262-01-01 00:00:00"


# Groups per key that finished matches are passed on in.
MATCH_GROUPS = 64


def _scan_slots(batches, key_names, measures, min_run):
    """Scan slots whose rows are in order: matches, and for the edges of each slot its head and tail."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("rows_")
        lengths, rows = lists.value_lengths().to_numpy(), lists.flatten()
        slot_of, ends = np.repeat(np.arange(batch.num_rows), lengths), np.cumsum(lengths)
        classes = rows.field("class_").to_numpy(zero_copy_only=False)
        starts = np.zeros(len(classes), bool)
        starts[ends - lengths] = True
        run = run_before(classes, starts, 0)
        other = np.flatnonzero(classes != RUN)
        broken, at = np.unique(slot_of[other], return_index=True)
        first = other[at]
        kinds = np.where((classes == END) & (run >= min_run), MATCH, -1)
        kinds[first[classes[first] == END]] = HEAD
        hits = np.flatnonzero(kinds >= 0)
        reset = np.zeros(batch.num_rows, np.int64)
        reset[broken] = 1
        last = ends - 1
        tail_run = np.where(classes[last] == RUN, run[last] + 1, 0)

        def summaries(slots, values, kind, run, reset):
            named = [*key_names, "slot_"]
            columns = [batch.column(n).take(pa.array(slots)) for n in named]
            numbers = [pa.array(v, pa.int64()) for v in (kind, run, reset)]
            return pa.RecordBatch.from_arrays([*columns, *values, *numbers], names=[*named, *measures, "kind_", "run_", "reset_"])

        found = [rows.field(m).take(pa.array(hits)) for m in measures]
        yield summaries(slot_of[hits], found, kinds[hits], run[hits], np.zeros(len(hits), np.int64))
        none = [pa.nulls(batch.num_rows, v.type) for v in found]
        yield summaries(np.arange(batch.num_rows), none, np.full(batch.num_rows, TAIL), tail_run, reset)


class ChainSlots(StatefulProcessor):
    """Add the length of the open run to the head of the next slot; pass finished matches on."""

    def __init__(self, key_names: list[str], measures: list[str], min_run: int):
        self.key_names, self.measures, self.min_run = key_names, measures, min_run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open_run = handle.getValueState("open_run", T.StructType([T.StructField("length", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = [*self.key_names, "run_", *self.measures]
        if key[-1] > 0:
            for batch in rows:
                yield batch[columns]
            return
        edges = pd.concat(list(rows)).sort_values(["slot_", "kind_"])
        length = self.open_run.get()[0] if self.open_run.exists() else 0
        runs = []
        for kind, run, reset in zip(edges["kind_"], edges["run_"], edges["reset_"]):
            runs.append(length + run)
            if kind == TAIL:
                length = run if reset else length + run
        self.open_run.update((int(length),))
        edges["run_"] = runs
        yield edges.loc[(edges["kind_"] == HEAD) & (edges["run_"] >= self.min_run), columns]

    def close(self) -> None:
        pass


def match_run_then_stream(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    run_pred: Column,
    end_pred: Column,
    min_run: int = 3,
    measures: Mapping[str, str] | None = None,
    count_as: str = "run_length",
    watermark: str = WATERMARK,
    slot: str = "1 minute",
) -> DataFrame:
    """The stream form of ``operators.pattern.match_run_then``, for a stream with ``event_ts``.

    ``order_by`` must follow ``event_ts``. Choose ``slot`` so that the rows of the hottest key in
    one slot fit a task. Rows behind the watermark are not seen; a row from a clock that runs far
    ahead moves the watermark with it, so drop such rows first (``sources.ingest.reject_outside``).
    """
    use_rocksdb_state(df.sparkSession)
    measures = dict(measures or {})
    keys, names = list(partition_by), list(measures)
    klass = row_class(run_pred, end_pred)
    # Nulls come last.
    order = [c for i, name in enumerate(order_by) for c in (F.col(name).isNull().alias(f"null{i}_"), F.col(name).alias(f"order{i}_"))]
    bounded = df.withColumn("event_ts", F.least("event_ts", F.lit(LATEST).cast("timestamp")))
    rows = bounded.withWatermark("event_ts", watermark).select(
        *keys,
        "event_ts",
        F.struct(*order, klass.alias("class_"), *[F.when(klass == END, F.col(c)).alias(alias) for alias, c in measures.items()]).alias("row_"),
    )
    instants = rows.groupBy(*keys, "event_ts").agg(F.collect_list("row_").alias("rows_"))
    seconds, since = period_micros(slot) // 1_000_000, slot_offset(slot) // 1_000_000
    span = F.window("event_ts", f"{seconds} seconds", startTime=f"{since} seconds")
    slots = instants.groupBy(*keys, span).agg(F.array_sort(F.flatten(F.collect_list("rows_"))).alias("rows_"))
    needed = F.transform("rows_", lambda r: F.struct(*[r[c].alias(c) for c in ["class_", *names]]))
    slots = slots.select(*keys, F.unix_millis("window.start").alias("slot_"), needed.alias("rows_"))
    field = {f.name: f for f in [*slots.schema, *slots.schema["rows_"].dataType.elementType]}
    long = T.LongType()
    summary = T.StructType(
        [field[n] for n in [*keys, "slot_"]] + [T.StructField(n, field[n].dataType) for n in names]
        + [T.StructField("kind_", long), T.StructField("run_", long), T.StructField("reset_", long)]
    )
    scanned = slots.mapInArrow(partial(_scan_slots, key_names=keys, measures=names, min_run=min_run), summary)
    group = 1 + F.pmod(F.xxhash64("slot_"), F.lit(MATCH_GROUPS))
    spread = F.when(F.col("kind_") == MATCH, group).otherwise(F.lit(0).cast("long"))
    found = T.StructType([field[k] for k in keys] + [T.StructField("run_", long)] + [T.StructField(n, field[n].dataType) for n in names])
    chained = (
        scanned.withColumn("spread_", spread)
        .groupBy(*keys, "spread_")
        .transformWithStateInPandas(ChainSlots(keys, names, min_run), found, outputMode="Append", timeMode="None")
    )
    return chained.withColumnRenamed("run_", count_as)


def suspicious_logins_stream(json: DataFrame, scope: str = "same_type", min_run: int = 3, keep: Sequence[str] = (),
                             order_by: Sequence[str] = LOGIN_ORDER, **options) -> DataFrame:
    """Runs of login warnings that end in a failure, per user, on a stream."""
    return match_run_then_stream(json, **login_pattern(scope, min_run, keep, order_by), **options)

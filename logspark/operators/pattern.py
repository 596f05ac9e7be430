"""Runs of rows that end in a given row, per key and in order: the pattern ``RUN{n,} END``.

One key may hold a third of all rows and there may be only a handful of keys, so a window
partitioned by key would put most of the input into a few tasks. Instead the rows are
range-partitioned by (key, order): every partition is one contiguous stretch of the global order,
a hot key is cut into as many stretches as its size asks for, and each stretch is scanned once, in
order, batch by batch. What a stretch cannot know is how long the run was that it continues. At
most one match per stretch depends on that, and the stretch passes on only one summary row, so the
second step, which adds up run lengths across stretches, sees two rows per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

OTHER, RUN, END = 0, 1, 2
MATCH, HEAD, TAIL = 0, 1, 2


def login_run(status: str = "warning") -> Column:
    return (F.col("status") == status) & (F.col("event_type") == "login")


def login_end(scope: str = "same_type", status: str = "failure") -> Column:
    """A failure after the run: ``same_type`` wants a login, ``any`` takes every event type."""
    ended = F.col("status") == status
    if scope == "any":
        return ended
    if scope != "same_type":
        raise ValueError(f"unknown scope: {scope}")
    return ended & (F.col("event_type") == "login")


# Output columns of a suspicious login and the columns of the last row they come from.
LOGIN_MEASURES = {"failure_time": "timestamp", "failure_source_ip": "source_ip", "failed_details": "details"}


def row_class(run_pred: Column, end_pred: Column) -> Column:
    """A row is END, RUN or neither; where both tests hold, END wins. Null tests hold for no row."""
    return F.when(end_pred, F.lit(END)).when(run_pred, F.lit(RUN)).otherwise(F.lit(OTHER)).cast("byte")


def run_before(classes, starts, carried: int):
    """How many RUN rows stand right before each row; a run ends where ``starts`` says a key begins.

    ``carried`` RUN rows stand before the first row.
    """
    import numpy as np

    at = np.arange(len(classes))
    unbroken = -1 - carried
    last_other = np.maximum.accumulate(np.where(classes != RUN, at, unbroken))
    before = np.concatenate(([unbroken], last_other[:-1]))
    key_edge = np.maximum.accumulate(np.where(starts, at - 1, unbroken))
    return at - 1 - np.maximum(before, key_edge)


def _scan_stretch(batches, min_run, every_key):
    """Scan one sorted stretch: give its matches, its open head, and the tail summary of its last key.

    With ``every_key`` the tails of all keys come out, not only the one the next stretch may need.
    """
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    stretch = TaskContext.get().partitionId()

    def tagged(batch, rows, kind, run, reset):
        n = len(rows)
        taken = batch.select([c for c in batch.schema.names if c != "_class"]).take(pa.array(rows, pa.int64()))
        extra = {
            "_stretch": pa.array(np.full(n, stretch, np.int32)),
            "_kind": pa.array(np.full(n, kind, np.int8)),
            "_run": pa.array(run, pa.int64()),
            "_reset": pa.array(np.broadcast_to(np.asarray(reset, np.int8), n)),
        }
        return pa.RecordBatch.from_arrays([*taken.columns, *extra.values()], names=[*taken.schema.names, *extra])

    last_key, carried, opened, last_row = None, 0, True, None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        key = batch.column("_key")
        codes = key.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        classes = batch.column("_class").to_numpy(zero_copy_only=False)
        starts = np.empty(n, bool)
        starts[1:] = codes[1:] != codes[:-1]
        starts[0] = last_row is not None and key[0].as_py() != last_key
        if every_key and starts[0]:
            yield tagged(last_row, [0], TAIL, [carried], 0 if opened else 1)
        run = run_before(classes, starts, carried)
        trailing = np.where(classes == RUN, run + 1, 0)
        ends = classes == END
        resets = np.ones(n, np.int8)

        if opened:
            closing = np.flatnonzero(starts | (classes != RUN))
            if len(closing):
                opened = False
                first = closing[0]
                resets[:first] = 0
                if ends[first] and not starts[first]:
                    yield tagged(batch, [first], HEAD, run[[first]], 0)
                    ends[first] = False
        hits = np.flatnonzero(ends & (run >= min_run))
        if len(hits):
            yield tagged(batch, hits, MATCH, run[hits], 0)
        if every_key:
            last = np.flatnonzero(starts[1:])
            if len(last):
                yield tagged(batch, last, TAIL, trailing[last], resets[last])

        last_key, carried, last_row = key[n - 1].as_py(), int(trailing[-1]), batch.slice(n - 1, 1)
    if last_row is not None:
        yield tagged(last_row, [0], TAIL, [carried], 0 if opened else 1)


def classify(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    run_pred: Column,
    end_pred: Column,
    measures: Mapping[str, str],
    also: Sequence[str] = (),
) -> DataFrame:
    """The columns a scan needs: key text, order, class, and measures where the row is an END.

    A single key is carried as text only; several stay beside their text.
    """
    keys = list(partition_by)
    single = len(keys) == 1
    key_text = F.col(keys[0]).cast("string") if single else F.to_json(F.struct(*keys))
    klass = row_class(run_pred, end_pred)
    return df.select(
        key_text.alias("_key"),
        *([] if single else keys),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order_by)],
        klass.alias("_class"),
        *[F.when(klass == END, F.col(c)).alias(alias) for alias, c in measures.items()],
        *also,
    )


def scan_runs(rows: DataFrame, min_run: int, partitions: int | None = None, every_key: bool = False) -> DataFrame:
    """Cut classified rows into stretches and scan each."""
    sort_key = ["_key", *[c for c in rows.columns if c.startswith("_order")]]
    placed = rows.repartitionByRange(*([partitions] if partitions else []), *sort_key)
    narrow = placed.sortWithinPartitions(*sort_key).drop(*sort_key[1:])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "_class"]
    schema = ", ".join([*fields, "_stretch int", "_kind byte", "_run long", "_reset byte"])
    return narrow.mapInArrow(partial(_scan_stretch, min_run=min_run, every_key=every_key), schema)


def link_stretches(scanned: DataFrame) -> DataFrame:
    """Add the run a stretch continues to the run of its head and, if it has no break, of its tail.

    Summaries of one key meet in one group of at most two rows per stretch; finished matches only
    pass through and are spread by stretch.
    """
    spread = F.when(F.col("_kind") == MATCH, F.col("_stretch") + 2).otherwise(0)
    along = Window.partitionBy("_key", "_spread").orderBy("_stretch", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail = F.when(F.col("_kind") == TAIL, F.col("_run")).otherwise(0)
    # Run rows before the newest break never exceed those up to now, so their greatest count is the newest one's.
    before_break = F.when(F.col("_reset") == 1, F.col("_tails") - tail)
    chained = F.col("_tails") - F.coalesce(F.col("_base"), F.lit(0))
    total = F.when(F.col("_kind") == HEAD, F.col("_run") + chained)
    total = total.when(F.col("_kind") == TAIL, chained).otherwise(F.col("_run"))
    return (
        scanned.withColumn("_spread", spread)
        .withColumn("_tails", F.sum(tail).over(along))
        .withColumn("_base", F.max(before_break).over(along))
        .withColumn("_run", total)
        .drop("_spread", "_tails", "_base", "_reset")
    )


def matches_of(linked: DataFrame, source: DataFrame, partition_by: Sequence[str], measures: Sequence[str],
               min_run: int, count_as: str) -> DataFrame:
    """Result columns of linked rows; ``source`` has the types of the partition columns."""
    keys = list(partition_by)
    if len(keys) == 1:
        keys = [F.col("_key").cast(source.schema[keys[0]].dataType).alias(keys[0])]
    long_enough = (F.col("_kind") != TAIL) & (F.col("_run") >= min_run)
    return linked.filter(long_enough).select(*keys, F.col("_run").alias(count_as), *measures)


def match_run_then(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    run_pred: Column,
    end_pred: Column,
    min_run: int = 3,
    measures: Mapping[str, str] | None = None,
    count_as: str = "run_length",
    partitions: int | None = None,
) -> DataFrame:
    """One row per run of at least ``min_run`` adjacent RUN rows followed at once by an END row.

    Gives the partition columns, the length of the whole run and ``measures`` (output name ->
    column) of the END row. Matches do not overlap, because a run ends where its match ends.
    ``order_by`` must be a total order within a key, or ties fall as they come. Text sorts by
    bytes. ``partitions`` is the number of stretches; by default ``spark.sql.shuffle.partitions``.
    """
    measures = dict(measures or {})
    rows = classify(df, partition_by, order_by, run_pred, end_pred, measures)
    linked = link_stretches(scan_runs(rows, min_run, partitions))
    return matches_of(linked, df, partition_by, list(measures), min_run, count_as)


LOGIN_ORDER = ("event_time", "log_id")


def login_pattern(
    scope: str = "same_type", min_run: int = 3, keep: Sequence[str] = (), order_by: Sequence[str] = LOGIN_ORDER
) -> dict:
    """Arguments of ``match_run_then`` for runs of login warnings that end in a failure, per user.

    ``keep`` adds columns of the last row. Logs may also be ordered by the time of their topic
    record; end ``order_by`` with something that tells records of one instant apart.
    """
    return {
        "partition_by": ["username"],
        "order_by": list(order_by),
        "run_pred": login_run(),
        "end_pred": login_end(scope),
        "min_run": min_run,
        "measures": LOGIN_MEASURES | {c: c for c in keep},
        "count_as": "warning_count",
    }


def suspicious_logins(json: DataFrame, scope: str = "same_type", min_run: int = 3, keep: Sequence[str] = (),
                      order_by: Sequence[str] = LOGIN_ORDER) -> DataFrame:
    """Runs of login warnings that end in a failure, per user."""
    return match_run_then(json, **login_pattern(scope, min_run, keep, order_by))

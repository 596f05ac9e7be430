"""Runs of rows that end in a given row, on a stream whose rows may be late by any time, with corrections.

Time is cut into slots. Of every key and slot a summary is kept: how many RUN rows stand before its first
break (a row that is none), whether that break is an END, and how many stand after its last break.
Summaries of neighbouring slots combine by addition until a slot with a break, whatever the order in
which they came to be, so what a slot carries over to the next ones is known without its rows.

A micro-batch stores its rows and scans only the slots it touches, again from their stored rows. Matches
inside a slot depend on nothing else. The match at a slot's first break depends on what earlier slots carry
over; a batch can change it for touched slots and for the slots behind them up to the next break, and
only summaries up to the break before and the break behind are read for that. What comes out
is a table of changes: matches added (1) and withdrawn (-1), which add up to the matches of all rows so far.
There is no watermark, no row is late for good, and no match waits for a later row.

Every table has a folder per slot and micro-batch, so a batch that runs again replaces what it
wrote, and readers of a slot open no other slot's files. Rows of one key and slot are scanned in
stretches, as in the batch form: a hot key is spread over tasks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logspark.operators.keyed import upsert_latest
from logspark.operators.pattern import END, LOGIN_ORDER, RUN, TAIL, link_stretches, login_pattern, row_class, scan_runs
from logspark.streaming.sinks import BatchTable, start

#: Slot of rows without a time; they come before all others.
NO_TIME = -(2**31)
SLOT = ["_key", "_slot"]


@dataclass(frozen=True)
class SlotTable:
    """Rows by slot and micro-batch."""

    path: str
    schema: T.StructType

    def write(self, df: DataFrame, batch_id: int, spread: bool = False) -> None:
        """``spread`` deals rows that come as they were read by slot, so that few files are written per slot."""
        rows = df.withColumn("_batch", F.lit(batch_id).cast("long"))
        rows = rows.hint("rebalance", "_slot") if spread else rows
        rows.write.partitionBy("_slot", "_batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def read(self, spark: SparkSession, slots: Iterable[int], upto: int) -> DataFrame:
        """Rows of the given slots written by batches up to ``upto``."""
        kept = sorted({*slots} & {*self.slots(spark)})
        kinds = T.StructType([*self.schema.fields, T.StructField("_slot", T.LongType()), T.StructField("_batch", T.LongType())])
        if not kept:
            return spark.createDataFrame([], kinds)
        folders = [f"{self.path}/_slot={s}" for s in kept]
        return spark.read.schema(kinds).option("basePath", self.path).parquet(*folders).where(F.col("_batch") <= upto)

    def slots(self, spark: SparkSession) -> list[int]:
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [str(f.getPath().getName()) for f in files.listStatus(place)] if files.exists(place) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("_slot="))


@dataclass(frozen=True)
class RunPattern:
    """``RUN{min_run,} END`` per key; ``order`` is a total order within a key and ``slot`` does not fall along it."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    run: Column
    end: Column
    slot: Column
    min_run: int = 3
    measures: tuple[tuple[str, str], ...] = ()
    count_as: str = "run_length"

    @property
    def at(self) -> list[str]:
        return [f"_at{i}" for i in range(len(self.order))]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.measures]

    def classified(self, df: DataFrame) -> DataFrame:
        klass = row_class(self.run, self.end)
        return df.select(
            F.to_json(F.struct(*self.keys)).alias("_key"), F.coalesce(self.slot.cast("long"), F.lit(NO_TIME)).alias("_slot"),
            *[F.col(c).alias(a) for c, a in zip(self.order, self.at)], klass.alias("_class"),
            *[F.when(klass == END, F.col(c)).alias(name) for name, c in self.measures],
        )

    def summaries(self, rows: DataFrame) -> DataFrame:
        """One row per key and slot; every aggregate combines on the map side, so a hot slot sends one row per task."""
        at, is_run = F.struct(*self.at), F.col("_class") == RUN
        breaks = rows.where(~is_run).groupBy(*SLOT).agg(
            F.min(F.struct(*self.at, "_class", *self.names)).alias("_first"), F.max(at).alias("_last"))
        first = F.struct(*[F.col(f"_first.{c}").alias(c) for c in self.at])
        whole = F.col("_last").isNull()
        return rows.join(breaks, SLOT, "left").groupBy(*SLOT).agg(
            F.count_if(is_run & (whole | (at < first))).alias("_lead"), F.count_if(is_run & (whole | (at > F.col("_last")))).alias("_trail"),
            F.first("_first").alias("_first"), F.first("_last").alias("_last"),
        ).select(
            *SLOT, F.col("_last").isNotNull().alias("_broken"), "_lead", "_trail",
            F.coalesce(F.col("_first._class") == END, F.lit(False)).alias("_ends"),
            *[F.col(f"_first.{c}").alias(c) for c in [*self.at, *self.names]],
        )

    def inner(self, rows: DataFrame, summaries: DataFrame, partitions: int | None) -> DataFrame:
        """Matches within each slot, without the one at its first break."""
        one = F.concat_ws("\x1f", F.col("_slot").cast("string"), "_key")
        stretches = rows.select(
            one.alias("_key"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(self.at)], "_class",
            F.col("_key").alias("_of"), "_slot", *self.at, *self.names,
        )
        found = link_stretches(scan_runs(stretches, self.min_run, partitions))
        found = found.where((F.col("_kind") != TAIL) & (F.col("_run") >= self.min_run)).select(
            F.col("_of").alias("_key"), "_slot", "_run", *self.at, *self.names)
        firsts = summaries.where("_ends").select(*SLOT, F.struct(*self.at).alias("_head"))
        matches = found.join(firsts, SLOT, "left").where(~F.coalesce(F.struct(*self.at) == F.col("_head"), F.lit(False)))
        return matches.drop("_head")

    def heads(self, chain: DataFrame) -> DataFrame:
        """Matches at the first breaks of slots; ``chain`` has the summaries of neighbouring slots, by ``_cluster``."""
        along = Window.partitionBy("_key", "_cluster").orderBy("_slot")
        island = F.sum(F.col("_broken").cast("int")).over(along)
        linked = chain.withColumn("_island", island)
        since = Window.partitionBy("_key", "_cluster", "_island").orderBy("_slot")
        linked = linked.withColumn("_total", F.sum("_trail").over(since))
        linked = linked.withColumn("_run", F.col("_lead") + F.coalesce(F.lag("_total").over(along), F.lit(0)))
        return linked.where(F.col("_ends") & (F.col("_run") >= self.min_run)).select(*SLOT, "_run", *self.at, *self.names)

    def result(self, found: DataFrame, types: T.StructType) -> DataFrame:
        """Columns as users see them."""
        kinds = T.StructType([types[k] for k in self.keys])
        key = F.from_json("_key", kinds)
        rest = [c for c in ("change", "batch_id") if c in found.columns]
        return found.select(*[key[k].alias(k) for k in self.keys], F.col("_run").alias(self.count_as), *self.names, *rest)


@dataclass(frozen=True)
class MatchState:
    """The tables of one stream below one folder."""

    path: str
    pattern: RunPattern
    types: T.StructType

    def _table(self, name: str, df_schema: list[T.StructField]) -> SlotTable:
        return SlotTable(f"{self.path}/{name}", T.StructType([T.StructField("_key", T.StringType()), *df_schema]))

    def _fields(self) -> list[T.StructField]:
        order = [T.StructField(a, self.types[c].dataType) for a, c in zip(self.pattern.at, self.pattern.order)]
        return order + [T.StructField(name, self.types[c].dataType) for name, c in self.pattern.measures]

    @property
    def rows(self) -> SlotTable:
        return self._table("rows", [T.StructField("_class", T.ByteType()), *self._fields()])

    @property
    def summaries(self) -> SlotTable:
        flags = [("_broken", T.BooleanType()), ("_lead", T.LongType()), ("_trail", T.LongType()), ("_ends", T.BooleanType())]
        return self._table("summaries", [*(T.StructField(n, k) for n, k in flags), *self._fields()])

    @property
    def inner(self) -> SlotTable:
        return self._table("inner", [T.StructField("_run", T.LongType()), *self._fields()])

    @property
    def changes(self) -> BatchTable:
        return BatchTable(f"{self.path}/changes")

    @property
    def work(self) -> BatchTable:
        """Per micro-batch: rows scanned, slots touched, slots whose summaries were read."""
        return BatchTable(f"{self.path}/work")

    def all_changes(self, spark: SparkSession) -> DataFrame:
        """Matches added (1) and withdrawn (-1), with ``batch_id``."""
        found = spark.read.option("basePath", self.changes.path).parquet(self.changes.path)
        return self.pattern.result(found, self.types)

    def matches(self, spark: SparkSession) -> DataFrame:
        """The matches of all rows so far."""
        found = spark.read.parquet(self.changes.path)
        at = ["_key", "_run", *self.pattern.at, *self.pattern.names]
        kept = found.groupBy(*at).agg(F.sum("change").alias("_n")).where("_n > 0")
        return self.pattern.result(kept, self.types)


def nearest(known: Sequence[int], touched: Iterable[int], reach: int) -> dict[int, int]:
    """The touched slots with ``reach`` known ones on each side: slot -> number of its unbroken stretch of known slots."""
    places = sorted({p for t in touched for p in range(max(0, bisect_left(known, t) - reach), min(len(known), bisect_left(known, t) + reach + 1))})
    clusters, number = {}, 0
    for i, p in enumerate(places):
        number += bool(i) and p != places[i - 1] + 1
        clusters[known[p]] = number
    return clusters


def neighbours(spark: SparkSession, state: MatchState, touched: DataFrame, slots: list[int], batch_id: int) -> tuple[DataFrame, int]:
    """Summaries of the touched keys around their touched slots, in all versions up to this batch, as far as the next break on
    both sides; and how many slots were read. Most batches find the breaks next to what they touch; else the reach is widened."""
    known, reach = state.summaries.slots(spark), 1
    keys = touched.select("_key").distinct()
    while True:
        clusters = nearest(known, slots, reach)
        ends = {c: (min(s for s in clusters if clusters[s] == c), max(s for s in clusters if clusters[s] == c)) for c in set(clusters.values())}
        places = spark.createDataFrame(
            [(s, c, ends[c][0] == known[0], ends[c][1] == known[-1]) for s, c in clusters.items()],
            "_slot long, _cluster int, _from_first boolean, _to_last boolean")
        chain = state.summaries.read(spark, clusters, batch_id).join(keys, "_key", "left_semi").join(F.broadcast(places), "_slot").persist()
        now = upsert_latest(chain, SLOT, ["_batch"])
        along = Window.partitionBy("_key", "_cluster").orderBy("_slot")
        broken = F.max("_broken")
        open_ = (
            now.withColumn("_before", broken.over(along.rowsBetween(Window.unboundedPreceding, -1)) | F.col("_from_first"))
            .withColumn("_behind", broken.over(along.rowsBetween(1, Window.unboundedFollowing)) | F.col("_to_last"))
            .where(~(F.coalesce("_before", "_from_first") & F.coalesce("_behind", "_to_last")))
        )
        if open_.join(touched, SLOT, "left_semi").isEmpty():
            return chain, len(clusters)
        chain.unpersist()
        reach *= 4


def match_run_then_corrected(
    df: DataFrame,
    state: str,
    checkpoint: str,
    pattern: RunPattern,
    on_changes: Callable[[DataFrame, int], None] | None = None,
    partitions: int | None = None,
    available_now: bool = True,
    **trigger,
) -> tuple[StreamingQuery, MatchState]:
    """Start the pattern on a stream. ``on_changes(changes, batch_id)`` gets the changes of a batch after they are stored."""
    tables = MatchState(state, pattern, df.schema)
    at = ["_key", "_run", *pattern.at, *pattern.names]

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = pattern.classified(batch).persist()
        touched = new.select(*SLOT).distinct().persist()
        held = [new, touched]
        try:
            tables.rows.write(new, batch_id, spread=True)
            slots = [r["_slot"] for r in touched.select("_slot").distinct().collect()]
            rows = tables.rows.read(spark, slots, batch_id).join(touched, SLOT, "left_semi").persist()
            held.append(rows)
            summed = pattern.summaries(rows).persist()
            held.append(summed)
            tables.summaries.write(summed, batch_id)
            tables.inner.write(pattern.inner(rows, summed, partitions), batch_id)
            chain, read = neighbours(spark, tables, touched, slots, batch_id) if slots else (None, 0)
            if chain is not None:
                held.append(chain)
            tables.work.write(spark.createDataFrame([(rows.count(), len(slots), read)], "rows long, touched int, summarised int"), batch_id)
            tables.changes.write(_changes(spark, tables, chain, slots, batch_id, at), batch_id)
        finally:
            for frame in held:
                frame.unpersist()
        if on_changes:
            stored = spark.read.parquet(tables.changes.folder(batch_id))
            on_changes(pattern.result(stored, tables.types), batch_id)

    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return start(writer, available_now, trigger), tables


def _changes(spark: SparkSession, tables: MatchState, chain: DataFrame | None, slots: list[int], batch_id: int, at: list[str]) -> DataFrame:
    """What the matches after a batch have more (1) and less (-1) than those before it."""
    sides = []
    inner = tables.inner.read(spark, slots, batch_id)
    for change, upto in ((1, batch_id), (-1, batch_id - 1)):
        if chain is None:
            continue
        current = upsert_latest(chain.where(F.col("_batch") <= upto), SLOT, ["_batch"])
        # The matches within a slot belong to the version of its summary.
        within = inner.join(current.select(*SLOT, "_batch"), [*SLOT, "_batch"], "left_semi")
        found = tables.pattern.heads(current).select(*at).unionByName(within.select(*at))
        sides.append(found.withColumn("change", F.lit(change)))
    if not sides:
        kinds = T.StructType([f for f in tables.inner.schema if f.name in at])
        return spark.createDataFrame([], kinds).withColumn("change", F.lit(1).cast("long")).select(*at, "change")
    both = sides[0].unionByName(sides[1])
    return both.groupBy(*at).agg(F.sum("change").alias("change")).where("change != 0")


def corrected_logins(
    json: DataFrame,
    state: str,
    checkpoint: str,
    slot_millis: int,
    scope: str = "same_type",
    min_run: int = 3,
    keep: Sequence[str] = (),
    order_by: Sequence[str] = LOGIN_ORDER,
    **options,
) -> tuple[StreamingQuery, MatchState]:
    """Runs of login warnings that end in a failure, per user, on a stream in any order; ``order_by`` begins with epoch milliseconds."""
    of = login_pattern(scope, min_run, keep, order_by)
    measures: Mapping[str, str] = of["measures"]
    pattern = RunPattern(
        tuple(of["partition_by"]), tuple(order_by), of["run_pred"], of["end_pred"], F.floor(F.col(order_by[0]) / slot_millis),
        min_run, tuple(measures.items()), of["count_as"],
    )
    return match_run_then_corrected(json, state, checkpoint, pattern, **options)

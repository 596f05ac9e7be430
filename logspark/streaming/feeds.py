"""Totals, co-occurrences and enriched rows of streams, kept up to date by what changes, with feeds of the changes.

State lies in folders per slot (a period of time, or a share of the keys) and version. A micro-batch reads
the newest version of the slots it touches, writes their next one, and leaves all others alone, so its cost
does not grow with the history of the stream. The version before stays until the next batch, because a
batch that fails runs again from it; older ones are removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logspark.operators.enrich import enrich_users
from logspark.operators.keyed import upsert_latest
from logspark.streaming.corrections import SlotTable
from logspark.streaming.sinks import BatchTable, start
from logspark.streaming.windows import entry_totals, tagged_entries


def _children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(f.getPath().getName()) for f in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


class VersionTable(SlotTable):
    """Rows by slot, of which the newest version counts."""

    def _newest(self, spark: SparkSession, slot: int, upto: int | None) -> int | None:
        found = _children(spark, f"{self.path}/_slot={slot}", "_batch=")
        return max((v for v in found if upto is None or v <= upto), default=None)

    def latest(self, spark: SparkSession, slots: Iterable[int] | None = None, upto: int | None = None) -> DataFrame:
        """Rows of the newest versions (up to a batch) of the given slots, or of all."""
        wanted = self.slots(spark) if slots is None else sorted(slots)
        versions = {s: v for s in wanted if (v := self._newest(spark, s, upto)) is not None}
        kinds = T.StructType([*self.schema.fields, T.StructField("_slot", T.LongType())])
        if not versions:
            return spark.createDataFrame([], kinds)
        folders = [f"{self.path}/_slot={s}/_batch={v}" for s, v in versions.items()]
        return spark.read.schema(kinds).option("basePath", self.path).parquet(*folders).drop("_batch")

    def remove_before(self, spark: SparkSession, slots: Iterable[int], batch_id: int) -> None:
        """Remove the versions that neither readers nor a batch that runs again need."""
        for s in slots:
            kept = self._newest(spark, s, batch_id - 1)
            for v in _children(spark, f"{self.path}/_slot={s}", "_batch="):
                if kept is not None and v < kept:
                    place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_slot={s}/_batch={v}")
                    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _touched(df: DataFrame) -> list[int]:
    return [r["_slot"] for r in df.select("_slot").distinct().collect()]


@dataclass(frozen=True)
class TotalsFeed:
    """Rows and distinct values per group of a stream, and the feed of their changes.

    ``slot`` is a whole number that rows of a group share: the day of a time bucket, or a share of the keys.
    """

    path: str
    types: T.StructType
    by: tuple[str, ...]
    distinct: tuple[tuple[str, str], ...]
    slot: Column

    @property
    def aliases(self) -> list[str]:
        return ["event_count", *(alias for alias, _ in self.distinct)]

    @property
    def counts(self) -> VersionTable:
        entry = [T.StructField("tag", T.IntegerType()), T.StructField("item", T.StringType()), T.StructField("n", T.LongType())]
        return VersionTable(f"{self.path}/counts", T.StructType([*(self.types[c] for c in self.by), *entry]))

    @property
    def changes(self) -> BatchTable:
        return BatchTable(f"{self.path}/changes")

    @property
    def work(self) -> BatchTable:
        """Per micro-batch: rows of state that were read."""
        return BatchTable(f"{self.path}/work")

    def _step(self, batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, ["_slot", *self.by, "tag", "item"]
        slotted = batch.withColumn("_slot", F.coalesce(self.slot.cast("long"), F.lit(-1)))
        entries = tagged_entries(slotted, self.by, [c for _, c in self.distinct], also=["_slot"])
        counted = entries.groupBy(*key).agg(F.count("*").alias("n")).persist()
        try:
            slots = _touched(counted)
            old = self.counts.latest(spark, slots, batch_id - 1)
            if slots:
                self.counts.write(old.unionByName(counted).groupBy(*key).agg(F.sum("n").alias("n")), batch_id)
            new = self.counts.latest(spark, slots, batch_id)
            sides = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
            # Every row of a batch adds to its group, so the groups that changed are those with another count.
            now = sides.groupBy("_slot", *self.by).agg(*self._totals(F.col("_new"), ""), *self._totals(~F.col("_new"), "old_"))
            self.changes.write(now.where("event_count != old_event_count").drop("_slot"), batch_id)
            self.work.write(old.agg(F.count("*").alias("rows")), batch_id)
            self.counts.remove_before(spark, slots, batch_id)
        finally:
            counted.unpersist()

    def _totals(self, side: Column, prefix: str) -> list[Column]:
        seen = F.col("item").isNotNull() & side
        rows = F.sum(F.when((F.col("tag") == 0) & side, F.col("n")).otherwise(0)).alias(f"{prefix}event_count")
        return [rows, *(F.count_if((F.col("tag") == i) & seen).alias(prefix + alias) for i, alias in enumerate(self.aliases[1:], 1))]

    def run(self, df: DataFrame, checkpoint: str, available_now: bool = True, **trigger) -> StreamingQuery:
        writer = df.writeStream.foreachBatch(self._step).option("checkpointLocation", checkpoint)
        return start(writer, available_now, trigger)

    def totals(self, spark: SparkSession, min_count: int = 0) -> DataFrame:
        """Totals from the state: one version of each slot, whatever the number of batches."""
        out = self.counts.latest(spark).groupBy(*self.by).agg(*entry_totals(self.aliases[1:]))
        return out.where(F.col("event_count") > min_count)

    def applied(self, spark: SparkSession, min_count: int = 0) -> DataFrame:
        """Totals as one who follows the feed has them: the last change of each group."""
        changes = spark.read.option("basePath", self.changes.path).parquet(self.changes.path)
        return upsert_latest(changes, self.by, ["batch_id"]).select(*self.by, *self.aliases).where(F.col("event_count") > min_count)


@dataclass(frozen=True)
class PairFeed:
    """Co-occurrences of two kinds of rows by bucket, kept by the change of a product: dA x B + A x dB + dA x dB.

    Rows of both kinds come as one stream with ``side`` (0 or 1), ``bucket``, and the classes of both sides, of which
    those of the other side are null. Only buckets of the batch are joined, with stored counts of their slots.
    """

    path: str
    types: T.StructType
    left: tuple[str, ...]
    right: tuple[str, ...]
    slot: Column

    @property
    def classes(self) -> list[str]:
        return [*self.left, *self.right]

    @property
    def counts(self) -> VersionTable:
        kinds = [T.StructField("side", T.IntegerType()), self.types["bucket"], *(self.types[c] for c in self.classes), T.StructField("n", T.LongType())]
        return VersionTable(f"{self.path}/counts", T.StructType(kinds))

    @property
    def pairs(self) -> BatchTable:
        """Totals per pair of classes after each of the last two batches."""
        return BatchTable(f"{self.path}/pairs")

    def _schema(self) -> T.StructType:
        return T.StructType([*(self.types[c] for c in self.classes), T.StructField("correlated_events", T.LongType())])

    def _side(self, counts: DataFrame, side: int) -> DataFrame:
        names = self.right if side else self.left
        return counts.where(F.col("side") == side).select("bucket", *names, F.col("n").alias(f"n{side}"))

    def _step(self, batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, ["_slot", "side", "bucket", *self.classes]
        slotted = batch.withColumn("side", F.col("side").cast("int")).withColumn("_slot", F.coalesce(self.slot.cast("long"), F.lit(-1)))
        new = slotted.groupBy(*key).agg(F.count("*").alias("n")).persist()
        try:
            slots = _touched(new)
            old = self.counts.latest(spark, slots, batch_id - 1)
            both = old.unionByName(new)
            if slots:
                self.counts.write(both.groupBy(*key).agg(F.sum("n").alias("n")), batch_id)
            products = [self._side(new, 0).join(self._side(both, 1), "bucket"), self._side(old, 0).join(self._side(new, 1), "bucket")]
            more = products[0].unionByName(products[1]).select(*self.classes, (F.col("n0") * F.col("n1")).alias("correlated_events"))
            before = self.pairs.read(spark, self._schema(), batch_id - 1)
            total = before.unionByName(more).groupBy(*self.classes).agg(F.sum("correlated_events").alias("correlated_events"))
            self.pairs.write(total, batch_id)
            self.pairs.drop(spark, batch_id - 2)
            self.counts.remove_before(spark, slots, batch_id)
        finally:
            new.unpersist()

    def run(self, df: DataFrame, checkpoint: str, available_now: bool = True, **trigger) -> StreamingQuery:
        writer = df.writeStream.foreachBatch(self._step).option("checkpointLocation", checkpoint)
        return start(writer, available_now, trigger)

    def totals(self, spark: SparkSession, min_count: int = 0) -> DataFrame:
        done = [b for b in _children(spark, self.pairs.path, "batch_id=") if _children_named(spark, self.pairs.folder(b), "_SUCCESS")]
        out = self.pairs.read(spark, self._schema(), max(done, default=-1))
        return out.where(F.col("correlated_events") > min_count)


def _children_named(spark: SparkSession, path: str, name: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def with_validity(versions: DataFrame, key: str = "username", since: str = "valid_from") -> DataFrame:
    """Adds ``valid_until``, when the next version of the key begins; null for the last."""
    return versions.withColumn("valid_until", F.lead(since).over(Window.partitionBy(key).orderBy(since)))


def join_as_of(rows: DataFrame, versions: DataFrame, time: str, key: str = "username", since: str = "valid_from") -> DataFrame:
    """Each row with the version of its key that holds at its time; rows before the first version have none and go."""
    dated = with_validity(versions, key, since)
    holds = (rows[key] == dated[key]) & (rows[time] >= dated[since]) & (dated["valid_until"].isNull() | (rows[time] < dated["valid_until"]))
    return rows.join(dated, holds).drop(dated[key]).drop(since, "valid_until")


@dataclass(frozen=True)
class EnrichedFeed:
    """The newest failed login of each user with the newest details of that user; a change of either gives a new text.

    One stream holds both kinds of rows: ``attempt`` and ``user`` are structs, one of them null. Within a batch the last
    by ``attempt_order`` or ``user_order`` wins, and a later batch wins over an earlier one only if it is not older.
    """

    path: str
    attempt: T.StructType
    user: T.StructType
    attempt_order: tuple[str, ...]
    user_order: tuple[str, ...]
    key: str = "username"
    shares: int = 16

    def _table(self, name: str, kind: T.StructType) -> VersionTable:
        return VersionTable(f"{self.path}/{name}", kind)

    @property
    def changes(self) -> BatchTable:
        """username, the new ``big_string`` and the old one, per micro-batch."""
        return BatchTable(f"{self.path}/changes")

    def _merged(self, batch: DataFrame, name: str, kind: T.StructType, order: tuple[str, ...], slots: list[int], batch_id: int) -> tuple[DataFrame, DataFrame]:
        """The newest rows per user before and after the batch, in the touched slots."""
        spark, table = batch.sparkSession, self._table(name, kind)
        old = table.latest(spark, slots, batch_id - 1)
        new = batch.where(F.col(name).isNotNull()).select(f"{name}.*", "_slot")
        table.write(upsert_latest(old.unionByName(new), [self.key, "_slot"], order), batch_id)
        return old, table.latest(spark, slots, batch_id)

    def _step(self, batch: DataFrame, batch_id: int) -> None:
        name = F.coalesce(F.col(f"attempt.{self.key}"), F.col(f"user.{self.key}"))
        batch = batch.withColumn("_slot", F.pmod(F.xxhash64(name), F.lit(self.shares))).persist()
        try:
            slots = _touched(batch)
            attempts = self._merged(batch, "attempt", self.attempt, self.attempt_order, slots, batch_id)
            users = self._merged(batch, "user", self.user, self.user_order, slots, batch_id)
            before, after = (enrich_users(a.drop("_slot"), u.drop("_slot")) for a, u in zip(attempts, users))
            old = before.select(self.key, F.col("big_string").alias("old_big_string"))
            both = after.join(old, self.key, "left").where(~F.col("big_string").eqNullSafe(F.col("old_big_string")))
            self.changes.write(both, batch_id)
            for kind, schema in (("attempt", self.attempt), ("user", self.user)):
                self._table(kind, schema).remove_before(batch.sparkSession, slots, batch_id)
        finally:
            batch.unpersist()

    def run(self, df: DataFrame, checkpoint: str, available_now: bool = True, **trigger) -> StreamingQuery:
        writer = df.writeStream.foreachBatch(self._step).option("checkpointLocation", checkpoint)
        return start(writer, available_now, trigger)

    def enriched(self, spark: SparkSession) -> DataFrame:
        """The last text of each user, as one who follows the feed has it."""
        changes = spark.read.option("basePath", self.changes.path).parquet(self.changes.path)
        return upsert_latest(changes, self.key, ["batch_id"]).select(self.key, "big_string")


def pair_rows(sides: Sequence[DataFrame], bucket: Column, classes: Sequence[Mapping[str, str]]) -> DataFrame:
    """One stream of two kinds of rows, as ``PairFeed`` takes it; ``classes`` map columns to names."""
    parts = [
        df.select(F.lit(i).alias("side"), bucket.alias("bucket"), *[F.col(c).alias(a) for c, a in of.items()])
        for i, (df, of) in enumerate(zip(sides, classes))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)

"""Keyed tables: the latest row per key, and tables that take changes or plain appends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logspark.operators.levels import FAN, LeveledTable

def upsert_latest(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """The last change of every key.

    ``max_by`` combines on the map side, so each task sends one row per key however hot a key is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


@dataclass(frozen=True)
class KeyedTable:
    """A table with declared columns and a key that is not enforced.

    ``mode="upsert"``: every write is a batch of changes and readers see the last change per key
    (by ``order`` within a batch, later batches win). ``mode="append"``: readers see every row.
    Writing costs the size of the change, and of merging now and then (``operators.levels``), not of
    the table. Writing a batch again after a failure replaces it. Readers may read while a stream writes.
    """

    path: str
    ddl: str
    key: tuple[str, ...]
    mode: str = "upsert"
    order: tuple[str, ...] = ()
    fan: int = FAN

    def __post_init__(self):
        if self.mode not in ("upsert", "append"):
            raise ValueError(f"unknown mode: {self.mode}")
        missing = {*self.key, *self.order} - set(self.schema.names)
        if missing:
            raise ValueError(f"no such columns: {sorted(missing)}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def stored(self) -> LeveledTable:
        return LeveledTable(self.path, self._latest, self.schema, self.fan)

    def _latest(self, changes: DataFrame) -> DataFrame:
        return upsert_latest(changes, self.key, ("batch_id", *self.order)) if self.mode == "upsert" else changes

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Put rows in as batch ``batch_id``; the same id again replaces the first attempt."""
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        out = rows.select(*fields)
        if self.mode == "upsert" and self.order:
            out = upsert_latest(out, self.key, self.order)
        self.stored.write(out, batch_id)

    def changes(self, spark: SparkSession) -> DataFrame:
        """All stored rows, with their ``batch_id``; of batches merged by upsert, the last change of each key."""
        return self.stored.batches(spark)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows written as one batch, if it is the newest or not merged yet."""
        return self.stored.batch(spark, batch_id)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """What the newest version holds, or an earlier one that is still kept."""
        return self.stored.read(spark, version).select(*self.schema.names)

    def fold(self, spark: SparkSession, path: str) -> "KeyedTable":
        """A table at another path that starts from what readers of this one see.

        Folds all batches into one. Do it while nothing writes; the writer may then go on with the new
        table, as its next batch ids are higher.
        """
        table = replace(self, path=path)
        table.write(self.read(spark), batch_id=-1)
        return table

    def create(self, spark: SparkSession) -> "KeyedTable":
        """Make the table exist with no rows."""
        self.write(spark.createDataFrame([], self.schema), batch_id=-1)
        return self


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Create a table from a query and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_into(df: DataFrame, path: str) -> None:
    """Insert rows from a query, or literal rows, into a table."""
    df.write.mode("append").parquet(path)

"""Tables written batch by batch that stay few folders and can be read while they are written and folded.

What belongs to a version of the table is told by one small list of folders, so a version is there as a whole
or not at all: data are written first, the list is put in place by one rename, and what a crash leaves before
the rename belongs to no version. As soon as ``fan`` neighbours of one level are there besides the newest
batch, they are merged into one folder of the next level; a row is rewritten once per level, and the number of
folders follows the logarithm of the batches. Versions older than the last ``keep`` are removed; a reader has
that many writes' time to finish. One writer at a time, as a stream is; a second one that meets it gets an error.

The rename must refuse to replace a file, as it does on HDFS and local disks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logspark.operators.versions import Versions

#: Folders of one level that are merged into one of the next.
FAN = 8
#: Versions whose folders stay for readers that have opened them.
KEEP = 16


@dataclass(frozen=True)
class Folder:
    """Rows of the batches from ``first`` to ``last``."""

    name: str
    first: int
    last: int
    level: int = 0


def unchanged(rows: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class LeveledTable(Versions):
    """A table at ``path``; ``merge`` makes fewer rows of several batches' rows, which have a ``batch_id``.

    ``merge`` must be associative: merging merged rows gives what merging all rows gives. The ``batch_id`` of
    merged rows is that of their newest batch.
    """

    path: str
    merge: Callable[[DataFrame], DataFrame] = unchanged
    schema: T.StructType | None = None
    fan: int = FAN
    keep: int = KEEP

    def folders(self, spark: SparkSession, version: int | None = None) -> list[Folder]:
        """The folders of a version, oldest batches first; of the newest version where none is named."""
        if version is None:
            version = max(self.versions(spark), default=None)
            if version is None:
                return []
        return [Folder(**f) for f in self._listed(spark, version)]

    def _commit(self, spark: SparkSession, version: int, folders: list[Folder]) -> None:
        self._put_in_place(spark, version, [vars(f) for f in folders])

    def _clean(self, spark: SparkSession) -> None:
        """Remove versions before the last ``keep``, and folders that none of the others names.

        A folder starts with the number of the version it was written for, so what a writer is busy with stays.
        """
        versions = self.versions(spark)
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        for version in old:
            place, files = self._place(spark, f"_versions/v{version:012d}.json")
            files.delete(place, False)
        named = {f.name for v in kept for f in self.folders(spark, v)}
        for batch in self._names(spark, "data"):
            for token in self._names(spark, f"data/{batch}"):
                if f"{batch}/{token}" not in named and int(token.split("-")[0]) <= kept[0]:
                    place, files = self._place(spark, f"data/{batch}/{token}")
                    files.delete(place, True)
            if not self._names(spark, f"data/{batch}"):
                place, files = self._place(spark, f"data/{batch}")
                files.delete(place, False)

    # --- rows ----------------------------------------------------------------------------------

    def _put(self, rows: DataFrame, version: int, first: int, last: int, level: int) -> Folder:
        name = f"batch_id={last}/{version}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{name}")
        return Folder(name, first, last, level)

    def _rows(self, spark: SparkSession, folders: list[Folder]) -> DataFrame:
        reader = spark.read.option("basePath", f"{self.path}/data")
        if self.schema is not None:
            reader = reader.schema(T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())]))
        rows = reader.parquet(*[f"{self.path}/data/{f.name}" for f in folders])
        return rows.withColumn("batch_id", F.col("batch_id").cast("long"))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Put rows in as a batch. The same id again replaces the first attempt, as long as it is not merged with
        others; the newest batch never is."""
        spark = rows.sparkSession
        folders = self.folders(spark)
        if any(f.first <= batch_id <= f.last and f.first < f.last for f in folders):
            raise ValueError(f"batch {batch_id} is merged with others already")
        version = max(self.versions(spark), default=0) + 1
        folders = [f for f in folders if f.last != batch_id] + [self._put(rows, version, batch_id, batch_id, 0)]
        self._commit(spark, version, sorted(folders, key=lambda f: f.first))
        while self._fold(spark):
            pass
        self._clean(spark)

    def _fold(self, spark: SparkSession) -> bool:
        """Merge the oldest ``fan`` neighbours of one level, without the newest batch; tell whether there were any."""
        folders = self.folders(spark)
        for start in range(len(folders) - self.fan):
            run = folders[start : start + self.fan]
            if len({f.level for f in run}) == 1:
                version = max(self.versions(spark)) + 1
                merged = self.merge(self._rows(spark, run))
                one = self._put(merged.drop("batch_id"), version, run[0].first, run[-1].last, run[0].level + 1)
                self._commit(spark, version, folders[:start] + [one] + folders[start + self.fan :])
                return True
        return False

    def batches(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The stored rows with their ``batch_id``, merged ones with that of the newest of theirs."""
        folders = self.folders(spark, version)
        if folders:
            return self._rows(spark, folders)
        if self.schema is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())]))

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows of a batch that is not merged with others, as the newest is."""
        folder = [f for f in self.folders(spark) if f.first == f.last == batch_id]
        if not folder:
            raise FileNotFoundError(f"no batch {batch_id} of its own in {self.path}")
        return self._rows(spark, folder).drop("batch_id")

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table as merging all batches gives it; a reader stays with the version it opened."""
        return self.merge(self.batches(spark, version)).drop("batch_id")

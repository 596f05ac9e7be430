"""Stored log tables: Parquet, one folder per day, appended and never rolled up."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.functions.time import within

# Rows per file and how often a stream looks for new data.
MAX_ROWS_PER_FILE = 5_000_000
CHECK_PERIOD = "30 seconds"
#: Size of a row group of clustered days: small ones skip more, large ones scan faster.
ROW_GROUP_BYTES = 32 * 1024 * 1024


def write_bronze(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a day-partitioned table.

    A batch that runs again after a failure replaces its own folders.
    """
    name = f"stream-{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}"

    def store(batch: DataFrame, batch_id: int) -> None:
        _put(batch, path, f"{name}-{batch_id}")

    writer = df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": CHECK_PERIOD}
    return writer.trigger(**trigger).start()


def append_bronze(df: DataFrame, path: str, part: str | None = None) -> None:
    """Append a batch to a day-partitioned table. With a name for it, doing so again replaces it."""
    _put(df, path, part or f"append-{uuid.uuid4().hex}")


def _put(df: DataFrame, path: str, part: str) -> None:
    """Rows into one folder per day and part.

    Rebalancing by day gathers the rows of a small day into few files and splits a day that holds
    much of the data over many tasks.
    """
    writer = df.withColumn("part", F.lit(part)).hint("rebalance", "event_date").write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "part")
    writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(path)


def append_clustered(
    df: DataFrame, path: str, by: Sequence[str], part: str | None = None, group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Append a batch to a day-partitioned table so that rows of one value of ``by`` lie together.

    Rows are cut into ranges of (day, ``by``) and sorted within them: a lookup by the first column passes over all row groups
    whose least and greatest value rule it out. Every column has a Bloom filter per row group, for
    lookups by the others. A value that holds much of a day is still split over tasks, by ``event_ts``.
    """
    rows = df.withColumn("part", F.lit(part or f"append-{uuid.uuid4().hex}"))
    writer = clustered_writer(rows, by, group_bytes).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date", "part").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(path)


def clustered_writer(rows: DataFrame, by: Sequence[str], group_bytes: int = ROW_GROUP_BYTES) -> DataFrameWriter:
    """Ranges of (day, ``by``), with a Bloom filter per row group for each column of ``by``."""
    keys = ["event_date", *by, "event_ts"]
    writer = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("parquet.block.size", group_bytes)
    for column in by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def lookup(spark: SparkSession, path: str, wanted: Mapping[str, object], since=None, until=None) -> DataFrame:
    """The rows of a stored table that have all these values: days are pruned by folder, row groups by range and Bloom filter."""
    rows = read_bronze(spark, path, since, until)
    for column, value in wanted.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    return rows


def replace_day(spark: SparkSession, path: str, day, rows: DataFrame | None = None) -> None:
    """Put ``rows`` in place of a day, or rewrite the day's own rows as few files.

    What is new is complete before what is old is removed; in between the day can be read twice. No
    other writer may add to that day meanwhile.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/event_date={day}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in files.listStatus(place)] if files.exists(place) else []
    if rows is None:
        rows = read_bronze(spark, path).filter(F.col("event_date") == F.lit(str(day)).cast("date"))
    else:
        rows = rows.withColumn("event_date", F.lit(str(day)).cast("date"))
    append_bronze(rows, path)
    for folder in old:
        files.delete(folder, True)


def read_bronze(spark: SparkSession, path: str, since=None, until=None) -> DataFrame:
    """A stored table, or its rows in ``[since, until)``: the range prunes day folders, too."""
    return within(spark.read.parquet(path).drop("part"), since, until)

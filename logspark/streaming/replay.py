"""Run a stream over a stored table of events to its end, in several micro-batches.

The events are copied into files: dealt by a hash of their ids, so that every micro-batch holds all
times, or cut by time, where the stream stops after each part and goes on with the next. A file holds
a bounded number of rows and a micro-batch as many files as it needs. The stream runs in a session of
its own; the caller's settings stay as they are. Copy and checkpoint are removed at the end.

A pattern comes out once the watermark has passed it, so a table that ends leaves the last ones
open. With ``marks`` the stream goes on over two closing marks in the far future.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.fixtures import EVENTS_DDL, Logs, cef_logs, json_logs, prepare_events, syslog_logs
from logspark.session import scratch_dir, use_rocksdb_state, use_utc
from logspark.streaming.sinks import append_stream

#: Micro-batches that a table is read in.
BATCHES = 5
#: Rows of a file of the copy, and so of a task that writes or reads it.
ROWS_PER_FILE = 250_000
# Two ids, because even ones make syslog records and odd ones CEF records.
MARKS = """
SELECT id AS event_id, TIMESTAMP_NTZ'2200-01-01 00:00:00' AS ts, 7L AS user_id, 'mark' AS event_type,
       0D AS value, '{"k": 99}' AS props FROM VALUES (0L), (1L) AS t(id)
"""


def stream_session(spark: SparkSession) -> SparkSession:
    """A session over the same cluster with settings of its own; state is split by the number of cores."""
    own = use_rocksdb_state(use_utc(spark.newSession()))
    # Events take some 20 bytes a row in files and hundreds when they are decoded and kept.
    own.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    own.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return own


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def files_of(events: DataFrame) -> int:
    """Files that hold a micro-batch, so that a task writes and reads a bounded number of rows."""
    return max(1, -(-events.count() // ROWS_PER_FILE))


def feed_in_any_order(events: DataFrame, path: str) -> Iterator[int]:
    files = -(-files_of(events) // BATCHES)
    events.repartitionByRange(BATCHES * files, F.xxhash64("event_id")).write.parquet(path)
    yield files


def _one_part_after_the_other(dealt: DataFrame, path: str) -> Iterator[None]:
    """A micro-batch for each ``_part``; the next one is not there before the stream has taken in the last."""
    for k in range(BATCHES):
        rows = dealt.where(F.col("_part") == k).drop("_part")
        rows.repartition(files_of(rows)).write.mode("append").parquet(path)
        yield None


def feed_in_time_order(events: DataFrame, path: str) -> Iterator[None]:
    """Each micro-batch is a part of the range of times."""
    low, high = events.agg(F.min("ts").cast("timestamp"), F.max("ts").cast("timestamp")).first()
    part = F.lit(0)
    if low is not None and high > low:
        seconds = F.col("ts").cast("timestamp").cast("double")
        part = F.floor((seconds - low.timestamp()) / (high.timestamp() - low.timestamp()) * BATCHES)
    dealt = events.withColumn("_part", F.coalesce(F.least(part, F.lit(BATCHES - 1)), F.lit(0)))
    return _one_part_after_the_other(dealt, path)


def feed_with_late_rows(events: DataFrame, path: str) -> Iterator[None]:
    """In order of time, but of a quarter of the users one row in sixteen comes a batch or more too late."""
    spans = events.agg(F.min("ts").cast("timestamp").cast("double"), F.max("ts").cast("timestamp").cast("double")).first()
    low, high = (s or 0.0 for s in spans)
    part = F.least(F.floor((F.col("ts").cast("timestamp").cast("double") - low) / max(high - low, 1e-6) * BATCHES), F.lit(BATCHES - 1))
    draw = F.pmod(F.xxhash64("event_id"), F.lit(16 * BATCHES))
    late = F.when((F.col("user_id") % 4 == 0) & (draw < BATCHES), F.least(part + 1 + draw, F.lit(BATCHES - 1))).otherwise(part)
    return _one_part_after_the_other(events.withColumn("_part", F.coalesce(late, F.lit(0))), path)


def replay(
    spark: SparkSession,
    sf_dir: str,
    build: Callable[[Logs], DataFrame],
    base: str,
    sink: Callable[[DataFrame, str, str], StreamingQuery] = append_stream,
    feed: Callable[[DataFrame, str], Iterator[int | None]] = feed_in_any_order,
    marks: bool = False,
) -> str:
    """Run the stream ``build`` makes from the log streams of a folder of tables; give its result path.

    ``feed`` writes files and tells how many of them make a micro-batch, or None where all that are new make one;
    the stream takes them in each time it does so.
    """
    own = stream_session(spark)

    def events(files: int | None) -> DataFrame:
        reader = own.readStream.schema(EVENTS_DDL)
        reader = reader.option("maxFilesPerTrigger", files) if files else reader
        return prepare_events(reader.parquet(f"{base}/events"))

    def run(files: int | None) -> None:
        logs = Logs(*[derive(events(files)) for derive in (json_logs, syslog_logs, cef_logs)])
        sink(build(logs), f"{base}/result", f"{base}/checkpoint").awaitTermination()

    rows = own.read.parquet(f"{sf_dir}/events.parquet").select(*[c.split()[0] for c in EVENTS_DDL.split(", ")])
    for files in feed(rows, f"{base}/events"):
        run(files)
    if marks:
        own.sql(MARKS).coalesce(1).write.mode("append").parquet(f"{base}/events")
        run(None)
    for done in ("events", "checkpoint"):
        remove(spark, f"{base}/{done}")
    return f"{base}/result"


def replayed(spark: SparkSession, sf_dir: str, build: Callable[[Logs], DataFrame], name: str, **options) -> DataFrame:
    """The rows a stream appends, as a table."""
    return spark.read.parquet(replay(spark, sf_dir, build, scratch_dir(spark, name), **options))

"""Records that cannot be decoded: set aside as hex, counted, and a reason to stop when too many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.sources.ingest import ingest
from logspark.sources.logs import decode_topic


@dataclass(frozen=True)
class BadRecordPolicy:
    """Stop above ``max_bad`` bad records; show at most ``keep`` of them in the report."""

    max_bad: int
    keep: int


# Limits per kind.
POLICIES = {
    "json": BadRecordPolicy(max_bad=1000, keep=100),
    "syslog": BadRecordPolicy(max_bad=2000, keep=200),
    "cef": BadRecordPolicy(max_bad=2000, keep=200),
}


class TooManyBadRecords(RuntimeError):
    pass


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("record").isNotNull()).select("record.*")


def bad_records(decoded: DataFrame) -> DataFrame:
    """Topic position and raw bytes, as hex, of records without a decoded value."""
    return decoded.filter(F.col("record").isNull()).select(
        "topic", "partition", "offset", F.hex("value").alias("raw_hex")
    )


def saved_sample(bad: DataFrame, policy: BadRecordPolicy) -> DataFrame:
    """The first ``keep`` bad records by topic position, for the report."""
    return bad.orderBy("topic", "partition", "offset").limit(policy.keep)


def quarantine(
    raw: DataFrame,
    kind: str,
    good_path: str,
    bad_path: str,
    checkpoint: str,
    policy: BadRecordPolicy | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Store good records as ingested logs and bad ones as hex; stop when too many are bad.

    Every batch writes its own partitions and replaces them as a whole, so a replayed batch
    stores its rows once. Bad records are stored and counted per batch, and the counts are added up,
    before the job stops; the error names the first of the bad records, which are also stored
    beside them (``-sample``).
    """
    policy = policy or POLICIES[kind]
    bad_schema = "topic string, partition int, offset long, raw_hex string, batch_id long"

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = decode_topic(batch, kind).persist()
        try:
            shaped = ingest(good_records(decoded), kind).withColumn("batch_id", F.lit(batch_id))
            _replace(shaped.hint("rebalance", "event_date"), good_path, ["event_date", "batch_id"])
            _replace(bad_records(decoded).withColumn("batch_id", F.lit(batch_id)), bad_path, ["batch_id"])
        finally:
            decoded.unpersist()
        stored = spark.read.schema(bad_schema).option("basePath", bad_path)
        counts = f"{bad_path}-counts"
        new = stored.parquet(f"{bad_path}/batch_id={batch_id}") if _exists(spark, f"{bad_path}/batch_id={batch_id}") else None
        number = F.lit(0).cast("long") if new is None else F.lit(new.count())
        _replace(spark.range(1).select(number.alias("n"), F.lit(batch_id).alias("batch_id")), counts, ["batch_id"])
        # One small number per batch; records that were stored before are not read again.
        known = spark.read.schema("n long, batch_id long").parquet(counts).filter(F.col("batch_id") <= batch_id)
        count = known.agg(F.sum("n")).first()[0]
        if count > policy.max_bad:
            sample = f"{bad_path}-sample"
            saved_sample(stored.parquet(bad_path), policy).write.mode("overwrite").parquet(sample)
            first = [f"{r.topic}/{r.partition}/{r.offset}" for r in spark.read.parquet(sample).collect()]
            raise TooManyBadRecords(f"{count} bad {kind} records, limit {policy.max_bad}, among them {', '.join(first)}")

    writer = raw.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _replace(df: DataFrame, path: str, partition_by: list[str]) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)

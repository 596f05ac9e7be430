"""Publishing logs to topics as keyed Avro records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from logspark.schemas import TOPICS, log_schema
from logspark.sources.avro import encode_avro

# Producer settings.
PRODUCER_OPTIONS = {
    "kafka.batch.size": "100000",
    "kafka.linger.ms": "100",
}


def log_value(df: DataFrame, kind: str, schema_id: int = 1) -> Column:
    """The Avro value of each log in ``df``."""
    schema = log_schema(kind)
    record = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return encode_avro(record, schema, schema_id, df.sparkSession)


def topic_rows(df: DataFrame, kind: str, key: str | Column, schema_id: int = 1) -> DataFrame:
    """topic, key, value rows of logs, ready for a topic sink."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(
        F.lit(TOPICS[kind]).alias("topic"),
        key.cast("string").cast("binary").alias("key"),
        log_value(df, kind, schema_id).alias("value"),
    )


def publish(rows: DataFrame, servers: str | None = None, path: str | None = None, **options: str) -> None:
    """Send a batch of topic rows to Kafka, or to a folder with one sub-folder per topic."""
    if servers:
        settings = PRODUCER_OPTIONS | {"kafka.bootstrap.servers": servers} | options
        rows.write.format("kafka").options(**settings).save()
    else:
        rows.write.mode("append").partitionBy("topic").options(**options).parquet(path)


def publish_stream(
    rows: DataFrame, checkpoint: str, servers: str | None = None, path: str | None = None, **options: str
) -> StreamingQuery:
    """Send a stream of topic rows to the same places, until it is stopped."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    if servers:
        settings = PRODUCER_OPTIONS | {"kafka.bootstrap.servers": servers} | options
        return writer.format("kafka").options(**settings).start()
    return writer.format("parquet").partitionBy("topic").options(**options).start(path)

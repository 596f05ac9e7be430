"""Reading logs: topics, files of a fixed schema, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.schemas import TOPICS, log_schema
from logspark.sources.avro import decode_avro

TOPIC_COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value")


def topic_options(kind: str, servers: str, starting: str = "earliest", **options: str) -> dict[str, str]:
    """Options of the Kafka source for one kind of log. Each kind reads its own topic.

    ``starting`` is ``earliest`` for ingestion and ``latest`` for monitoring. Give ``minPartitions``
    to split a topic that has fewer partitions than the cluster has cores. Security settings pass
    through with a ``kafka.`` prefix.
    """
    if starting not in ("earliest", "latest") and not starting.startswith("{"):
        raise ValueError(f"unknown start position: {starting}")
    return {"kafka.bootstrap.servers": servers, "subscribe": TOPICS[kind], "startingOffsets": starting} | options


def read_topic_stream(
    spark: SparkSession, kind: str, servers: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Raw topic records as a stream."""
    stream = spark.readStream.format("kafka").options(**topic_options(kind, servers, starting, **options))
    return stream.load().select(*TOPIC_COLUMNS)


def decode_topic(raw: DataFrame, kind: str) -> DataFrame:
    """Topic records with the decoded log in ``record``, null where the value cannot be decoded."""
    return decode_avro(raw, log_schema(kind))


def read_log_stream(
    spark: SparkSession, kind: str, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Logs of one kind as a stream, with the declared schema.

    ``fmt="kafka"`` takes the options of ``read_topic_stream``; a value that cannot be decoded stays, as hex
    in ``undecoded`` beside null columns. Any other format is a folder of files.
    """
    if fmt == "kafka":
        decoded = decode_topic(read_topic_stream(spark, kind, **options), kind)
        return decoded.select("record.*", F.when(F.col("record").isNull(), F.hex("value")).alias("undecoded"))
    return spark.readStream.format(fmt).schema(log_schema(kind)).options(**options).load(path)


def log_table(spark: SparkSession, source: str) -> DataFrame:
    """A whole stored table, by name or by path."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)

"""The shape of an ingested log: typed event time, declared columns, a row count.

Late and early rows stay unless asked otherwise, and no watermark is set here, so nothing is lost
on the way to the stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.functions.time import event_timestamp, period_interval
from logspark.schemas import log_schema


def with_event_ts(df: DataFrame) -> DataFrame:
    """Event time from epoch milliseconds, and its day, by which tables are partitioned."""
    return df.withColumn("event_ts", event_timestamp()).withColumn("event_date", F.to_date("event_ts"))


def project_dimensions(df: DataFrame, kind: str) -> DataFrame:
    """The declared columns of a kind with ingested types, plus event time.

    Whole numbers are stored as long; ``event_time`` itself is replaced by ``event_ts``.
    """
    columns = []
    for field in log_schema(kind):
        if field.name == "event_time":
            continue
        wide = field.dataType.typeName() == "integer"
        columns.append(F.col(field.name).cast("long" if wide else field.dataType).alias(field.name))
    return df.select("event_ts", *columns, "event_date")


def with_row_count(df: DataFrame) -> DataFrame:
    """The ``count`` metric of a table that is not rolled up: one per row."""
    return df.withColumn("count", F.lit(1).cast("long"))


def reject_outside(df: DataFrame, late: str | None = None, early: str | None = None, now=None) -> DataFrame:
    """Drop rows older than ``late`` or more than ``early`` ahead; None rejects nothing."""
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    if late:
        df = df.filter(F.col("event_ts") >= now - period_interval(late))
    if early:
        df = df.filter(F.col("event_ts") <= now + period_interval(early))
    return df


def ingest(df: DataFrame, kind: str, late: str | None = None, early: str | None = None) -> DataFrame:
    """From decoded logs to rows of the stored table."""
    shaped = project_dimensions(with_event_ts(df), kind)
    return with_row_count(reject_outside(shaped, late, early))

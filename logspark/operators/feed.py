"""One feed of all kinds of log, with the columns charts ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.functions.time import within

# How charts name the kinds.
LOG_TYPES = {"json": "JSON", "syslog": "Syslog", "cef": "CEF"}


def event_feed(json: DataFrame, syslog: DataFrame, cef: DataFrame, since=None, until=None) -> DataFrame:
    """event_time, log_type, source_ip, status, cef_event; null where a kind lacks a column.

    With a range, only its rows; name it here for tables stored by day, as the feed has no day.
    """
    none = F.lit(None).cast("string")

    def shaped(df, kind, source_ip=none, status=none, cef_event=none):
        return within(df, since, until).select(
            F.col("event_ts").alias("event_time"),
            F.lit(LOG_TYPES[kind]).alias("log_type"),
            source_ip.alias("source_ip"),
            status.alias("status"),
            cef_event.alias("cef_event"),
        )

    return (
        shaped(json, "json", source_ip=F.col("source_ip"), status=F.col("status"))
        .unionByName(shaped(syslog, "syslog"))
        .unionByName(shaped(cef, "cef", source_ip=F.col("extension.src"), cef_event=F.col("name")))
    )

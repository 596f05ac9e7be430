"""Activity summaries, top sources, incident filters, frequencies.

All groupings here use aggregates that combine on the map side, so a group that holds a third of
all rows reaches the shuffle as one partial row per task. Spark expands several COUNT(DISTINCT)
into two such steps keyed by (group, value), which spreads a hot group over its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logspark.functions.time import MINUTE, time_floor, time_prefix
from logspark.operators.ranking import ranked

# Words that mark a JSON log as an incident; case matters.
INCIDENT_KEYWORDS = ("unauthorized", "malware", "breach", "attack")
HIGH_SEVERITY = 7


def summarize(
    df: DataFrame,
    by: Sequence[str | Column],
    distinct: Mapping[str, str] | None = None,
    min_count: int = 0,
) -> DataFrame:
    """Rows and distinct values per group, groups with more than ``min_count`` rows."""
    counts = [F.count("*").alias("event_count")]
    counts += [F.count_distinct(F.col(column)).alias(alias) for alias, column in (distinct or {}).items()]
    out = df.groupBy(*by).agg(*counts)
    return out.filter(F.col("event_count") > min_count) if min_count else out


def activity(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str] | None = None,
    width: int | None = MINUTE,
    min_count: int = 10,
    limit: int | None = None,
) -> DataFrame:
    """Activity per text-time bucket and group; with ``limit`` the newest buckets first, then the largest groups.

    ``width`` is the prefix length of the bucket; None leaves time out.
    """
    keys: list[str | Column] = list(by)
    order = [F.desc("event_count"), *by]
    if width is not None:
        keys.insert(0, time_prefix("timestamp", width).alias("time_window"))
        order.insert(0, F.desc("time_window"))
    return ranked(summarize(df, keys, distinct, min_count), order, limit)


def top_sources(
    df: DataFrame,
    pred: Column | None = None,
    key: str = "source_ip",
    distinct: Mapping[str, str] | None = None,
    min_count: int = 5,
    limit: int | None = None,
) -> DataFrame:
    """Keys with the most rows for which ``pred`` holds."""
    rows = df if pred is None else df.filter(pred)
    return ranked(summarize(rows, [key], distinct, min_count), [F.desc("event_count"), key], limit)


def severity_number(column: str = "severity") -> Column:
    """Severity is text on the wire; text that is no number gives null and does not stop the job."""
    return F.col(column).try_cast("int")


def high_severity(cef: DataFrame, threshold: int = HIGH_SEVERITY, limit: int | None = None) -> DataFrame:
    """CEF events of at least the given severity, most severe first."""
    rows = cef.filter(severity_number() >= threshold).select(
        F.col("name").alias("event_name"),
        "severity",
        F.col("extension.src").alias("source_ip"),
        F.col("extension.dst").alias("destination_ip"),
        F.col("extension.msg").alias("message"),
    )
    order = [severity_number().desc(), "event_name", "source_ip", "destination_ip", "message"]
    return ranked(rows, order, limit)


def average_severity(cef: DataFrame, width: str = "PT1M", limit: int | None = None) -> DataFrame:
    """Average severity and sources per time bucket and vendor.

    An extension: stated as an aim of the activity analyses, but no query computes it.
    """
    out = cef.groupBy(time_floor("event_ts", width).alias("time_window"), "device_vendor").agg(
        F.avg(severity_number()).alias("average_severity"),
        F.count_distinct("extension.src").alias("unique_sources"),
    )
    return ranked(out, [F.desc("time_window"), "device_vendor"], limit)


def mentions(column: str, words: Sequence[str]) -> Column:
    """Whether the text holds any of the words anywhere; case matters."""
    return reduce(Column.__or__, (F.col(column).contains(word) for word in words))


def incidents(
    json: DataFrame,
    keywords: Sequence[str] = INCIDENT_KEYWORDS,
    status: str = "failure",
    limit: int | None = None,
) -> DataFrame:
    """JSON logs that failed or whose details hold a keyword, newest first."""
    hit = F.col("status") == status
    if keywords:
        hit = hit | mentions("details", keywords)
    rows = json.filter(hit).select(
        "timestamp", "log_id", "event_type", "status", "username", "source_ip", "destination_ip", "details"
    )
    return ranked(rows, [F.desc("timestamp"), "log_id"], limit)


def event_frequency(kinds: Mapping[str, DataFrame], width: str = "PT30M", limit: int | None = None) -> DataFrame:
    """Events per time bucket and kind of log.

    The kinds are tagged and put together first and counted once: one shuffle, not one per kind.
    """
    tagged = [
        df.select(time_floor("event_ts", width).alias("half_hour_bucket"), F.lit(kind).alias("log_type"))
        for kind, df in kinds.items()
    ]
    counts = reduce(DataFrame.unionByName, tagged).groupBy("half_hour_bucket", "log_type")
    return ranked(counts.agg(F.count("*").alias("event_count")), ["half_hour_bucket", "log_type"], limit)


def failure_sequences(
    json: DataFrame,
    start=None,
    end=None,
    status: str = "failure",
    limit: int | None = None,
) -> DataFrame:
    """Failures per source address and ``type|status`` text, both range ends included; None leaves an end open."""
    rows = json.filter(F.col("status") == status)
    if start is not None:
        rows = rows.filter(F.col("event_ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        rows = rows.filter(F.col("event_ts") <= F.lit(end).cast("timestamp"))
    counts = rows.groupBy(
        "source_ip", F.concat("event_type", F.lit("|"), "status").alias("event_sequence_sample")
    ).agg(F.count("*").alias("event_count"))
    return ranked(
        counts.select("source_ip", "event_count", "event_sequence_sample"),
        ["source_ip", "event_sequence_sample"],
        limit,
    )

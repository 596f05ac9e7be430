"""Correlation of log kinds, by time bucket and by address within a time bucket.

Both joins are many-to-many on coarse keys, so joining raw rows would pair every row of a bucket
with every other. Nothing here does that: each side is first counted (or made distinct) per bucket
and class, which turns a hot bucket into as many rows as it has classes, and counts are multiplied
after the join. The results equal those of the row-by-row join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.functions.time import MINUTE, as_timestamp, period_interval, time_floor, time_prefix, within
from logspark.operators.activity import HIGH_SEVERITY, severity_number
from logspark.operators.ranking import ranked
from logspark.operators.skew import join_splitting_hot_keys

SYSLOG_CLASS = {"hostname": "hostname", "application": "syslog_application", "priority": "syslog_priority"}
JSON_CLASS = {"event_type": "json_event_type", "status": "json_status"}
CORRELATED = [*SYSLOG_CLASS.values(), *JSON_CLASS.values()]
PAIR = ["time_window", "source_ip", "event_type", "status", "cef_event", "severity"]


def class_counts(df: DataFrame, bucket: Column, classes: dict[str, str], count: str) -> DataFrame:
    """Rows per bucket and class; ``classes`` maps input columns to output names."""
    keys = [F.col(column).alias(alias) for column, alias in classes.items()]
    return df.groupBy(bucket.alias("bucket"), *keys).agg(F.count("*").alias(count))


def bucket_pair_counts(syslog: DataFrame, json: DataFrame, bucket: Column) -> DataFrame:
    """Co-occurring pairs per bucket and pair of classes."""
    left = class_counts(syslog, bucket, SYSLOG_CLASS, "syslog_rows")
    right = class_counts(json, bucket, JSON_CLASS, "json_rows")
    pairs = F.col("syslog_rows") * F.col("json_rows")
    return left.join(right, "bucket").select("bucket", *CORRELATED, pairs.alias("pairs"))


def total_pairs(pair_counts: DataFrame, min_count: int = 1) -> DataFrame:
    """Pairs of all buckets added up; class pairs with more than ``min_count``."""
    out = pair_counts.groupBy(*CORRELATED).agg(F.sum("pairs").alias("correlated_events"))
    return out.filter(F.col("correlated_events") > min_count)


def correlate_by_prefix(
    syslog: DataFrame,
    json: DataFrame,
    width: int = MINUTE,
    min_count: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """How often a syslog class and a JSON class fall into the same text-time bucket.

    The bucket alone is the join key; hosts and addresses are not compared.
    """
    totals = total_pairs(bucket_pair_counts(syslog, json, time_prefix("timestamp", width)), min_count)
    return ranked(totals, [F.desc("correlated_events"), *CORRELATED], limit)


def _json_side(json: DataFrame, period: str, since, until) -> DataFrame:
    bucket = time_floor("event_ts", period)
    return within(json, since, until).select(bucket.alias("time_window"), "event_ts", "source_ip", "event_type", "status")


def _cef_side(cef: DataFrame, period: str, since, until) -> DataFrame:
    """CEF rows that can share a bucket with a JSON row of the range.

    The buckets of the range run from the one that holds ``since`` to the one that holds the last
    instant before ``until``; event times are compared, so the filter reaches the scan.
    """
    if since is not None:
        since = time_floor(as_timestamp(since), period)
    if until is not None:
        last = as_timestamp(until) - F.expr("INTERVAL '1' MICROSECOND")
        until = time_floor(last, period) + period_interval(period)
    return within(cef, since, until).select(
        time_floor("event_ts", period).alias("time_window"),
        F.col("extension.src").alias("source_ip"),
        F.col("name").alias("cef_event"),
        "severity",
    )


def _suspicious(threshold: int, status: str) -> Column:
    return (F.col("status") == status) | (severity_number() >= threshold)


def ip_pair_counts(
    json: DataFrame,
    cef: DataFrame,
    period: str = "PT1H",
    threshold: int = HIGH_SEVERITY,
    status: str = "failure",
    since=None,
    until=None,
) -> DataFrame:
    """JSON x CEF pairs of one address and bucket, where the JSON row failed or the CEF row is severe.

    Each kind of pair comes once, with the number of row pairs in ``pair_count``.
    """
    left = (
        _json_side(json, period, since, until)
        .groupBy("time_window", "source_ip", "event_type", "status")
        .agg(F.count("*").alias("json_rows"))
    )
    right = (
        _cef_side(cef, period, since, until)
        .groupBy("time_window", "source_ip", "cef_event", "severity")
        .agg(F.count("*").alias("cef_rows"))
    )
    joined = left.join(right, ["time_window", "source_ip"]).filter(_suspicious(threshold, status))
    return joined.select(*PAIR, (F.col("json_rows") * F.col("cef_rows")).alias("pair_count"))


def repeat_rows(df: DataFrame, count: str, limit: int, order: list[str]) -> DataFrame:
    """The first ``limit`` rows of the bag in which each row stands ``count`` times.

    Every kept row stands at least once, so the first ``limit`` distinct rows hold the answer, and
    none needs more than ``limit`` copies.
    """
    head = df.filter(F.col(count) > 0).orderBy(*order).limit(limit)
    copies = F.sequence(F.lit(1), F.least(F.col(count), F.lit(limit)).cast("int"))
    kept = [c for c in df.columns if c != count]
    return head.select(*kept, F.explode(copies).alias("_copy")).orderBy(*order).limit(limit).select(*kept)


def ip_incidents(json: DataFrame, cef: DataFrame, limit: int, **options) -> DataFrame:
    """Incident pairs as rows, repeated as often as they occur, the first ``limit`` of them.

    For the whole result use ``ip_pair_counts``, which says how often each row stands.
    """
    renamed = {"event_type": "json_event", "status": "json_status", "severity": "cef_severity"}
    pairs = ip_pair_counts(json, cef, **options).withColumnsRenamed(renamed)
    order = [renamed.get(c, c) for c in PAIR]
    return repeat_rows(pairs, "pair_count", limit, order)


def recent_ip_pairs(
    json: DataFrame,
    cef: DataFrame,
    since,
    until,
    period: str = "PT1H",
    threshold: int = HIGH_SEVERITY,
    status: str = "failure",
    limit: int | None = None,
    **skew,
) -> DataFrame:
    """Distinct pairs with the exact JSON event time, for JSON rows in ``[since, until)``.

    Both sides are made distinct before the join; the time of the JSON row gives its bucket, so
    the pairs come out distinct and need no second pass. JSON rows keep their exact time and so
    cannot be counted together; those of a hot address are split over tasks instead.
    """
    rows = _json_side(json, period, since, until)
    right = _cef_side(cef, period, since, until).distinct()
    spread_by = ["event_ts", "event_type", "status"]
    joined = join_splitting_hot_keys(
        rows.distinct(), right, ["time_window", "source_ip"], spread_by, count_in=rows, **skew
    )
    joined = joined.filter(_suspicious(threshold, status))
    pairs = joined.select(
        "time_window", F.col("event_ts").alias("event_time"), "source_ip", "event_type", "status", "cef_event",
        "severity",
    )
    order = [F.desc("time_window"), F.desc("event_time"), *pairs.columns[2:]]
    return ranked(pairs, order, limit)

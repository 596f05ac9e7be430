"""Chart queries: metrics by groups and time grain over a time range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from logspark.functions.time import as_timestamp, last_period, period_interval, time_floor
from logspark.operators.correlate import ip_pair_counts
from logspark.operators.ranking import page, ranked

# What the dashboard charts ask for.
LAST_WEEK = "P7D"
HOURLY = "PT1H"
ROW_LIMIT = 10_000
PAGE_LENGTH = 25


def chart_query(
    df: DataFrame,
    metrics: Mapping[str, Column],
    groupby: Sequence[str],
    grain: str | None = None,
    time_range: str | None = None,
    as_of=None,
    row_limit: int | None = ROW_LIMIT,
    order_desc: bool = True,
    time_col: str = "event_time",
) -> DataFrame:
    """Metrics per group, and per ``grain`` if given, ordered by the first metric.

    ``time_range`` is a period that ends at ``as_of``: its start is in the range, its end is not.
    """
    if time_range:
        df = df.filter(last_period(time_col, time_range, as_of))
    keys: list[str | Column] = list(groupby)
    names = list(groupby)
    if grain:
        keys.insert(0, time_floor(time_col, grain).alias("time_bucket"))
        names.insert(0, "time_bucket")
    out = df.groupBy(*keys).agg(*[metric.alias(alias) for alias, metric in metrics.items()])
    first = F.col(next(iter(metrics)))
    return ranked(out, [first.desc() if order_desc else first.asc(), *names], row_limit)


def event_frequency_chart(feed: DataFrame, as_of=None, **options) -> DataFrame:
    """Events per hour and kind of log, last week."""
    metrics = {"event_count": F.count("event_time")}
    return chart_query(feed, metrics, ["log_type"], HOURLY, LAST_WEEK, as_of, **options)


def top_sources_chart(feed: DataFrame, as_of=None, **options) -> DataFrame:
    """Events per source address, last week."""
    metrics = {"event_count": F.count("event_time")}
    return chart_query(feed, metrics, ["source_ip"], None, LAST_WEEK, as_of, **options)


def top_sources_page(feed: DataFrame, number: int, as_of=None) -> DataFrame:
    """One page of the table of top sources, counted from 0."""
    order = [F.desc("event_count"), "source_ip"]
    return page(top_sources_chart(feed, as_of), order, number, PAGE_LENGTH)


def incident_timeline_chart(json: DataFrame, cef: DataFrame, as_of=None, **options) -> DataFrame:
    """Incident pairs per hour, JSON status and CEF event, last week.

    The range applies to the JSON event time and the grain is the bucket of the pairs, so the
    pairs are counted per bucket already and only added up here.
    """
    until = as_timestamp(as_of)
    pairs = ip_pair_counts(json, cef, period=HOURLY, since=until - period_interval(LAST_WEEK), until=until)
    metrics = {"event_count": F.sum("pair_count")}
    return chart_query(
        pairs, metrics, ["status", "cef_event"], HOURLY, time_col="time_window", **options
    )

"""Windowed aggregates and joins on streams. All run in append mode: a window comes out once, when
the watermark has passed its end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logspark.functions.time import DAY, HOUR, MINUTE, iso_text, period_to_interval, time_prefix
from logspark.operators.correlate import CORRELATED, JSON_CLASS, SYSLOG_CLASS

WATERMARK = "10 minutes"
# Window length for each prefix length of ISO text.
PREFIX_WINDOW = {DAY: "1 day", HOUR: "1 hour", MINUTE: "1 minute"}


def window_label(width: int, column: str = "window") -> Column:
    """The text bucket a window stands for."""
    return time_prefix(iso_text(F.col(f"{column}.start")), width)


def distinct_stream(df: DataFrame, columns: Sequence[str], watermark: str = WATERMARK) -> DataFrame:
    """Distinct rows by ``columns``: copies of a row within the watermark delay are dropped.

    State is kept per row for that long only, so a copy that comes later counts as new.
    """
    return df.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(list(columns))


def tagged_entries(df: DataFrame, by: Sequence[str], distinct: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """One entry (tag 0) for each row and one (tag i) for its value in the i-th distinct column.

    Counted per (group, tag, item) and then per group, entries give rows and distinct values.
    """
    entries = [F.struct(F.lit(0).alias("tag"), F.lit(None).cast("string").alias("item"))] + [
        F.struct(F.lit(i).alias("tag"), F.col(column).cast("string").alias("item"))
        for i, column in enumerate(distinct, 1)
    ]
    return df.select(*also, *by, F.inline(F.array(*entries)))


def entry_totals(aliases: Sequence[str]) -> list[Column]:
    """Aggregates over entries counted as ``n`` per (group, tag, item)."""
    return [F.sum(F.when(F.col("tag") == 0, F.col("n")).otherwise(0)).alias("event_count")] + [
        F.count_if((F.col("tag") == i) & F.col("item").isNotNull()).alias(alias)
        for i, alias in enumerate(aliases, 1)
    ]


def activity_stream(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str] | None = None,
    width: int = MINUTE,
    min_count: int = 10,
    watermark: str = WATERMARK,
    exact: bool = True,
) -> DataFrame:
    """Activity per window and group.

    Streams refuse COUNT(DISTINCT). With ``exact`` each row gives one entry for itself and one per
    distinct column; a first aggregate keyed by (group, column, value) keeps one state row per
    value and a second one counts these. State is spread over the values, and no set of values is
    ever held in one place. Without ``exact`` a sketch per group does with one aggregate.
    """
    distinct = dict(distinct or {})
    rows = df.withWatermark("event_ts", watermark)
    window = F.window("event_ts", PREFIX_WINDOW[width]).alias("window")
    names = list(by)
    if exact:
        entries = tagged_entries(rows, by, list(distinct.values()), also=["event_ts"])
        values = entries.groupBy(window, *by, "tag", "item").agg(F.count("*").alias("n"))
        out = values.groupBy("window", *by).agg(*entry_totals(list(distinct)))
    else:
        counts = [F.approx_count_distinct(column).alias(alias) for alias, column in distinct.items()]
        out = rows.groupBy(window, *by).agg(F.count("*").alias("event_count"), *counts)
    out = out.filter(F.col("event_count") > min_count)
    return out.select(window_label(width).alias("time_window"), *names, "event_count", *distinct)


def event_frequency_stream(
    kinds: Mapping[str, DataFrame], width: str = "PT30M", watermark: str = WATERMARK
) -> DataFrame:
    """Events per window and kind of log, over the union of the streams."""
    tagged = [df.select("event_ts", F.lit(kind).alias("log_type")) for kind, df in kinds.items()]
    rows = reduce(DataFrame.unionByName, tagged).withWatermark("event_ts", watermark)
    counts = rows.groupBy(F.window("event_ts", period_to_interval(width)).alias("window"), "log_type")
    return counts.agg(F.count("*").alias("event_count")).select(
        F.col("window.start").alias("half_hour_bucket"), "log_type", "event_count"
    )


def bucket_pair_counts_stream(
    syslog: DataFrame, json: DataFrame, width: int = MINUTE, watermark: str = WATERMARK
) -> DataFrame:
    """Co-occurring pairs per window and pair of classes: two windowed counts, joined on the window.

    Add up the stored rows with ``operators.correlate.total_pairs`` for totals over all windows.
    """

    def counts(df, classes, name):
        keys = [F.col(column).alias(alias) for column, alias in classes.items()]
        window = F.window("event_ts", PREFIX_WINDOW[width]).alias("window")
        return df.withWatermark("event_ts", watermark).groupBy(window, *keys).agg(F.count("*").alias(name))

    left = counts(syslog, SYSLOG_CLASS, "syslog_rows")
    right = counts(json, JSON_CLASS, "json_rows")
    pairs = F.col("syslog_rows") * F.col("json_rows")
    return left.join(right, "window").select(
        window_label(width).alias("bucket"), *CORRELATED, pairs.alias("pairs")
    )

"""Order and limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def ranked(df: DataFrame, order: list[str | Column], limit: int | None = None, offset: int = 0) -> DataFrame:
    """The first ``limit`` rows in ``order``.

    With a limit Spark keeps a bounded heap per partition (TakeOrderedAndProject) and never sorts
    the whole input. With no limit the rows come back unordered, because a global sort only pays
    where the reader needs it. Give a total order, so that equal queries give equal rows.
    """
    if limit is None:
        return df
    df = df.orderBy(*order)
    return (df.offset(offset) if offset else df).limit(limit)


def page(df: DataFrame, order: list[str | Column], number: int, length: int) -> DataFrame:
    """Page ``number`` (from 0) of a sorted result."""
    return ranked(df, order, limit=length, offset=number * length)

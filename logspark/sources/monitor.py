"""A look at the newest record of every topic."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from logspark.schemas import TOPICS

NEWEST = ("timestamp", "partition", "offset")


def latest_per_topic(
    records: DataFrame, topics: Iterable[str] | None = tuple(TOPICS.values()), order: Sequence[str] = NEWEST
) -> DataFrame:
    """The newest record of each of the given topics, over all its partitions; with None, of every topic there is.

    Offsets of different partitions do not compare, so time comes first. Where the topics are few and known,
    each is filtered and reduced to one row per task: the filter prunes what holds other topics,
    and no records are sorted or shuffled. Where they are not known, each task sorts its records by topic
    and hands on one per topic.
    """
    if topics is None:
        newest = F.max_by(F.struct(*records.columns), F.struct(*order))
        return records.groupBy("topic").agg(newest.alias("_newest")).select("_newest.*")
    newest = [F.desc(c) for c in order]
    tops = [records.filter(F.col("topic") == topic).orderBy(*newest).limit(1) for topic in topics]
    return reduce(DataFrame.unionByName, tops)


def as_attribute_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each column of each row as an ``attribute, value`` row; bytes as hex, structs as JSON.

    ``keep`` columns stay beside them, to tell the records apart.
    """
    values = [f for f in df.schema if f.name not in keep]
    text = []
    for field in values:
        column = F.col(field.name)
        if isinstance(field.dataType, T.BinaryType):
            column = F.lower(F.hex(column))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            column = F.to_json(column)
        text.append(column.cast("string").alias(field.name))
    return df.select(*keep, *text).unpivot(list(keep), [f.name for f in values], "attribute", "value")

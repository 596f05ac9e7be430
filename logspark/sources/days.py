"""Log tables by day in versions: a day is replaced, and small parts are merged, while others read and write.

Every write goes to a folder of its own, with one folder per day below it; a version lists the (day, folder) parts
that belong to the table. A reader stays with the version it opened and sees each row of it once, whatever is
rewritten meanwhile. What a crash leaves before its version is in place belongs to no version.

Several writers may work at a time: who comes second to a version number takes the newer list and makes its own
change on that, without writing its rows again. Streams are known by name: a version also holds the newest batch of
each, so a batch that runs again is left out, also when its rows are merged with others already.

``fan`` parts of one level of a day become one of the next level, so a row is rewritten once per level and the parts of
a day follow the logarithm of the writes to it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logspark.functions.time import within
from logspark.operators.versions import VersionConflict, Versions
from logspark.sources.bronze import CHECK_PERIOD, MAX_ROWS_PER_FILE, clustered_writer

#: Fixed value: the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Parts of one level of a day that become one.
FAN = 8
#: Versions whose rows stay for readers that have opened them.
KEEP = 16
#: How often a change is made anew because another writer was first.
TRIES = 50


@dataclass(frozen=True)
class Part:
    """Rows of one day out of one write."""

    day: str
    write: str
    level: int = 0

    @property
    def folder(self) -> str:
        return f"data/write={self.write}/event_date={self.day}"


@dataclass(frozen=True)
class Content:
    """What a version lists: its parts, and the newest batch of each stream."""

    parts: list[Part] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)

    def has(self, stream: str | None, batch_id: int | None) -> bool:
        return stream in self.streams and batch_id <= self.streams[stream]


def _day_near(value, days: int) -> str | None:
    """The day of a text or date, moved by some days, as zones may differ; None where it shows none."""
    shown = re.match(r"\d{4}-\d\d-\d\d", str(value)) if isinstance(value, (str, date)) else None
    return str(date.fromisoformat(shown[0]) + timedelta(days)) if shown else None


@dataclass(frozen=True)
class DayTable(Versions):
    """A table at ``path`` with rows of ``schema``, which has ``event_date`` and ``event_ts``.

    Rows of one value of the ``by`` columns lie together within a day, as ``append_clustered`` puts them.
    """

    path: str
    schema: T.StructType
    by: tuple[str, ...] = ()
    fan: int = FAN
    keep: int = KEEP

    def content(self, spark: SparkSession, version: int | None = None) -> Content:
        """What belongs to a version, or to the newest one."""
        if version is None:
            version = max(self.versions(spark), default=0)
        if version == 0:
            return Content()
        listed = self._listed(spark, version)
        return Content([Part(**p) for p in listed["parts"]], listed["streams"])

    def _change(self, spark: SparkSession, change: Callable[[Content], Content | None]) -> bool:
        """Make the next version out of the newest, unless there is nothing to change."""
        for _ in range(TRIES):
            newest = max(self.versions(spark), default=0)
            content = change(self.content(spark, newest))
            if content is None:
                return False
            try:
                self._put_in_place(spark, newest + 1, {"parts": [vars(p) for p in content.parts], "streams": content.streams})
            except VersionConflict:
                continue
            self._clean(spark)
            return True
        raise VersionConflict(f"{self.path}: others were first {TRIES} times")

    def _clean(self, spark: SparkSession) -> None:
        """Remove versions before the last ``keep``, and the parts that only these list."""
        versions = self.versions(spark)
        gone: set[Part] = set()
        for version in versions[: -self.keep]:
            try:
                gone.update(self.content(spark, version).parts)
            except FileNotFoundError:  # Another writer removes it.
                continue
            self._remove(spark, f"_versions/v{version:012d}.json")
        if gone:
            for version in versions[-self.keep :]:
                gone.difference_update(self.content(spark, version).parts)
            self._discard(spark, gone)

    def _discard(self, spark: SparkSession, parts: Iterable[Part]) -> None:
        for part in parts:
            self._remove(spark, part.folder)
            if not any(n.startswith("event_date=") for n in self._names(spark, f"data/write={part.write}")):
                self._remove(spark, f"data/write={part.write}")

    def remove_leftovers(self, spark: SparkSession) -> int:
        """Remove what no version lists, as crashes leave it; not while anybody writes. Tells how many folders."""
        named = {p.write for v in self.versions(spark) for p in self.content(spark, v).parts}
        lost = [n for n in self._names(spark, "data") if n.startswith("write=") and n[6:] not in named]
        for name in lost:
            self._remove(spark, f"data/{name}")
        return len(lost)

    # --- writing -------------------------------------------------------------------------------

    def _store(self, rows: DataFrame, levels: dict[str, int] | None = None) -> list[Part]:
        """Rows as parts that no version lists yet."""
        spark, write = rows.sparkSession, uuid.uuid4().hex
        rows = rows.select(*self.schema.names)
        writer = clustered_writer(rows, self.by) if self.by else rows.hint("rebalance", "event_date").write
        writer.partitionBy("event_date").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(f"{self.path}/data/write={write}")
        days = [n.split("=", 1)[1] for n in self._names(spark, f"data/write={write}") if n.startswith("event_date=")]
        return [Part(day, write, (levels or {}).get(day, 0)) for day in sorted(days)]

    def append(self, rows: DataFrame, stream: str | None = None, batch_id: int | None = None) -> None:
        """Add rows. As a batch of a named stream they are added once, however often that runs."""
        spark = rows.sparkSession
        if self.content(spark).has(stream, batch_id):
            return
        new = self._store(rows)

        def added(content: Content) -> Content | None:
            if content.has(stream, batch_id):
                return None
            seen = {} if stream is None else {stream: batch_id}
            return Content([*content.parts, *new], content.streams | seen)

        if not self._change(spark, added):
            self._discard(spark, new)
        self.merge_levels(spark)

    def _swap(self, spark: SparkSession, old: list[Part], new: list[Part]) -> None:
        def swapped(content: Content) -> Content:
            if not set(old) <= set(content.parts):
                raise VersionConflict(f"{self.path}: parts have been replaced by another writer")
            return Content([*(p for p in content.parts if p not in old), *new], content.streams)

        try:
            self._change(spark, swapped)
        except VersionConflict:
            self._discard(spark, new)
            raise

    def replace_day(self, spark: SparkSession, day, rows: DataFrame | None = None) -> None:
        """Put ``rows`` in place of a day, or rewrite the day's own rows as few files; ``day`` None: rows without a day.

        What others add to the day meanwhile stays. If another writer has replaced or merged parts of the day,
        this is an error, and nothing is changed.
        """
        name = NO_DAY if day is None else str(day)
        old = [p for p in self.content(spark).parts if p.day == name]
        if rows is None:
            rows = self._rows(spark, old)
        else:
            rows = rows.withColumn("event_date", F.lit(None if day is None else str(day)).cast("date"))
        level = max((p.level for p in old), default=0)
        self._swap(spark, old, self._store(rows, {name: level}))

    def merge_levels(self, spark: SparkSession) -> None:
        """Merge parts until no day has ``fan`` of one level; all days that need it in one job."""
        while True:
            groups: dict[tuple[str, int], list[Part]] = {}
            for part in self.content(spark).parts:
                groups.setdefault((part.day, part.level), []).append(part)
            full = {day: (level, parts) for (day, level), parts in sorted(groups.items(), reverse=True) if len(parts) >= self.fan}
            if not full:
                return
            old = [p for _, parts in full.values() for p in parts]
            new = self._store(self._rows(spark, old), {day: level + 1 for day, (level, _) in full.items()})
            try:
                self._swap(spark, old, new)
            except VersionConflict:  # Another writer has merged or replaced some of them; what is left is seen next time.
                return

    def stream(self, rows: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        """Append a stream; it is known by its checkpoint."""
        name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]
        trigger = {"availableNow": True} if available_now else {"processingTime": CHECK_PERIOD}
        writer = rows.writeStream.foreachBatch(lambda batch, batch_id: self.append(batch, name, batch_id))
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    # --- reading -------------------------------------------------------------------------------

    def _rows(self, spark: SparkSession, parts: list[Part]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/{p.folder}" for p in parts]).select(*self.schema.names)

    def read(self, spark: SparkSession, since=None, until=None, version: int | None = None) -> DataFrame:
        """The rows of the newest or a named version, or those with event time in ``[since, until)``.

        Only folders of the days in question are listed.
        """
        low, high = _day_near(since, -1), _day_near(until, 1)
        parts = [p for p in self.content(spark, version).parts if (low or "") <= p.day and (not high or p.day <= high)]
        return within(self._rows(spark, parts), since, until)

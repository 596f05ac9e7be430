"""Topics kept as files, read by offsets: as a table, or as a stream that remembers how far it has come.

Records lie in Parquet files by topic and partition, sorted by offset, so footers tell which offsets a file holds. A stream
keeps one position per topic partition in its checkpoint. A micro-batch is the range of offsets from there to the newest
record; it is cut into tasks of ``recordsPerTask`` offsets, each of which reads the row groups of its range alone, batch by
batch. A partition that shows up later is read from its first record. Positions are offsets, not files: files
may be compacted while no stream runs, and gaps in the offsets do no harm.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from logspark.sources.logs import TOPIC_COLUMNS

RECORD_DDL = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"
RECORD_ARROW = pa.schema([
    ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")),
    ("key", pa.binary()), ("value", pa.binary()),
])
STORED = pa.schema([f for f in RECORD_ARROW if f.name not in ("topic", "partition")])
#: Offsets a task reads, unless the reader is told otherwise.
RECORDS_PER_TASK = 1_000_000
#: Row groups are small, and columns are read in pieces of so many bytes: a reader holds no row group as a whole.
GROUP_BYTES, READ_BYTES = 16 << 20, 1 << 20


def store_records(records: DataFrame, path: str) -> None:
    """Append topic records; a topic of one partition is still written by many tasks, each a range of offsets."""
    keys = ("topic", "partition", "offset")
    rows = records.select(*TOPIC_COLUMNS).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.write.mode("append").option("parquet.block.size", GROUP_BYTES).partitionBy("topic", "partition").parquet(path)


@dataclass(frozen=True)
class OffsetFile:
    """A file of one topic partition and the offsets ``[first, end)`` it may hold."""

    path: str
    partition: int
    first: int
    end: int


class OffsetIndex:
    """The files of a topic with their offsets; each footer is read once in the life of a reader."""

    def __init__(self, path: str, topic: str):
        self.uri, self.topic, self.known = path, topic, {}

    def files(self) -> list[OffsetFile]:
        system, base = _system(self.uri)
        listed = system.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        for info in listed:
            if info.path in self.known or not info.path.endswith(".parquet") or not info.size:
                continue
            named = dict(part.split("=", 1) for part in info.path[len(base) :].split("/") if "=" in part)
            if any(part.startswith(("_", ".")) for part in info.path[len(base) :].strip("/").split("/")) or unquote(named["topic"]) != self.topic:
                continue
            footer = pq.read_metadata(info.path, filesystem=system)
            at = footer.schema.to_arrow_schema().get_field_index("offset")
            groups = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups) if footer.row_group(i).num_rows]
            if groups:
                ends = min(g.min for g in groups), max(g.max for g in groups) + 1
                self.known[info.path] = OffsetFile(info.path, int(named["partition"]), *ends)
        there = {info.path for info in listed}
        return [f for path, f in self.known.items() if path in there]

    def ends(self) -> dict[str, tuple[int, int]]:
        """The first offset of each topic partition, and the one behind its newest record."""
        out: dict[str, tuple[int, int]] = {}
        for f in self.files():
            first, end = out.get(str(f.partition), (f.first, f.end))
            out[str(f.partition)] = min(first, f.first), max(end, f.end)
        return out


def _system(uri: str) -> tuple[pafs.FileSystem, str]:
    if ":/" in uri:
        system, path = pafs.FileSystem.from_uri(uri)
        return system, path.rstrip("/")
    return pafs.LocalFileSystem(), uri.rstrip("/")


class OffsetRange(InputPartition):
    """Offsets ``[low, high)`` of a topic partition and the files that may hold them."""

    def __init__(self, partition: int, low: int, high: int, files: list[str]):
        self.partition, self.low, self.high, self.files = partition, low, high, files


class _OffsetReader:
    def __init__(self, options: dict):
        self.index = OffsetIndex(options["path"], options["topic"])
        self.starting = options.get("startingOffsets", "earliest")
        self.per_task = int(options.get("recordsPerTask", RECORDS_PER_TASK))
        if self.starting not in ("earliest", "latest"):
            self.starting = {str(k): int(v) for k, v in json.loads(self.starting).items()}

    def start(self) -> dict[str, int]:
        """Where reading begins; a partition that a given start does not name is read from its first record."""
        ends = self.index.ends()
        if isinstance(self.starting, dict):
            return {p: self.starting.get(p, first) for p, (first, _) in ends.items()}
        return {p: first if self.starting == "earliest" else end for p, (first, end) in ends.items()}

    def newest(self) -> dict[str, int]:
        return {p: end for p, (_, end) in self.index.ends().items()}

    def ranges(self, start: dict, end: dict) -> list[OffsetRange]:
        out, files = [], self.index.files()
        for partition, stop in sorted(end.items()):
            own = [f for f in files if f.partition == int(partition)]
            low = start.get(partition, min((f.first for f in own), default=0))
            while low < stop:
                high = min(low + self.per_task, stop)
                held = [f.path for f in own if f.first < high and f.end > low]
                if held:
                    out.append(OffsetRange(int(partition), low, high, held))
                # Over a gap in one step.
                low = max(high, min((f.first for f in own if f.end > high), default=high))
        return out

    def read(self, part: OffsetRange | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what a table of no ranges is read with
            return
        system, _ = _system(self.index.uri)
        names = [f.name for f in STORED]
        for path in part.files:
            with system.open_input_file(path) as source:
                stored = pq.ParquetFile(source, buffer_size=READ_BYTES, pre_buffer=False, coerce_int96_timestamp_unit="us")
                at = stored.schema_arrow.get_field_index("offset")
                held = [stored.metadata.row_group(i).column(at).statistics for i in range(stored.num_row_groups)]
                groups = [i for i, s in enumerate(held) if s is None or not s.has_min_max or (s.min < part.high and s.max >= part.low)]
                for batch in stored.iter_batches(batch_size=8192, row_groups=groups, columns=names, use_threads=False) if groups else ():
                    offsets = batch.column("offset")
                    batch = batch.filter(pc.and_(pc.greater_equal(offsets, part.low), pc.less(offsets, part.high)))
                    if batch.num_rows:
                        fixed = [pa.array([self.index.topic] * batch.num_rows), pa.array([part.partition] * batch.num_rows, pa.int32())]
                        columns = [*fixed, *(batch.column(f.name).cast(f.type) for f in STORED)]
                        yield pa.RecordBatch.from_arrays(columns, schema=RECORD_ARROW)


class StoredTopicBatch(_OffsetReader, DataSourceReader):
    def partitions(self) -> list[OffsetRange]:
        return self.ranges(self.start(), self.newest())


class StoredTopicStream(_OffsetReader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self.start()

    def latestOffset(self) -> dict:
        return self.newest()

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        return self.ranges(start, end)


class StoredTopic(DataSource):
    """Options: ``path``, ``topic``, ``startingOffsets`` (earliest, latest, or JSON of partition to offset), ``recordsPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "stored_topic"

    def schema(self) -> str:
        return RECORD_DDL

    def reader(self, schema) -> StoredTopicBatch:
        return StoredTopicBatch(self.options)

    def streamReader(self, schema) -> StoredTopicStream:
        return StoredTopicStream(self.options)


def read_stored_topic(
    spark: SparkSession, path: str, topic: str, starting: str = "earliest", stream: bool = True, **options
) -> DataFrame:
    """The records of a stored topic from a start position on; a stream with a checkpoint goes on where it was.

    A session made by ``newSession`` can neither use a source registered in another one nor register that name again, so
    each session has a name of its own for it.
    """
    name = f"stored_topic_{spark._jsparkSession.sessionUUID().replace('-', '')}"
    spark.dataSource.register(type("StoredTopic", (StoredTopic,), {"name": classmethod(lambda cls: name)}))
    reader = (spark.readStream if stream else spark.read).format(name)
    return reader.options(path=path, topic=topic, startingOffsets=starting, **options).load()

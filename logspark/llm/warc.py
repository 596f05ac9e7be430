"""Legacy ARC archives turned into WARC archives, with repeated payloads as revisit records.

Archives are files of one gzip member per record, written by Spark's own writer, so they may lie in
any store that Spark reaches. ARC records are read by their declared lengths under the header
line that the archive's version block names; WARC identifiers, times, types and digests are made from them and
are the same on every run over the same archives: identifiers follow an archive's path below the folder and the record's
place in it, so archives of one name, or of none, stay apart. A task works on whole archives, one record at a time.

Where a header line or a declared length does not hold, that record is told as a problem, and reading goes on at the next
line that is a whole header; the bytes passed over are counted. A version block may be empty or name fields of its own.

Which record of equal payloads stays is decided on digests alone; then records meet these decisions by identifier,
in one and the same plan at all sizes.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.llm.common import only, saved
from logspark.session import scratch_dir

#: Payloads below so many bytes are never revisits.
LEAST_REVISIT = 100
#: Fields of a record's header line, by archive version.
ARC_FIELDS = {
    "1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    "2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
          "Filename", "Archive-length"],
}
#: HTTP field that carries a page's number through the archives.
NUMBER = b"X-Page-Id"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
START = datetime(2020, 1, 1)
#: Level of compression; members are written, shuffled and written again, so size weighs more than time.
LEVEL = 6
#: Bytes read at a time.
CHUNK = 1 << 16
#: Rows handed on at a time.
ROWS = 64
RECORD = (
    "archive string, place long, record_id string, url string, date string, number long, size long, digest string, "
    "problem string, unread long"
)


def member(record: bytes) -> bytes:
    """The record as a gzip member that ends in a zero byte, without that byte: the writer's separator adds it.

    A member ends in the top byte of its length, which is zero below 16 MB; a longer one is followed by an empty member.
    """
    packed = gzip.compress(record, LEVEL, mtime=0)
    return (packed if packed[-1] == 0 else packed + gzip.compress(b"", 1, mtime=0))[:-1]


def write_members(rows: DataFrame, path: str) -> None:
    """One archive per partition from the binary column ``member``."""
    rows.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Content of all files below a folder, with their path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString() + "/"
    inside = F.when(F.col("path").startswith(root), F.substr("path", F.lit(len(root) + 1))).otherwise(F.col("path"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(inside.alias("path"), "content")


def _stream(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _arc_url(url: str | None) -> str:
    """A header line is split at spaces, so white space and controls are written as percent escapes."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "") or "about:blank"


# --- writing ARC -------------------------------------------------------------------------------


def _arc_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    version, name = str(1 + part % 2), f"pages-{part:06d}.arc"
    about = f"{version} 0 origin\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    rows = [member(f"filedesc://{name} 0.0.0.0 {START:%Y%m%d%H%M%S} text/plain {'200 - - 0 ' + name + ' ' if version == '2' else ''}{len(about)}\n".encode() + about + b"\n")]
    offset = len(rows[0]) + 1
    for batch in batches:
        for number, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html"))):
            number, body = number.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass")
            head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(body)
            if number is not None:
                head += NUMBER + b": %d\r\n" % number
            block = head + b"\r\n" + body
            date = START + timedelta(seconds=(number or 0) % 300_000_000)
            extra = f"200 - - {offset} {name} " if version == "2" else ""
            line = f"{_arc_url(url.as_py())} 0.0.0.0 {date:%Y%m%d%H%M%S} text/html {extra}{len(block)}\n"
            rows.append(member(line.encode("utf-8", "surrogatepass") + block + b"\n"))
            offset += len(rows[-1]) + 1
            if len(rows) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["member"])
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["member"])


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as ARC archives, versions 1 and 2 in turn. Null html is an empty
    payload, a null URL is about:blank, a null page_id is left out."""
    write_members(only(pages, page_id="long", url="string", html="string").mapInArrow(_arc_members, "member binary"), path)


# --- reading ARC, writing WARC -----------------------------------------------------------------


class _Window:
    """A stream of bytes that can be looked at before it is passed. What a broken stream still gave is kept."""

    def __init__(self, stream: io.BufferedIOBase):
        self.stream, self.held, self.at, self.ended, self.broken = stream, bytearray(), 0, False, None

    def fill(self, size: int) -> int:
        """Have ``size`` bytes at hand, or all that are left; tell how many."""
        while len(self.held) - self.at < size and not self.ended:
            try:
                more = self.stream.read(min(max(CHUNK, size - len(self.held) + self.at), 256 * CHUNK))
            except (OSError, EOFError, zlib.error) as broken:
                more, self.broken = b"", f"unreadable: {broken}"
            self.held += more
            self.ended = not more
        return min(size, len(self.held) - self.at)

    def line(self, after: int = 0) -> bytes:
        """The line that starts ``after`` bytes from here, with its end; nothing at the end."""
        size = CHUNK
        while True:
            there = self.fill(after + size)
            end = self.held.find(b"\n", self.at + after, self.at + there) + 1
            if end or self.ended:
                return bytes(self.held[self.at + after : end or len(self.held)])
            size *= 2

    def take(self, size: int) -> bytes:
        self.fill(size)
        out = bytes(self.held[self.at : self.at + size])
        self.at += size
        if self.at > max(CHUNK, len(self.held) // 2):
            del self.held[: self.at]
            self.at = 0
        return out


def _header(line: bytes, count: int) -> list[str] | None:
    """The fields of a header line; the URL may hold spaces in old archives, so all others are counted from the right."""
    parts = line.rstrip(b"\r\n").decode("utf-8", "surrogateescape").rsplit(" ", count - 1)
    return parts if len(parts) == count and parts[-1].isascii() and parts[-1].isdigit() else None


def _starts_record(line: bytes, fields: list[str]) -> bool:
    """Whether a line found behind damage is a header: a URL, a date of digits, a length."""
    told = dict(zip(fields, _header(line, len(fields)) or ()))
    return ":" in told.get("URL", "") and told.get("Archive-date", "1999").isdigit()


def read_arc(content: bytes) -> Iterator[tuple[int, dict, bytes, str | None]]:
    """(place, header fields, block, problem) of each record after the version block.

    A record with a problem has no block; its field ``unread`` counts the bytes passed over, up to the next header line.
    """
    window, fields, place, name = _Window(_stream(content)), ARC_FIELDS["1"], 0, ""
    while line := window.line():
        if not line.strip():
            window.take(len(line))
            continue
        about = not place and line.startswith(b"filedesc:")
        # The version block's own line may have the fields of either version: its length comes last in both.
        parts = _header(line, 5 if about else len(fields))
        url, problem = line.rstrip(b"\r\n").decode("utf-8", "surrogateescape").split(" ")[0], None
        if parts is None:
            problem = f"no {len(fields)} fields with a length"
        else:
            size = min(int(parts[-1]), 2**62)
            if window.fill(len(line) + size) < len(line) + size:
                problem = "shorter than declared"
            elif window.fill(len(line) + size + 1) > len(line) + size and window.held[window.at + len(line) + size] not in b"\r\n" \
                    and not _starts_record(window.line(len(line) + size), fields) and not about:
                problem = "declared length ends within a record"
        window.take(len(line))
        if problem:
            unread = len(line)
            while (line := window.line()) and not _starts_record(line, fields):
                unread += len(window.take(len(line)))
            yield place, {"archive": name, "URL": url, "unread": unread}, b"", problem
        else:
            block = window.take(size)
            if about:
                lines = block.decode("utf-8", "surrogateescape").splitlines() or [""]
                named = lines[1].split(" ") if len(lines) > 1 else []
                fields = ARC_FIELDS.get(lines[0].split(" ")[0], named if "URL" in named else fields)
                name = url[len("filedesc://") :]
            else:
                yield place, dict(zip(fields, parts)) | {"archive": name}, block, None
        place += 1
    if window.broken:
        yield place, {"archive": name, "URL": "", "unread": 0}, b"", window.broken


def _http(block: bytes) -> tuple[bytes | None, bytes]:
    """Head with its empty line, and payload; no head where the block is no HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None, block
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, gap, body = block.partition(b"\n\n")
    return head + gap, body


def _field(head: bytes | None, name: bytes) -> int | None:
    for line in (head or b"").split(b"\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower() and value.strip().lstrip(b"-").isdigit():
            return int(value)
    return None


def _iso(date: str) -> str:
    """Fourteen digits as an ISO time; what an old crawler left out is the start of its year."""
    d = date if date.isdigit() else ""
    d += "19700101000000"[len(d) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc(kind: str, record_id: str, block: bytes, mime: str, **fields: str | None) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "Content-Type": mime} | {
        "WARC-" + k.replace("_", "-"): v for k, v in fields.items() if v is not None
    } | {"WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest(), "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def _parsed(path: str, content: bytes) -> Iterator[tuple[dict, dict, bytes | None, bytes]]:
    """Columns of RECORD, the ARC fields, HTTP head and payload of each record."""
    for place, arc, block, problem in read_arc(content):
        head, body = _http(block)
        record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{path}#{place}").urn
        yield {
            "archive": arc["archive"] or path, "place": place, "record_id": record_id,
            "url": arc["URL"].encode("utf-8", "surrogateescape").decode("utf-8", "replace"),
            "date": _iso(arc.get("Archive-date", "")), "number": _field(head, NUMBER), "size": len(body),
            "digest": hashlib.sha256(body).hexdigest(), "problem": problem,
            "unread": arc.get("unread"),
        }, arc, head, body


def _records(batches: Iterator[pa.RecordBatch], warc: bool) -> Iterator[pa.RecordBatch]:
    """Records of ARC archives; with ``warc`` also the response record, and the head that a revisit keeps."""
    names = [c.split()[0] for c in RECORD.split(", ")] + ["head", "member"] * warc
    kinds = {"place": pa.int64(), "number": pa.int64(), "size": pa.int64(), "unread": pa.int64(), "head": pa.binary(), "member": pa.binary()}
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            rows: list[dict] = []
            for row, arc, head, body in _parsed(path.as_py(), content.as_py()):
                if warc:
                    mime = "application/http; msgtype=response" if head is not None else arc.get("Content-type", "application/octet-stream")
                    kind = "response" if head is not None or row["url"].startswith("dns:") else "resource"
                    row["head"] = head
                    row["member"] = b"" if row["problem"] else member(_warc(
                        kind, row["record_id"], (head or b"") + body, mime, Target_URI=row["url"], Date=row["date"],
                        IP_Address=arc.get("IP-address"), Payload_Digest="sha256:" + row["digest"],
                    ))
                rows.append(row)
                if len(rows) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


def _warc_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An information record, then each record as a response or, where ``first`` is given, as a revisit."""
    part = TaskContext.get().partitionId()
    about = b"software: logspark\r\nformat: WARC File Format 1.1\r\n"
    rows = [member(_warc(
        "warcinfo", uuid.uuid5(uuid.NAMESPACE_URL, f"pages-{part:06d}.warc").urn, about, "application/warc-fields",
        Date=_iso(f"{START:%Y%m%d%H%M%S}"), Filename=f"pages-{part:06d}.warc.gz",
    ))]
    for batch in batches:
        for r in batch.to_pylist():
            if first := r["first"]:
                rows.append(member(_warc(
                    "revisit", r["record_id"], r["head"] or b"", "application/http; msgtype=response",
                    Target_URI=r["url"], Date=r["date"], Payload_Digest="sha256:" + r["digest"], Profile=PROFILE,
                    Refers_To=f"<{first['record_id']}>", Refers_To_Target_URI=first["url"], Refers_To_Date=first["date"],
                )))
            else:
                rows.append(r["member"])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["member"])
        rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["member"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write the ARC archives below ``arc_path`` as WARC archives; returns what could not be read.

    Of HTTP records with equal payloads of at least ``least`` bytes, the one with the smallest number stays
    a response and the others revisit it; ties and missing numbers go by date, archive and place.
    """
    read = archives(spark, arc_path)
    light = saved(read.mapInArrow(partial(_records, warc=False), RECORD), "arc-records")
    good = light.where("problem is null")
    order = F.struct(F.col("number").isNull().alias("none"), "number", "date", "archive", "place", "record_id", "url")
    firsts = (
        good.where(F.col("size") >= least).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first")
    )
    revisits = saved(
        good.where(F.col("size") >= least).join(firsts, "digest").where("record_id != first.record_id")
        .select("record_id", F.struct("first.record_id", "first.url", "first.date").alias("first")), "revisits",
    )
    whole = read.mapInArrow(partial(_records, warc=True), RECORD + ", head binary, member binary").where("problem is null")
    write_members(
        whole.join(revisits.hint("merge"), "record_id", "left").select("record_id", "url", "date", "digest", "head", "first", F.when(F.col("first").isNull(), F.col("member")).alias("member"))
        .mapInArrow(_warc_members, "member binary"), warc_path,
    )
    return light.where("problem is not null").select("archive", "place", "url", "problem", "unread")


# --- reading WARC ------------------------------------------------------------------------------

WARC_RECORD = (
    "record_id string, record_type string, url string, date string, number long, payload_bytes long, "
    "payload_digest string, refers_id string, intact boolean"
)


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record."""
    stream = _stream(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[key.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def _warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in WARC_RECORD.split(", ")]
    kinds = {"number": pa.int64(), "payload_bytes": pa.int64(), "intact": pa.bool_()}
    for batch in batches:
        for content in batch.column("content"):
            out: list[tuple] = []
            for fields, block in read_warc(content.as_py()):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                head, body = _http(block)
                told = fields["warc-payload-digest"].removeprefix("sha256:")
                digest = told if kind == "revisit" else hashlib.sha256(body).hexdigest()
                size = _field(head, b"Content-Length") if kind == "revisit" else len(body)
                whole = fields["warc-block-digest"] == "sha256:" + hashlib.sha256(block).hexdigest() and digest == told
                out.append((
                    fields["warc-record-id"].strip("<>"), kind, fields["warc-target-uri"], fields["warc-date"], _field(head, NUMBER),
                    size, digest, fields.get("warc-refers-to", "").strip("<>") or None, whole,
                ))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds.get(n, pa.string())) for i, n in enumerate(names)], names=names)


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC archives; ``intact`` tells whether the digests hold."""
    return archives(spark, path).mapInArrow(_warc_records, WARC_RECORD)


def archived_pages(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages through ARC and WARC archives in the shared folder and back: one row per page.

    Repeated rows are records of their own: the first stays a response, if large enough the others
    revisit it. Of equal payloads, rows without page_id come after all others. An empty table gives none.
    """
    spark = pages.sparkSession
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, arc)
    if lost := convert(spark, arc, warc, least).count():
        raise ValueError(f"{lost} records of the archives below {arc} could not be read")
    read = saved(warc_records(spark, warc), "warc-records")
    responses = read.where("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("number").alias("refers_to"))
    revisits = read.where("record_type = 'revisit'").join(responses, "refers_id", "left")
    others = read.where("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return others.unionByName(revisits).select(
        F.col("number").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
        "record_id", "url", "date", "intact",
    )

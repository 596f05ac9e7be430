"""Registry-framed Avro values: five header bytes, then an Avro record.

Where Spark's Avro module is on the class path its functions do the work in the JVM. Without it,
small helpers on Arrow batches cover the types log records use: record, string, int and long.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.avro.functions import from_avro, to_avro
from pyspark.sql.pandas.types import to_arrow_type

from logspark.schemas import avro_type

# The frame is one zero byte and a four-byte big-endian schema id.
HEADER_BYTES = 5


def has_avro_module(spark: SparkSession) -> bool:
    """Whether Spark's Avro module is on the class path."""
    try:
        spark.range(0).select(from_avro(F.lit(b""), '"string"')).schema
    except AnalysisException:
        return False
    return True


def decode_avro(df: DataFrame, schema: T.StructType, value_col: str = "value", into: str = "record") -> DataFrame:
    """Add ``into``: the decoded record, or null if the bytes do not hold one."""
    if has_avro_module(df.sparkSession):
        body = F.expr(f"substring({value_col}, {HEADER_BYTES + 1})")
        decoded = df.withColumn("_record", from_avro(body, _schema_text(schema), {"mode": "PERMISSIVE"}))
        # Every field is required, so a record of nulls, as a permissive decoder gives, is no record.
        whole = F.col("_record")[schema.names[0]].isNotNull()
        return decoded.withColumn(into, F.when(whole, F.col("_record"))).drop("_record")
    return df.withColumn(into, _decoder(schema)(F.col(value_col)))


def encode_avro(record: Column, schema: T.StructType, schema_id: int, spark: SparkSession) -> Column:
    """Framed Avro bytes of a struct column."""
    header = F.lit(bytearray(b"\0" + schema_id.to_bytes(4, "big")))
    if has_avro_module(spark):
        return F.concat(header, to_avro(record, _schema_text(schema)))
    return F.concat(header, _encoder(schema)(record))


def _schema_text(schema: T.StructType) -> str:
    return json.dumps(avro_type(schema, "Record"))


# The helpers below work on whole Arrow batches, field by field, with one cursor per row. They are
# marked as not deterministic, or a filter on their result, moved below the projection, would call
# them twice per row.

LONGEST_NUMBER = 10


def _decoder(schema: T.StructType):
    def read_numbers(data, at, end, valid):
        """Zigzag numbers at the cursors; rows whose bytes end early become invalid."""
        value = np.zeros(len(at), np.uint64)
        reading = valid.copy()
        for i in range(LONGEST_NUMBER):
            valid &= ~(reading & (at >= end))
            reading &= valid
            byte = np.where(reading, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint64)
            value |= (byte & np.uint64(0x7F)) << np.uint64(7 * i)
            at += reading
            reading &= byte >= 0x80
            if not reading.any():
                break
        valid &= ~reading
        return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)

    def texts(data, at, length, valid):
        """Strings cut out of the data; rows that are no UTF-8 become invalid."""
        offsets = np.concatenate(([0], np.cumsum(length)))
        picked = data[np.repeat(at - offsets[:-1], length) + np.arange(offsets[-1])]
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(picked))])
        try:
            return column.cast(pa.string())
        except pa.ArrowInvalid:
            decoded = []
            for i, raw in enumerate(column.to_pylist()):
                try:
                    decoded.append(raw.decode())
                except UnicodeDecodeError:
                    valid[i] = False
                    decoded.append(None)
            return pa.array(decoded, pa.string())

    def read(data, at, end, valid, data_type):
        if isinstance(data_type, T.StructType):
            columns = [read(data, at, end, valid, f.dataType) for f in data_type]
            return pa.StructArray.from_arrays(columns, fields=list(to_arrow_type(data_type)))
        number = read_numbers(data, at, end, valid)
        if isinstance(data_type, T.StringType):
            valid &= (number >= 0) & (number <= end - at)
            length = np.where(valid, number, 0)
            text = texts(data, at, length, valid)
            at += length
            return text
        if isinstance(data_type, T.IntegerType):
            valid &= (number >= -(2**31)) & (number < 2**31)
            number = np.where(valid, number, 0).astype(np.int32)
        return pa.array(number)

    @F.arrow_udf(schema)
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            raw = values.cast(pa.large_binary())
            present = raw.is_valid().to_numpy(zero_copy_only=False)
            raw = raw.fill_null(b"")
            offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            data = np.concatenate((np.frombuffer(raw.buffers()[2] or b"", np.uint8), np.zeros(1, np.uint8)))
            start, end = offsets[:-1], offsets[1:]
            valid = present & (end - start >= HEADER_BYTES) & (data[np.minimum(start, len(data) - 1)] == 0)
            at = start + HEADER_BYTES
            record = read(data, at, end, valid, schema)
            valid &= at == end
            yield pc.if_else(pa.array(valid), record, pa.scalar(None, record.type))

    return decode.asNondeterministic()


def _encoder(schema: T.StructType):
    def numbers(values):
        """Zigzag bytes: a (rows x 10) table and how many bytes of each row count."""
        rest = ((values << 1) ^ (values >> 63)).astype(np.uint64)
        table = np.zeros((len(values), LONGEST_NUMBER), np.uint8)
        length = np.ones(len(values), np.int64)
        for i in range(LONGEST_NUMBER):
            table[:, i] = rest & np.uint64(0x7F)
            rest >>= np.uint64(7)
            more = rest > 0
            table[more, i] |= 0x80
            length += more
        return table, length

    def parts(column, data_type):
        """The encoded pieces of a column: flat bytes, and the length per row."""
        if isinstance(data_type, T.StructType):
            return [piece for i, f in enumerate(data_type) for piece in parts(column.field(i), f.dataType)]
        if column.null_count:
            raise ValueError("null in a required field")
        if not isinstance(data_type, T.StringType):
            table, length = numbers(column.cast(pa.int64()).to_numpy(zero_copy_only=False))
            return [(table[np.arange(LONGEST_NUMBER) < length[:, None]], length)]
        text = column.cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        table, length = numbers(np.diff(offsets))
        return [(table[np.arange(LONGEST_NUMBER) < length[:, None]], length), (data, np.diff(offsets))]

    @F.arrow_udf(T.BinaryType())
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for records in batches:
            pieces = parts(records, schema)
            offsets = np.concatenate(([0], np.cumsum(sum(length for _, length in pieces))))
            out = np.empty(offsets[-1], np.uint8)
            at = offsets[:-1].copy()
            for data, length in pieces:
                ends = np.cumsum(length)
                out[np.repeat(at - (ends - length), length) + np.arange(len(data))] = data
                at += length
            encoded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(records), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
            yield encoded.cast(pa.binary())

    return encode.asNondeterministic()

"""Schemas, decoding, ingestion, quarantine, publishing, monitoring, generators."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logspark.fixtures import load_logs
from logspark.schemas import KINDS, LOG_DDL, TOPIC_RECORD_DDL, TOPICS, avro_schema, log_schema
from logspark.session import scratch_dir
from logspark.sources import synth
from logspark.sources.avro import decode_avro, encode_avro
from logspark.sources.bronze import append_bronze, read_bronze, replace_day, write_bronze
from logspark.sources.ingest import ingest, project_dimensions, reject_outside, with_event_ts
from logspark.sources.logs import log_table, read_log_stream, topic_options
from logspark.sources.monitor import as_attribute_rows, latest_per_topic
from logspark.sources.publish import log_value, publish, publish_stream, topic_rows
from logspark.sources.quarantine import BadRecordPolicy, POLICIES, quarantine, saved_sample
from logspark.sources.synth import flat_logs, numbered_ids, synth_logs, synth_topup


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- schemas and codec ---

def test_avro_schema_text(spark):
    schema = json.loads(avro_schema("cef"))
    assert schema["name"] == "CefLogRecord"
    fields = {f["name"]: f["type"] for f in schema["fields"]}
    assert fields["severity"] == "string" and fields["event_time"] == "long"
    assert fields["extension"]["name"] == "Extension"
    assert [f["type"] for f in fields["extension"]["fields"]] == ["string", "string", "int", "int", "string", "string"]


@pytest.mark.parametrize("kind", KINDS)
def test_encode_then_decode(spark, sf_small, kind):
    logs = getattr(load_logs(spark, sf_small), kind).select(*log_schema(kind).names)
    raw = logs.select(log_value(logs, kind).alias("value"))
    assert rows_of(decode_avro(raw, log_schema(kind)).select("record.*")) == rows_of(logs)


def test_known_bytes(spark):
    """Zigzag numbers and length-prefixed UTF-8 behind five header bytes."""
    ddl = "name string, n int, big long"
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    body = bytes([0, 0, 0, 0, 1]) + bytes([6]) + "é!".encode() + bytes([1]) + bytes([0x80, 0x02])
    raw = spark.createDataFrame([(bytearray(body),)], "value binary")
    assert decode_avro(raw, schema).select("record.*").first().asDict() == {"name": "é!", "n": -1, "big": 128}


@pytest.mark.parametrize(
    "value",
    [None, b"", b"\0\0\0\0", b"\1\0\0\0\1\2a\0\0", b"\0\0\0\0\1\2", b"\0\0\0\0\1\2a\0\0\0", b"\0\0\0\0\1\3a\0\0",
     b"\0\0\0\0\1\2\xff\0\0", b"\0\0\0\0\1" + b"\xff" * 12, b"\0\0\0\0\1\2a\xfe\xff\xff\xff\x7f\0",
     b"\0\0\0\0\1" + b"\xfe" + b"\xff" * 8 + b"\1"],
)
def test_bytes_that_hold_no_record(spark, value):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("name string, n int, big long")
    raw = spark.createDataFrame([(None if value is None else bytearray(value),)], "value binary")
    assert decode_avro(raw, schema).first().record is None


def test_codec_over_a_mixed_batch(spark):
    """Good and bad values, edge numbers and empty texts side by side in one batch."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("name string, inner struct<a: int, b: string>, big long")
    rows = [
        ("", (0, "é" * 100), 2**63 - 1), ("x" * 300, (2**31 - 1, ""), -(2**63)), ("a", (-(2**31), "b"), 0),
        ("ok", (-1, "z"), -300),
    ]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    raw = df.select("name", encode_avro(F.struct(*schema.names), schema, 7, spark).alias("value"))
    assert bytes(raw.first().value)[:5] == b"\0\0\0\0\7"
    cut = raw.withColumn("value", F.when(F.col("name") == "a", F.expr("substring(value, 1, length(value) - 1)"))
                         .when(F.col("name") == "ok", F.lit(None)).otherwise(F.col("value")))
    got = decode_avro(raw, schema).unionByName(decode_avro(cut, schema)).select("name", "record").collect()
    assert [tuple(r.record) if r.record else None for r in got] == [*rows, rows[0], rows[1], None, None]


def test_a_missing_value_is_not_encoded(spark):
    from pyspark.errors import PythonException
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("name string")
    df = spark.createDataFrame([(None,)], schema)
    with pytest.raises(PythonException, match="null in a required field"):
        df.select(encode_avro(F.struct("name"), schema, 1, spark)).collect()


# --- reading ---

def test_topic_options():
    got = topic_options("cef", "h:1", "latest", minPartitions="64", **{"kafka.security.protocol": "SASL_SSL"})
    assert got == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "SECURITY_LOGS_CEF", "startingOffsets": "latest",
        "minPartitions": "64", "kafka.security.protocol": "SASL_SSL",
    }
    assert topic_options("json", "h:1")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        topic_options("json", "h:1", "yesterday")


def test_file_stream_has_the_declared_schema(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([], LOG_DDL["json"]).write.parquet(path)
    stream = read_log_stream(spark, "json", "parquet", path)
    assert stream.isStreaming and stream.schema == log_schema("json")


def test_scratch_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(shared) and two.startswith(shared) and one != two


# --- ingestion ---

def test_ingested_shape(spark, sf_small):
    logs = load_logs(spark, sf_small)
    syslog = ingest(logs.syslog, "syslog")
    assert dict(syslog.dtypes)["priority"] == "bigint" and dict(syslog.dtypes)["event_ts"] == "timestamp"
    assert "event_time" not in syslog.columns
    assert syslog.agg(F.sum("count")).first()[0] == logs.syslog.count() == syslog.count()
    assert dict(project_dimensions(with_event_ts(logs.cef), "cef").dtypes)["extension"].startswith("struct<src:string")


def test_nothing_is_rejected_unless_asked(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS event_ts FROM range(-48, 49)")
    now = "2024-01-01 00:00:00"
    assert reject_outside(df, now=now).count() == 97
    assert reject_outside(df, late="P1D", now=now).count() == 24 + 49
    assert reject_outside(df, early="PT2H", now=now).count() == 48 + 3


def test_bronze_is_partitioned_by_day_and_a_range_prunes_days(spark, sf_small, tmp_path):
    path = str(tmp_path / "bronze")
    logs = ingest(load_logs(spark, sf_small).json, "json")
    append_bronze(logs, path)
    append_bronze(logs.limit(0), path)
    table = read_bronze(spark, path, "2024-01-10 06:00:00", "2024-01-12 00:00:00")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan
    want = logs.filter("event_ts >= '2024-01-10 06:00:00' and event_ts < '2024-01-12'")
    assert table.count() == want.count() > 0
    assert log_table(spark, path).count() == logs.count()
    days = [p for p in (tmp_path / "bronze").iterdir() if p.name.startswith("event_date=")]
    assert len(days) == logs.select("event_date").distinct().count()
    assert all(len(list(day.glob("part=*/*.parquet"))) == 1 for day in days)
    again = logs.filter("event_date = '2024-01-10'")
    append_bronze(again, path, part="late")
    append_bronze(again, path, part="late")  # a second attempt
    assert read_bronze(spark, path).count() == logs.count() + again.count()
    replace_day(spark, path, "2024-01-10", again)
    replace_day(spark, path, "2024-01-10")
    assert sorted(map(tuple, read_bronze(spark, path).select("log_id").collect())) == sorted(map(tuple, logs.select("log_id").collect()))
    assert len(list((tmp_path / "bronze" / "event_date=2024-01-10").glob("part=*/*.parquet"))) == 1


def test_bronze_stream_goes_on_where_it_stopped(spark, sf_small, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "cp"))
    logs = load_logs(spark, sf_small).json.select(*log_schema("json").names)
    early, late = logs.filter("log_id < '000000500'"), logs.filter("log_id >= '000000500'")

    def run():
        stream = ingest(read_log_stream(spark, "json", "parquet", source), "json")
        write_bronze(stream, path, checkpoint, available_now=True).awaitTermination()
        return read_bronze(spark, path).count()

    # The newer half comes first: nothing is late for the stored table.
    late.write.parquet(source)
    assert run() == late.count()
    early.write.mode("append").parquet(source)
    assert run() == logs.count()
    assert run() == logs.count()


# --- quarantine ---

def raw_records(spark, sf_dir, broken):
    logs = load_logs(spark, sf_dir).json
    value = F.when(F.col("offset") < broken, F.encode(F.lit("junk"), "utf-8")).otherwise(F.col("value"))
    rows = topic_rows(logs, "json", "log_id").withColumn("offset", F.col("key").cast("string").cast("long"))
    shaped = rows.withColumns({
        "value": value, "partition": F.lit(0), "timestamp": F.current_timestamp(),
    })
    return shaped.select("topic", "partition", "offset", "timestamp", "key", "value")


def run_quarantine(spark, tmp_path, raw, policy=None, name="q"):
    source = str(tmp_path / f"{name}-in")
    raw.write.mode("append").parquet(source)
    stream = spark.readStream.schema(TOPIC_RECORD_DDL).parquet(source)
    good, bad, checkpoint = (str(tmp_path / f"{name}-{n}") for n in ("good", "bad", "cp"))
    quarantine(stream, "json", good, bad, checkpoint, policy, available_now=True).awaitTermination()
    return spark.read.parquet(good), spark.read.parquet(bad)


def test_bad_records_are_set_aside_as_hex(spark, sf_small, tmp_path):
    good, bad = run_quarantine(spark, tmp_path, raw_records(spark, sf_small, broken=7))
    assert (good.count(), bad.count()) == (993, 7)
    assert {r.raw_hex for r in bad.collect()} == {b"junk".hex().upper()}
    assert sorted(r.offset for r in saved_sample(bad, BadRecordPolicy(1000, keep=3)).collect()) == [0, 1, 2]


def test_no_bad_records(spark, sf_small, tmp_path):
    source = raw_records(spark, sf_small, broken=0)
    good_path = tmp_path / "none-good"
    source.write.parquet(str(tmp_path / "none-in"))
    stream = spark.readStream.schema(TOPIC_RECORD_DDL).parquet(str(tmp_path / "none-in"))
    quarantine(stream, "json", str(good_path), str(tmp_path / "none-bad"), str(tmp_path / "none-cp"),
               available_now=True).awaitTermination()
    assert spark.read.parquet(str(good_path)).count() == 1000


def test_too_many_bad_records_stop_the_job(spark, sf_small, tmp_path):
    with pytest.raises(StreamingQueryException, match="7 bad json records, limit 6, among them .*/0/0, .*/0/1, .*/0/2"):
        run_quarantine(spark, tmp_path, raw_records(spark, sf_small, broken=7), BadRecordPolicy(6, 3), "over")
    assert spark.read.parquet(str(tmp_path / "over-bad")).count() == 7
    assert spark.read.parquet(str(tmp_path / "over-bad-sample")).count() == 3


def test_limits_per_kind():
    assert POLICIES["json"] == BadRecordPolicy(1000, 100)
    assert POLICIES["cef"] == POLICIES["syslog"] == BadRecordPolicy(2000, 200)


# --- publishing and monitoring ---

def test_publish_to_folders_and_read_back(spark, sf_small, tmp_path):
    logs = load_logs(spark, sf_small)
    path = str(tmp_path / "topics")
    for kind, key in (("json", "log_id"), ("syslog", "process_id")):
        publish(topic_rows(getattr(logs, kind), kind, key), path=path)
    back = spark.read.parquet(path)
    counts = {r.topic: r["count"] for r in back.groupBy("topic").count().collect()}
    assert counts == {TOPICS["json"]: 1000, TOPICS["syslog"]: 500}
    decoded = decode_avro(back.filter(F.col("topic") == TOPICS["json"]), log_schema("json")).select("record.*")
    assert rows_of(decoded) == rows_of(logs.json.select(*decoded.columns))


def test_publish_a_stream(spark, sf_small, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "topics")
    load_logs(spark, sf_small).syslog.write.parquet(source)
    stream = read_log_stream(spark, "syslog", "parquet", source)
    query = publish_stream(topic_rows(stream, "syslog", "process_id"), str(tmp_path / "cp"), path=path)
    query.processAllAvailable()
    query.stop()
    back = decode_avro(spark.read.parquet(path), log_schema("syslog"))
    assert rows_of(back.select("record.*")) == rows_of(spark.read.parquet(source).select(*log_schema("syslog").names))


def test_newest_record_over_all_partitions(spark):
    rows = [("a", 0, 9, 1.0, "old"), ("a", 1, 2, 5.0, "new"), ("a", 1, 1, 5.0, "before"), ("b", 0, 0, 0.0, "only")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp double, value string")
    assert {(r.topic, r.value) for r in latest_per_topic(df, ["a", "b", "none"]).collect()} == {("a", "new"), ("b", "only")}
    assert {(r.topic, r.value) for r in latest_per_topic(df, None).collect()} == {("a", "new"), ("b", "only")}
    assert latest_per_topic(df, None).columns == df.columns and latest_per_topic(df.limit(0), None).count() == 0


def test_attribute_rows_with_bytes_and_structs(spark):
    df = spark.sql("SELECT 't' AS topic, 7L AS offset, X'00FF' AS value, named_struct('a', 1) AS s, cast(null as int) AS n")
    assert rows_of(as_attribute_rows(df, keep=["topic"])) == sorted([
        ("t", "offset", "7"), ("t", "value", "00ff"), ("t", "s", '{"a":1}'), ("t", "n", None)], key=str)


# --- generators ---

def test_generated_logs(spark):
    logs = synth_logs(numbered_ids(spark, 3000), seed=1)
    sizes = [getattr(logs, kind).count() for kind in KINDS]
    assert sum(sizes) == 3000 and min(sizes) > 800
    assert [getattr(logs, kind).schema.simpleString() for kind in KINDS] == [
        log_schema(kind).simpleString() for kind in KINDS]
    json = logs.json
    assert json.filter("source_ip = destination_ip").count() == 0
    assert json.select("source_ip").distinct().count() == json.select("destination_ip").distinct().count() == 50
    assert {r[0] for r in json.select("username").distinct().collect()} == set(synth.USERNAMES)
    assert json.filter("length(log_id) = 9 and details = concat('Security event details for log ', log_id)").count() == sizes[0]
    span = logs.cef.selectExpr("min(cast(severity as int))", "max(cast(severity as int))", "min(extension.spt)",
                               "max(extension.dpt)").first()
    assert tuple(span)[:2] == (1, 10) and span[2] >= 1024 and span[3] <= 1023
    assert logs.syslog.filter("message rlike '^Security event [0-9]{9} occurred from [0-9.]+ to [0-9.]+$'").count() == sizes[1]


def test_generated_logs_repeat_by_seed(spark):
    ids = numbered_ids(spark, 200)
    one, again, other = (rows_of(flat_logs(synth_logs(i, seed))) for i, seed in (
        (ids, 5), (ids.repartition(7), 5), (ids, 6)))
    assert one == again != other


def test_topup(spark):
    logs = synth_topup(numbered_ids(spark, 10), seed=3)
    assert [getattr(logs, kind).count() for kind in KINDS] == [10, 10, 10]
    assert logs.json.filter("log_id = '000000003' and details = 'Security event details for log 3'").count() == 1
    assert logs.syslog.filter("message = 'Security event 3 occurred'").count() == 1
    many = synth_topup(numbered_ids(spark, 500), seed=3).json
    assert {r[0] for r in many.select("username").distinct().collect()} == set(synth.TOPUP_USERNAMES)
    assert many.select("source_ip").distinct().count() > 490


def test_ids_beyond_nine_digits_stay_whole(spark):
    ids = spark.range(12_345_678_901, 12_345_678_902).withColumn("event_time", F.lit(0).cast("long"))
    assert synth_topup(ids).json.first().log_id == "12345678901"

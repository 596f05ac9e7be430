"""Streams fed file by file: parity with the batch forms, late rows, restarts."""

import random
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logspark.fixtures import seed_users
from logspark.operators.keyed import KeyedTable
from logspark.functions.time import time_prefix
from logspark.operators.activity import activity
from logspark.operators.pattern import login_pattern, suspicious_logins
from logspark.schemas import FAILED_LOGIN_ATTEMPTS_DDL
from logspark.streaming import replay as replays
from logspark.streaming.batches import late_keys, repaired_matches, suspicious_logins_batches
from logspark.streaming.pattern import suspicious_logins_stream
from logspark.streaming.running import fold_entries, running_totals, store_entries
from logspark.streaming.sinks import BatchTable, LoginTables, append_stream, login_messages_stream, upsert_stream
from logspark.streaming.windows import activity_stream, distinct_stream
from test_pattern import logs


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


START = 1_704_067_200_000


def minute(n):
    return START + n * 60_000


def timed(df):
    """One row per minute, so that runs cross slots."""
    return df.withColumn("event_time", START + (F.col("event_time") - 1000) * 60_000).withColumn(
        "event_ts", F.timestamp_millis("event_time"))


class Feed:
    """A folder that is read as a stream; each ``run`` takes in what is new and stops."""

    def __init__(self, spark, tmp_path, schema):
        self.spark, self.source, self.checkpoint = spark, str(tmp_path / "in"), str(tmp_path / "cp")
        self.schema = schema

    def put(self, df):
        df.coalesce(1).write.mode("append").parquet(self.source)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.source)


def closing(spark, schema):
    """A row in the far future, of a user of its own."""
    row = {"log_id": "z", "username": "mark", "status": "success", "event_type": "login"}
    df = spark.createDataFrame([tuple(row.get(f.name) for f in schema if f.name not in ("event_ts", "event_time"))],
                               ", ".join(f"{f.name} string" for f in schema if f.name not in ("event_ts", "event_time")))
    return df.withColumn("event_time", F.lit(10**13)).withColumn("event_ts", F.timestamp_millis("event_time"))


@pytest.mark.parametrize("form", ["keyed, 5 minutes", "keyed, 1 day", "batches"])
def test_pattern_over_several_runs(spark, few_partitions, tmp_path, form):
    rng = random.Random(3)
    texts = {user: "".join(rng.choices("WFAxn", weights=[12, 3, 1, 1, 1], k=60)) for user in ("a", "b")}
    texts["c"] = "W" * 59 + "F"
    everything = timed(logs(spark, texts))
    feed = Feed(spark, tmp_path, everything.schema)
    out = str(tmp_path / "out")

    def run():
        if form == "batches":
            suspicious_logins_batches(
                feed.stream(), str(tmp_path / "state"), feed.checkpoint, BatchTable(out).write,
                watermark="2 minutes", partitions=3,
            ).awaitTermination()
        else:
            stream = suspicious_logins_stream(feed.stream(), watermark="2 minutes", slot=form.split(", ")[1])
            append_stream(stream, out, feed.checkpoint).awaitTermination()

    for low, high in ((0, 25), (25, 60)):
        feed.put(everything.filter((F.col("event_time") >= minute(low)) & (F.col("event_time") < minute(high))))
        run()
    # Behind the watermark: would break the runs; the keyed form does not see them, the other sets them aside.
    feed.put(everything.filter(F.col("event_time") < minute(10)).withColumn("status", F.lit("success")))
    run()
    feed.put(closing(spark, everything.schema).select(*everything.columns))
    run()
    want = suspicious_logins(everything)
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert ("c", 59) in {(r.username, r.warning_count) for r in got.collect()}


def test_late_rows_are_counted_and_their_keys_repaired(spark, few_partitions, tmp_path):
    everything = timed(logs(spark, {"a": "WWWFWWWWWF", "b": "WWWWxWWWFx"}))
    in_time = timed(logs(spark, {"c": "WWWWWWWWWF"}))
    rows = everything.unionByName(in_time)
    feed = Feed(spark, tmp_path, rows.schema)
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    halves = F.col("event_time") >= minute(5)
    for part in (rows.filter(halves), everything.filter(~halves), in_time.filter(~halves).withColumn("event_ts", F.lit(None).cast("timestamp")).limit(1),
                 closing(spark, rows.schema).select(*rows.columns)):
        feed.put(part)
        suspicious_logins_batches(
            feed.stream(), state, feed.checkpoint, BatchTable(out).write, watermark="1 minute", partitions=2
        ).awaitTermination()
    late = late_keys(spark, state, ["username"])
    assert {(r.username, r.late_rows) for r in late.collect()} == {("a", 5), ("b", 5), ("c", 1)}
    want = suspicious_logins(rows)
    found = spark.read.parquet(out).drop("batch_id")
    assert found.count() != want.count()
    got = repaired_matches(found, late, rows, **login_pattern())
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_totals_bucket_by_the_text_and_count_late_rows(spark, tmp_path):
    """The text and the event time of a row come from two clocks and may fall into two buckets."""
    df = timed(logs(spark, {"a": "WWWF"})).withColumn("timestamp", F.lit("2024-01-01T00:00:59.999900+00:00"))
    feed, path = Feed(spark, tmp_path, df.schema), str(tmp_path / "out")
    for part in (df.filter("status = 'failure'"), df.filter("status != 'failure'")):
        feed.put(part)
        rows = feed.stream().withColumn("time_window", time_prefix("timestamp"))
        store_entries(rows, path, feed.checkpoint, ["time_window", "status"], {"users": "username"}).awaitTermination()
    got = {tuple(r) for r in running_totals(spark, path, ["time_window", "status"], {"users": "username"}).collect()}
    want = activity(df, ["status"], {"users": "username"}, min_count=0)
    assert got == {tuple(r) for r in want.collect()} == {("2024-01-01T00:00", "warning", 3, 1), ("2024-01-01T00:00", "failure", 1, 1)}


def test_batch_of_the_pattern_can_run_again(spark, tmp_path):
    """What a failure leaves behind is replaced: the same batch after its state was written."""
    everything = timed(logs(spark, {"a": "WWWWFWWWF", "b": "W" * 9}))
    feed = Feed(spark, tmp_path, everything.schema)
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    failures = [True]

    def store(matches, batch_id):
        BatchTable(out).write(matches, batch_id)
        if batch_id == 1 and failures.pop():
            failures.append(False)
            raise RuntimeError("lost")

    def run():
        suspicious_logins_batches(feed.stream(), state, feed.checkpoint, store, watermark="1 minute").awaitTermination()

    feed.put(everything.filter(F.col("event_time") < minute(4)))
    run()
    feed.put(everything.filter(F.col("event_time") >= minute(4)))
    with pytest.raises(StreamingQueryException):
        run()
    run()
    feed.put(closing(spark, everything.schema).select(*everything.columns))
    run()
    got = spark.read.parquet(out)
    assert sorted((r.username, r.warning_count) for r in got.collect()) == [("a", 3), ("a", 4)]


def test_sketched_activity(spark, few_partitions, tmp_path):
    df = timed(logs(spark, {"a": "WWWFWWWF", "b": "xxxx"}))
    feed = Feed(spark, tmp_path, df.schema)
    feed.put(df)
    feed.put(closing(spark, df.schema).select(*df.columns))
    out = str(tmp_path / "out")
    stream = activity_stream(feed.stream(), ["status"], {"users": "username"}, width=13, min_count=1, exact=False)
    append_stream(stream, out, feed.checkpoint).awaitTermination()
    got = {(r.status, r.event_count, r.users) for r in spark.read.parquet(out).collect()}
    assert got == {("warning", 6, 1), ("failure", 2, 1), ("success", 4, 1)}


def test_running_totals_go_on_after_folding(spark, tmp_path):
    df = timed(logs(spark, {"a": "WWF", "b": "W"}))
    feed = Feed(spark, tmp_path, df.schema)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    by, distinct = ["status"], {"users": "username"}
    for n in range(3):
        feed.put(df)
        store_entries(feed.stream(), one if n < 2 else two, feed.checkpoint, by, distinct).awaitTermination()
        if n == 1:
            fold_entries(spark, one, two, by)
    got = {tuple(r) for r in running_totals(spark, two, by, distinct).collect()}
    assert got == {("warning", 9, 2), ("failure", 3, 1)}


def test_distinct_stream(spark, few_partitions, tmp_path):
    df = timed(logs(spark, {"a": "WWFF", "b": "W"}))
    feed = Feed(spark, tmp_path, df.schema)
    out = str(tmp_path / "out")
    for _ in range(2):
        feed.put(df)
        append_stream(distinct_stream(feed.stream(), ["username", "status"]), out, feed.checkpoint).awaitTermination()
    got = sorted((r.username, r.status) for r in spark.read.parquet(out).collect())
    assert got == [("a", "failure"), ("a", "warning"), ("b", "warning")]


def test_upsert_stream(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), FAILED_LOGIN_ATTEMPTS_DDL, ("username",), order=("failure_time",))
    feed = Feed(spark, tmp_path, table.schema)
    for batch in ([("a", 3, "t1", "i", "d"), ("a", 4, "t2", "i", "d")], [("b", 3, "t3", "i", "d")], [("a", 9, "t4", "i", "d")]):
        feed.put(spark.createDataFrame(batch, table.schema))
        upsert_stream(feed.stream(), table, feed.checkpoint).awaitTermination()
    assert {(r.username, r.warning_count) for r in table.read(spark).collect()} == {("a", 9), ("b", 3)}


def test_messages_replace_and_errors_are_kept(spark, tmp_path):
    from logspark.operators.infer import TextModel

    tables = LoginTables(str(tmp_path / "tables"))
    feed = Feed(spark, tmp_path, tables.attempts.schema)

    def client(prompt, texts):
        if any("poison" in t for t in texts):
            raise RuntimeError("refused")
        return [t.split(", ")[4] for t in texts]

    for batch in ([("root", 3, "t1", "i", "d"), ("guest", 5, "t1", "i", "poison"), ("nobody", 3, "t1", "i", "d")],
                  [("root", 8, "t2", "i", "d")]):
        feed.put(spark.createDataFrame(batch, feed.schema))
        login_messages_stream(feed.stream(), seed_users(spark), tables, feed.checkpoint, TextModel(client=client)
                              ).awaitTermination()
    assert {tuple(r) for r in tables.messages.read(spark).collect()} == {("root", "8")}
    assert tables.enriched.read(spark).count() == 3
    errors = tables.answers.read(spark).filter("error is not null").collect()
    assert [(r.username, r.error) for r in errors] == [("guest", "RuntimeError: refused")]


@pytest.mark.parametrize("feed", [replays.feed_in_any_order, replays.feed_in_time_order, replays.feed_with_late_rows])
def test_no_task_takes_a_whole_micro_batch(spark, sf_small, tmp_path, monkeypatch, feed):
    monkeypatch.setattr(replays, "ROWS_PER_FILE", 50)
    batches = []

    def sink(df, path, checkpoint):
        def store(batch, batch_id):
            batches.append([(r.at, r.event_time, r.log_id) for r in batch.select(F.input_file_name().alias("at"), "event_time", "log_id").collect()])
        return df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    replays.replay(spark, sf_small, lambda logs: logs.json, str(tmp_path / "feed"), sink, feed)
    assert len(batches) == replays.BATCHES
    assert sorted(int(r[2]) for b in batches for r in b) == list(range(1000))
    for batch in batches:
        assert max(Counter(r[0] for r in batch).values()) <= 100
    if feed is replays.feed_in_time_order:
        spans = [(min(r[1] for r in b), max(r[1] for r in b)) for b in batches]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_keyed_pattern_hands_python_state_one_row_per_user(spark, few_partitions, tmp_path):
    everything = timed(logs(spark, {user: "WWWWFxWWWF" * 6 for user in ("a", "b", "c")}))
    feed, out = Feed(spark, tmp_path, everything.schema), str(tmp_path / "out")
    feed.put(everything)
    feed.put(closing(spark, everything.schema).select(*everything.columns))
    query = append_stream(suspicious_logins_stream(feed.stream(), slot="1 minute"), out, feed.checkpoint)
    query.awaitTermination()
    # 180 slots with a row each are held, but not in Python.
    keyed = [o for p in query.recentProgress for o in p.stateOperators if o.operatorName.startswith("transformWithState")]
    assert 0 < max(o.numRowsTotal for o in keyed) <= 4
    assert spark.read.parquet(out).count() == suspicious_logins(everything).count() == 36

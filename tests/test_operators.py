"""Operators on hand-made frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logspark.fixtures import seed_users
from logspark.functions.time import (
    DAY, HOUR, MINUTE, iso_text, last_period, period_micros, period_to_interval, time_floor, time_prefix,
)
from logspark.operators import activity as act, correlate as cor
from logspark.operators.enrich import enrich_users
from logspark.operators.feed import event_feed
from logspark.operators.infer import TextModel, ml_predict, register_predict
from logspark.operators.keyed import KeyedTable, append_into, materialize, upsert_latest
from logspark.operators.ranking import page, ranked
from logspark.operators.skew import hot_keys, join_splitting_hot_keys
from logspark.plans.charts import chart_query
from logspark.schemas import FAILED_LOGIN_ATTEMPTS_DDL, LOG_DDL


def ts(text):
    return datetime.fromisoformat(text)


# --- time ---

def test_periods():
    assert period_to_interval("PT30M") == "30 minutes"
    assert period_to_interval("P1DT2H") == "1 days 2 hours"
    assert period_to_interval("15 minutes") == "15 minutes"
    assert period_micros("PT1H") == 3_600_000_000
    with pytest.raises(ValueError):
        period_to_interval("P")


@pytest.mark.parametrize(
    "period, floor",
    [("PT1H", "2024-01-02 03:00:00"), ("PT30M", "2024-01-02 03:30:00"), ("P1D", "2024-01-02 00:00:00"),
     ("PT15S", "2024-01-02 03:45:45"), ("P1W", "2024-01-01 00:00:00"), ("P1M", "2024-01-01 00:00:00"),
     ("P3M", "2024-01-01 00:00:00"), ("P1Y", "2024-01-01 00:00:00")],
)
def test_time_floor(spark, period, floor):
    df = spark.createDataFrame([(ts("2024-01-02 03:45:59.123"),)], "t timestamp")
    assert df.select(time_floor("t", period)).first()[0] == ts(floor)


@pytest.mark.parametrize("period", ["P2M", "PT0S", "hour", "PT1X", ""])
def test_time_floor_rejects_what_is_no_fixed_period(spark, period):
    with pytest.raises(ValueError):
        time_floor("t", period)


def test_prefix_of_text_with_and_without_fraction(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.000001+00:00",), ("2024-01-02T03:04:05+00:00",)], "t string")
    assert {r[0] for r in df.select(time_prefix("t", MINUTE)).collect()} == {"2024-01-02T03:04"}
    assert {r[0] for r in df.select(time_prefix("t", HOUR)).collect()} == {"2024-01-02T03"}
    assert {r[0] for r in df.select(time_prefix("t", DAY)).collect()} == {"2024-01-02"}


def test_iso_text(spark):
    df = spark.createDataFrame([(ts("2024-01-02 03:04:05.6"),)], "t timestamp")
    assert df.select(iso_text(F.col("t"))).first()[0] == "2024-01-02T03:04:05.600000+00:00"


def test_range_keeps_its_start_and_drops_its_end(spark):
    times = ["2024-01-01 00:00:00", "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2023-12-31 23:59:59"]
    df = spark.createDataFrame([(ts(t),) for t in times], "t timestamp")
    kept = df.filter(last_period("t", "P1D", "2024-01-02 00:00:00")).collect()
    assert [r.t for r in kept] == [ts(times[0]), ts(times[1])]


def test_range_ends_now_by_default(spark):
    df = spark.range(1).select((F.current_timestamp() - F.expr("interval 1 hour")).alias("t"))
    assert df.filter(last_period("t", "P1D")).count() == 1


# --- activity ---

CEF_DDL = LOG_DDL["cef"]


def cef_row(name="n", severity="5", src="1.1.1.1", dst="2.2.2.2", msg="m", time=0):
    return ("0", "v", "p", "1", "s", name, severity, (src, dst, 1, 2, "TCP", msg), time)


def test_severity_that_is_no_number_is_not_high(spark):
    df = spark.createDataFrame(
        [cef_row("a", "7"), cef_row("b", "10"), cef_row("c", "abc"), cef_row("d", None), cef_row("e", "6")], CEF_DDL
    )
    assert [r.event_name for r in act.high_severity(df, limit=10).collect()] == ["b", "a"]


def test_incidents_by_status_or_word_and_case_matters(spark):
    ddl = LOG_DDL["json"]
    rows = [
        (str(i), f"t{i}", "login", status, "u", "a", "b", details, i)
        for i, (status, details) in enumerate(
            [("failure", "x"), ("success", "some malware here"), ("success", "Malware"), (None, "attack"),
             (None, None), ("success", "x")]
        )
    ]
    got = act.incidents(spark.createDataFrame(rows, ddl), limit=10).collect()
    assert [r.log_id for r in got] == ["3", "1", "0"]


def test_activity_counts_and_threshold(spark):
    rows = [("2024-01-01T00:00:01", "a", u) for u in ("x", "y", None)] + [("2024-01-01T00:01:01", "a", "x")]
    df = spark.createDataFrame(rows, "timestamp string, kind string, username string")
    got = act.activity(df, ["kind"], {"users": "username"}, min_count=1).collect()
    assert [tuple(r) for r in got] == [("2024-01-01T00:00", "a", 3, 2)]


def test_failure_sequences_keep_both_ends(spark):
    rows = [("ip", "login", "failure", ts(t)) for t in ("2024-01-01", "2024-02-01", "2024-02-01 00:00:01")]
    df = spark.createDataFrame(rows, "source_ip string, event_type string, status string, event_ts timestamp")
    got = act.failure_sequences(df, "2024-01-01", "2024-02-01").collect()
    assert [tuple(r) for r in got] == [("ip", 2, "login|failure")]


def test_frequency_counts_each_kind(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:29:59"),), (ts("2024-01-01 00:30:00"),)], "event_ts timestamp")
    got = act.event_frequency({"A": df, "B": df.limit(1)}, limit=10).collect()
    assert [(r.half_hour_bucket.minute, r.log_type, r.event_count) for r in got] == [
        (0, "A", 1), (0, "B", 1), (30, "A", 1)]


def test_pages(spark):
    df = spark.range(60)
    assert [r.id for r in page(df, ["id"], number=1, length=25).collect()] == list(range(25, 50))
    assert ranked(df, ["id"], None).count() == 60


# --- correlation ---

def correlation_logs(spark, n=400):
    ids = spark.range(n)
    # A third of all rows fall into one bucket and come from one address.
    hot = F.col("id") % 3 == 0
    time = F.when(hot, F.lit(1_704_067_200)).otherwise(1_704_067_200 + F.col("id") * 97)
    base = ids.select(
        "id", F.timestamp_seconds(time).alias("event_ts"),
        F.when(hot, "10.0.0.1").otherwise(F.concat(F.lit("10.0.0."), F.col("id") % 5)).alias("ip"),
    ).withColumn("timestamp", iso_text(F.col("event_ts")))
    json = base.select(
        "event_ts", "timestamp", F.col("ip").alias("source_ip"),
        F.when(F.col("id") % 2 == 0, "login").otherwise("logout").alias("event_type"),
        F.when(F.col("id") % 5 == 0, "failure").otherwise("success").alias("status"),
    )
    syslog = base.select(
        "event_ts", "timestamp", F.concat(F.lit("h"), F.col("id") % 4).alias("hostname"), F.lit("app").alias("application"),
        (F.col("id") % 3).cast("int").alias("priority"),
    )
    cef = base.select(
        "event_ts", F.lit("n").alias("name"), (F.col("id") % 11).cast("string").alias("severity"),
        F.struct(F.col("ip").alias("src")).alias("extension"),
    )
    return json, syslog, cef


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("width", [MINUTE, HOUR, DAY])
def test_counting_before_the_join_equals_the_plain_join(spark, width):
    json, syslog, _ = correlation_logs(spark)
    s, j = syslog.alias("s"), json.alias("j")
    plain = (
        s.join(j, time_prefix(F.col("s.timestamp"), width) == time_prefix(F.col("j.timestamp"), width))
        .groupBy("hostname", "application", "priority", "event_type", "status").count().filter("count > 1")
    )
    assert rows_of(cor.correlate_by_prefix(syslog, json, width, limit=None)) == rows_of(plain)


def plain_pairs(json, cef):
    hour = lambda c: F.date_trunc("hour", c)
    return json.alias("j").join(
        cef.alias("c"),
        (F.col("j.source_ip") == F.col("c.extension.src")) & (hour("j.event_ts") == hour("c.event_ts")),
    ).filter((F.col("status") == "failure") | (F.col("severity").try_cast("int") >= 7)).select(
        hour("j.event_ts").alias("time_window"), F.col("j.event_ts").alias("event_time"), "source_ip", "event_type",
        "status", F.col("name").alias("cef_event"), "severity",
    )


def test_pair_counts_equal_the_plain_join(spark):
    json, _, cef = correlation_logs(spark)
    plain = plain_pairs(json, cef)
    want = plain.groupBy(*cor.PAIR).count()
    assert rows_of(cor.ip_pair_counts(json, cef)) == rows_of(want)
    total = cor.ip_pair_counts(json, cef).agg(F.sum("pair_count")).first()[0]
    assert total == plain.count()


@pytest.mark.parametrize("limit", [1, 50, 100_000])
def test_incident_rows_repeat_as_often_as_they_occur(spark, limit):
    json, _, cef = correlation_logs(spark)
    want = sorted(map(tuple, plain_pairs(json, cef).drop("event_time").collect()))[:limit]
    assert list(map(tuple, cor.ip_incidents(json, cef, limit=limit).collect())) == want


def test_recent_pairs_are_distinct_and_within_the_range(spark):
    json, _, cef = correlation_logs(spark)
    since, until = "2024-01-01 00:10:00", "2024-01-01 02:30:00"
    want = plain_pairs(json, cef).filter(F.col("event_time") >= since).filter(F.col("event_time") < until).distinct()
    got = cor.recent_ip_pairs(json, cef, since, until, limit=None)
    assert rows_of(got) == rows_of(want)
    assert want.count() > 0


def test_hot_keys_are_few_and_split(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    assert rows_of(hot_keys(df, ["k"], share=10, min_rows=50)) == [("hot", 4)]
    assert hot_keys(df, ["k"]).count() == 0
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4)], "k string, v int")
    got = join_splitting_hot_keys(df, few, ["k"], ["id"], share=10, min_rows=50)
    assert rows_of(got) == rows_of(df.join(few, "k"))
    assert got.count() == 2001


def test_recent_pairs_with_a_split_address(spark):
    json, _, cef = correlation_logs(spark)
    since, until = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    json = json.withColumn("event_ts", F.timestamp_millis(F.unix_millis("event_ts") + F.rand(1).cast("long")))
    want = cor.recent_ip_pairs(json, cef, since, until, limit=None)
    assert rows_of(cor.recent_ip_pairs(json, cef, since, until, limit=None, share=5, min_rows=10)) == rows_of(want)


# --- feed and charts ---

def test_feed_has_nulls_where_a_kind_lacks_a_column(spark):
    json, syslog, cef = correlation_logs(spark, 3)
    got = event_feed(json, syslog, cef).groupBy("log_type").agg(
        F.count("*").alias("n"), F.count("source_ip").alias("ip"), F.count("status").alias("s"),
        F.count("cef_event").alias("e"),
    )
    assert rows_of(got) == [("CEF", 3, 3, 0, 3), ("JSON", 3, 3, 3, 0), ("Syslog", 3, 0, 0, 0)]


def test_chart_order_and_row_limit(spark):
    df = spark.createDataFrame([(g, ts("2024-01-01")) for g in "aabbbc"], "g string, event_time timestamp")
    metrics = {"n": F.count("event_time")}
    assert rows_of(chart_query(df, metrics, ["g"], row_limit=1)) == [("b", 3)]
    assert rows_of(chart_query(df, metrics, ["g"], row_limit=1, order_desc=False)) == [("c", 1)]
    grained = chart_query(df, metrics, ["g"], grain="PT1H", time_range="P7D", as_of="2024-01-01 00:00:01")
    assert grained.columns == ["time_bucket", "g", "n"] and grained.count() == 3
    assert chart_query(df, metrics, ["g"], time_range="P7D", as_of="2024-01-01").count() == 0


# --- keyed tables ---

def test_latest_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None), (None, 1, "z")], "k string, t int, v string")
    assert {tuple(r) for r in upsert_latest(df, "k", ["t"]).collect()} == {("a", 3, "y"), ("b", 2, None), (None, 1, "z")}


def test_upsert_table_replays_and_later_batches_win(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k string, t int, v string", ("k",), order=("t",)).create(spark)
    assert table.read(spark).count() == 0
    table.write(spark.createDataFrame([("a", 5, "old"), ("a", 6, "newer"), ("b", 1, "b")], table.schema), 0)
    changed = spark.createDataFrame([("a", 2, "later batch")], table.schema)
    table.write(changed, 1)
    table.write(changed, 1)
    assert rows_of(table.read(spark)) == [("a", 2, "later batch"), ("b", 1, "b")]
    assert table.changes(spark).count() == 3


def test_folded_table_goes_on(spark, tmp_path):
    for mode, want in (("upsert", [("a", 3), ("b", 2)]), ("append", [("a", 1), ("a", 3), ("b", 2)])):
        table = KeyedTable(str(tmp_path / mode), "k string, v int", ("k",), mode)
        table.write(spark.createDataFrame([("a", 1)], table.schema), 0)
        table.write(spark.createDataFrame([("b", 2)], table.schema), 1)
        folded = table.fold(spark, str(tmp_path / f"{mode}-folded"))
        folded.write(spark.createDataFrame([("a", 3)], table.schema), 2)
        assert rows_of(folded.read(spark)) == want


def test_append_table_keeps_every_row(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k string", ("k",), mode="append")
    table.write(spark.createDataFrame([("a",), ("a",)], "k string"), 0)
    table.write(spark.createDataFrame([("a",)], "k string"), 1)
    assert table.read(spark).count() == 3


def test_table_declaration_is_checked(tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(str(tmp_path), "k string", ("nope",))
    with pytest.raises(ValueError):
        KeyedTable(str(tmp_path), "k string", ("k",), mode="other")


def test_table_from_a_query_and_inserts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert materialize(spark.createDataFrame([("a", "b")], "username string, big_string string"), path).count() == 1
    append_into(spark.createDataFrame([("c", "d")], "username string, big_string string"), path)
    assert rows_of(spark.read.parquet(path)) == [("a", "b"), ("c", "d")]


# --- enrichment and model ---

def attempts(spark, *rows):
    return spark.createDataFrame(rows, FAILED_LOGIN_ATTEMPTS_DDL)


def test_enrichment_golden_row(spark):
    df = attempts(spark, ("system", 3, "2024-11-08T16:41:31.486178+00:00", "148.44.172.236",
                          "Security event details for log 000601150"))
    assert rows_of(enrich_users(df, seed_users(spark))) == [(
        "system",
        "French, Sophie, Dubois, sophie.dubois@email.com, 3, 2024-11-08T16:41:31.486178+00:00, 148.44.172.236, "
        "Security event details for log 000601150",
    )]


def test_enrichment_edge_cases(spark):
    df = attempts(
        spark, ("root", 3, "t", "ip", "it's"), ("root", 3, "t", "ip", "it's"), ("stranger", 3, "t", "ip", "d"),
        ("guest", 3, "t", "ip", None),
    )
    got = {r.username: r.big_string for r in enrich_users(df, seed_users(spark)).collect()}
    assert set(got) == {"root", "guest"}
    assert got["root"].endswith(", it's") and got["guest"] is None
    assert enrich_users(df, seed_users(spark)).count() == 2


def failing_model(**options):
    def client(prompt, texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("refused")
        return [t.upper() for t in texts]

    return TextModel(client=client, **options)


def test_model_errors_stay_with_their_row(spark):
    df = spark.createDataFrame([("a", "one"), ("b", "bad"), ("c", None), ("d", "two")], "k string, text string").coalesce(1)
    model = failing_model(attempts=2, batch_size=10)
    got = {r.k: (r.answer, r.error) for r in ml_predict(df, model, "text", "answer").collect()}
    assert got == {"a": ("ONE", None), "b": (None, "RuntimeError: refused"), "c": (None, None), "d": ("TWO", None)}


def test_model_is_called_in_batches(spark):
    sizes = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def client(prompt, texts):
        calls.add(1)
        sizes.add(len(texts))
        return texts

    df = spark.range(100).select(F.col("id").cast("string").alias("text")).coalesce(1)
    ml_predict(df, TextModel(client=client, batch_size=32), "text").collect()
    assert (calls.value, sizes.value) == (4, 100)


def test_model_as_table_function(spark):
    register_predict(spark, failing_model(), "predict_text")
    spark.createDataFrame([("a", "one"), ("b", "bad")], "k string, text string").createOrReplaceTempView("texts")
    got = spark.sql("SELECT k, user_mail, error FROM texts, LATERAL predict_text(text)")
    assert rows_of(got.fillna("")) == [("a", "ONE", ""), ("b", "", "RuntimeError: refused")]

"""Runs that end in a failure: hand-made cases, a regex as referee, keys cut into stretches."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from logspark.operators.pattern import LOGIN_MEASURES, match_run_then, suspicious_logins

# One letter per row: W a login warning, F a failed login, A a failed file access, x anything else,
# n a row without status.
ROWS = {
    "W": ("warning", "login"), "F": ("failure", "login"), "A": ("failure", "file_access"),
    "x": ("success", "login"), "n": (None, "login"),
}
DDL = (
    "log_id string, timestamp string, event_type string, status string, username string, source_ip string, "
    "details string, event_time long"
)


def logs(spark, texts, tie=False):
    """A log per letter; ``texts`` maps users to letters."""
    rows = []
    for user, text in texts.items():
        for i, letter in enumerate(text):
            status, kind = ROWS[letter]
            time = 1000 if tie else 1000 + i
            rows.append((f"{i:09}", f"t{i:06}", kind, status, user, f"ip{i}", f"it's {i}", time))
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, DDL)


def expected(text, scope):
    end = "[FA]" if scope == "any" else "F"
    return [(m.end() - m.start() - 1, f"t{m.end() - 1:06}") for m in re.finditer(f"W{{3,}}{end}", text)]


def found(df):
    out = {}
    for row in df.collect():
        out.setdefault(row.username, []).append((row.warning_count, row.failure_time))
    return {user: sorted(matches, key=lambda m: m[1]) for user, matches in out.items()}


@pytest.mark.parametrize(
    "text, any_count, same_count",
    [
        ("WWF", [], []),
        ("WWWF", [3], [3]),
        ("WWWWF", [4], [4]),
        ("WWxWF", [], []),
        ("WWWFWWWF", [3, 3], [3, 3]),
        ("WWWFF", [3], [3]),
        ("WWWA", [3], []),
        ("WWWAF", [3], []),
        ("WWnWF", [], []),
        ("WWWn", [], []),
        ("F", [], []),
        ("WWWW", [], []),
    ],
)
def test_cases(spark, text, any_count, same_count):
    df = logs(spark, {"u": text})
    for scope, counts in (("any", any_count), ("same_type", same_count)):
        got = found(suspicious_logins(df, scope)).get("u", [])
        assert [n for n, _ in got] == counts


def test_order_within_one_instant_follows_log_id(spark):
    df = logs(spark, {"u": "WWWF"}, tie=True)
    assert found(suspicious_logins(df)) == {"u": [(3, "t000003")]}


def test_order_by_record_time(spark):
    """The topic record came in another order than the events happened."""
    df = logs(spark, {"u": "WWFW"}).withColumn("record_time", F.when(F.col("event_time") == 1002, 9).otherwise(1))
    assert found(suspicious_logins(df)) == {}
    assert found(suspicious_logins(df, order_by=["record_time", "log_id"])) == {"u": [(3, "t000002")]}


def test_measures_come_from_the_last_row(spark):
    row = suspicious_logins(logs(spark, {"u": "xWWWWF"})).collect()[0]
    assert row.asDict() == {
        "username": "u", "warning_count": 4, "failure_time": "t000005", "failure_source_ip": "ip5",
        "failed_details": "it's 5",
    }


def run(df, partitions, **options):
    """With a fixed number of stretches, so that keys are cut."""
    from logspark.operators.pattern import login_end, login_run

    return match_run_then(
        df, ["username"], ["event_time", "log_id"], login_run(), login_end(), measures=LOGIN_MEASURES,
        count_as="warning_count", partitions=partitions, **options,
    )


@pytest.fixture
def no_merging(spark):
    """Keep small stretches apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_hot_key_is_cut_and_answers_stay(spark, no_merging, partitions):
    rng = random.Random(partitions)
    texts = {
        "hot": "".join(rng.choices("WFAxn", weights=[12, 3, 1, 1, 1], k=1500)),
        "cold": "".join(rng.choices("WFAxn", weights=[12, 3, 1, 1, 1], k=60)),
        "tiny": "WWWF",
        None: "WWWWF",
    }
    df = logs(spark, texts)
    want = {user: expected(text, "same_type") for user, text in texts.items()}
    assert found(run(df, partitions)) == {user: m for user, m in want.items() if m}


def test_run_longer_than_many_stretches(spark, no_merging):
    texts = {"hot": "x" + "W" * 900 + "F" + "W" * 2 + "F"}
    assert found(run(logs(spark, texts), 30)) == {"hot": [(900, "t000901")]}


def test_many_batches_in_one_stretch(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    try:
        texts = {"a": "WWWWWWWWWWWWFWWFWWWF", "b": "FWWWF", "c": "WWWWWWWWWWWWWWWWWWF"}
        want = {user: expected(text, "same_type") for user, text in texts.items()}
        assert found(run(logs(spark, texts), 1)) == want
    finally:
        spark.conf.set(name, before)


def test_one_user_is_spread_over_partitions(spark, no_merging):
    """No task gets more than its share of a user who holds nearly all rows."""
    df = logs(spark, {"hot": "W" * 4000, "cold": "WF"})
    placed = df.repartitionByRange(16, "username", "event_time", "log_id")
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000 / 4
    plan = run(df, 16)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_key" in plan
    assert "hashpartitioning(username" not in plan


def test_where_both_tests_hold_the_end_wins(spark):
    df = logs(spark, {"u": "WWWWF"})
    both = match_run_then(df, ["username"], ["event_time"], F.lit(True), F.col("status") == "failure")
    assert [r.run_length for r in both.collect()] == [4]


def test_several_partition_columns(spark):
    df = logs(spark, {"a": "WWWF", "b": "WWF"}).withColumn("site", F.lit(1))
    from logspark.operators.pattern import login_end, login_run

    out = match_run_then(df, ["site", "username"], ["event_time"], login_run(), login_end())
    assert [tuple(r) for r in out.collect()] == [(1, "a", 3)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["a", "b", "c"]), st.text("WWWFAxn", min_size=1, max_size=60), min_size=1))
def test_regex_agrees(spark, texts):
    df = logs(spark, texts)
    for scope in ("any", "same_type"):
        want = {user: expected(text, scope) for user, text in texts.items()}
        assert found(suspicious_logins(df, scope)) == {user: m for user, m in want.items() if m}

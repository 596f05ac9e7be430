"""What the physical plans look like on stored tables."""

import re

import pytest

import __spark_entry__ as contract
from logspark.fixtures import Logs, load_logs
from logspark.operators import activity as act, correlate as cor
from logspark.operators.feed import event_feed
from logspark.operators.pattern import suspicious_logins
from logspark.plans import analytics as an, charts
from logspark.sources.bronze import append_bronze, read_bronze
from logspark.sources.ingest import with_event_ts


@pytest.fixture(scope="module")
def stored(spark, sf_small, tmp_path_factory):
    """The three logs as day-partitioned tables."""
    path = str(tmp_path_factory.mktemp("stored"))
    logs = load_logs(spark, sf_small)
    for kind in ("json", "syslog", "cef"):
        append_bronze(with_event_ts(getattr(logs, kind)), f"{path}/{kind}")
    return Logs(*(read_bronze(spark, f"{path}/{kind}") for kind in ("json", "syslog", "cef")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(text):
    return re.findall(r"ReadSchema: (struct<.*>)", text)


def test_status_filter_reaches_the_scan(stored):
    text = plan(act.top_sources(stored.json, stored.json["status"] == "failure", limit=20))
    assert "EqualTo(status,failure)" in text


def test_only_used_nested_fields_are_read(stored):
    text = plan(an.cef_overview(stored))
    schema = read_schemas(text)[0]
    assert "extension:struct<src:string,dst:string>" in schema and "msg" not in schema and "version" not in schema


def test_top_k_never_sorts_everything(stored):
    for df in (act.high_severity(stored.cef, limit=100), act.incidents(stored.json, limit=100), an.json_activity(stored)):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_newest_records_are_neither_sorted_nor_shuffled(stored):
    text = plan(an.newest_records(stored, offset="event_time"))
    assert text.count("TakeOrderedAndProject(limit=1") == 3
    assert text.count("FileScan") == 3 and "hashpartitioning" not in text and "rangepartitioning" not in text


def test_frequency_counts_once(stored):
    text = plan(an.event_frequency(stored, limit=None))
    assert text.count("Exchange hashpartitioning") == 1
    assert all(s == "struct<event_ts:timestamp>" for s in read_schemas(text))


def test_correlation_counts_before_it_joins(stored):
    text = plan(cor.correlate_by_prefix(stored.syslog, stored.json, limit=50))
    join = text.index("Join")
    assert text[join:].count("partial_count") == 2


def test_time_range_reaches_both_scans(stored):
    df = cor.recent_ip_pairs(stored.json, stored.cef, "2024-01-10 06:30:00", "2024-01-11 06:30:00")
    text = plan(df)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) >= 2
    assert all("GreaterThanOrEqual(event_ts" in s and "LessThan(event_ts" in s for s in scans)
    assert all("(event_date" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_users_are_broadcast_only_by_size(spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        text = plan(an.enriched_failed_logins(spark, stored))
        joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
        assert joins and all("BuildRight" in line for line in joins)  # the users, not the attempts
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Broadcast" not in plan(an.enriched_failed_logins(spark, stored)).split("Initial")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pattern_reads_only_its_columns(stored):
    schema = read_schemas(plan(suspicious_logins(stored.json)))[0]
    assert "destination_ip" not in schema and "username" in schema


def test_charts_read_a_week(stored):
    feed = event_feed(stored.json, stored.syslog, stored.cef, since="2024-01-24", until="2024-01-31")
    text = plan(charts.top_sources_chart(feed, "2024-01-31 00:00:00"))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("GreaterThanOrEqual(event_ts" in s for s in scans)
    assert all("(event_date" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if not n.startswith("w")))
def test_no_query_pairs_rows_without_a_key(spark, sf_small, name):
    text = plan(contract.queries()[name](spark, sf_small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_stored_tables_give_the_same_answers(spark, sf_small, stored):
    logs = load_logs(spark, sf_small)
    for build in (an.json_activity, an.cef_overview, an.ip_incident_counts, an.failed_login_state, an.syslog_json_correlation):
        assert sorted(map(str, build(stored).collect())) == sorted(map(str, build(logs).collect()))


def test_entry_gives_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["username", "warning_count", "failure_time", "failure_source_ip", "failed_details"]
    assert df.count() == 9

"""Users who write SQL text: registered functions and tables."""

from datetime import datetime

import pytest

from logspark.fixtures import load_logs
from logspark.functions.sql import register_functions, register_tables
from logspark.operators.correlate import ip_pair_counts
from logspark.operators.feed import event_feed
from logspark.plans.charts import top_sources_chart, top_sources_page
from logspark.plans.datasets import register_datasets


@pytest.fixture
def sql(spark, sf_small):
    register_functions(spark)
    register_tables(load_logs(spark, sf_small), extension_as_text=True)
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    yield spark.sql
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "false")


@pytest.mark.parametrize(
    "period, floor",
    [("PT1H", "2024-01-02 03:00:00"), ("PT30M", "2024-01-02 03:30:00"), ("P1D", "2024-01-02 00:00:00"),
     ("PT1H30M", "2024-01-02 03:00:00"), ("P1W", "2024-01-01 00:00:00"), ("P1M", "2024-01-01 00:00:00"),
     ("P3M", "2024-01-01 00:00:00")],
)
def test_time_floor(sql, period, floor):
    got = sql(f"SELECT TIME_FLOOR(timestamp'2024-01-02 03:45:59.5', '{period}')").first()[0]
    assert got == datetime.fromisoformat(floor)


@pytest.mark.parametrize("period", ["P2M", "PT0S", "hour", "PT"])
def test_time_floor_rejects_what_is_no_period(sql, period):
    with pytest.raises(Exception, match="time_floor: no period"):
        sql(f"SELECT TIME_FLOOR(timestamp'2024-01-02 03:45:59.5', p) FROM VALUES ('{period}') AS t(p)").collect()


def test_pairs_as_text(spark, sf_small, sql):
    got = sql("""
        SELECT TIME_FLOOR(a."__time", 'PT1H') AS time_window, a.source_ip, a.event_type, a.status,
               b.name AS cef_event, b.severity, COUNT(*) AS pair_count
        FROM "SECURITY_LOGS_JSON" AS a
        JOIN "SECURITY_LOGS_CEF" AS b
          ON a.source_ip = JSON_VALUE(b.extension, '$.src')
         AND TIME_FLOOR(a."__time", 'PT1H') = TIME_FLOOR(b."__time", 'PT1H')
        WHERE a.status = 'failure' OR CAST(b.severity AS INTEGER) >= 7
        GROUP BY ALL
    """)
    logs = load_logs(spark, sf_small)
    want = ip_pair_counts(logs.json, logs.cef)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_functions_are_inlined(sql):
    plan = sql("""SELECT TIME_FLOOR("__time", 'PT30M') AS b, COUNT(*) FROM SECURITY_LOGS_SYSLOG GROUP BY 1""")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "1800000000" in text and "regexp_extract" not in text


def test_datasets(spark, sf_small):
    logs = load_logs(spark, sf_small)
    register_datasets(logs, width=13)
    assert spark.table("Correlated_Security_Events").count() == 213
    assert spark.table("Security_Event_Feed").count() == 2000
    assert spark.table("SECURITY_LOGS_CEF").count() == 500


def test_pages_of_top_sources(spark, sf_check):
    logs = load_logs(spark, sf_check)
    feed = event_feed(logs.json, logs.syslog, logs.cef)
    as_of = "2024-01-31 00:00:00"
    pages = [[tuple(r) for r in top_sources_page(feed, n, as_of).collect()] for n in range(4)]
    assert [len(p) for p in pages] == [25, 25, 1, 0]
    assert sum(pages, []) == [tuple(r) for r in top_sources_chart(feed, as_of).collect()]


def test_ordinals_and_struct_access(spark, sf_small):
    register_tables(load_logs(spark, sf_small))
    got = spark.sql("""
        SELECT name, extension['src'] AS src, COUNT(*) AS n FROM SECURITY_LOGS_CEF
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""")
    assert got.count() == 5

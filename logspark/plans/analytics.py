"""The named analytics, with the parameters they run with on the given tables.

Operators default to the parameters of live traffic (minute buckets and their thresholds). The
given tables hold few rows per minute, so these plans use day or hour buckets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.fixtures import Logs, seed_users
from logspark.functions.time import DAY, HOUR, period_interval, as_timestamp
from logspark.operators import activity as act, correlate as cor, pattern
from logspark.operators.enrich import enrich_users
from logspark.operators.infer import TextModel, ml_predict
from logspark.operators.keyed import upsert_latest
from logspark.schemas import TOPICS
from logspark.sources.monitor import latest_per_topic

JSON_DISTINCT = {
    "unique_users": "username", "unique_sources": "source_ip", "unique_destinations": "destination_ip",
}
SYSLOG_DISTINCT = {"unique_hosts": "hostname"}
FAILURE_DISTINCT = {"unique_event_types": "event_type", "unique_users": "username"}
CEF_CLASS = ["device_vendor", "device_product", "name", "severity"]
CEF_DISTINCT = {"unique_sources": "extension.src", "unique_destinations": "extension.dst"}


def json_activity(logs: Logs, limit: int | None = 100) -> DataFrame:
    return act.activity(logs.json, ["event_type", "status"], JSON_DISTINCT, DAY, min_count=10, limit=limit)


def syslog_activity(logs: Logs, limit: int | None = 100) -> DataFrame:
    return act.activity(logs.syslog, ["application", "priority"], SYSLOG_DISTINCT, DAY, min_count=1, limit=limit)


def cef_overview(logs: Logs, limit: int | None = 100) -> DataFrame:
    return act.activity(logs.cef, CEF_CLASS, CEF_DISTINCT, width=None, min_count=5, limit=limit)


def top_failure_sources(logs: Logs, limit: int | None = 20) -> DataFrame:
    return act.top_sources(logs.json, F.col("status") == "failure", distinct=FAILURE_DISTINCT, limit=limit)


def syslog_json_correlation(logs: Logs, limit: int | None = 50) -> DataFrame:
    return cor.correlate_by_prefix(logs.syslog, logs.json, width=HOUR, limit=limit)


def correlated_dataset(logs: Logs) -> DataFrame:
    """The correlation as a whole, sorted."""
    return syslog_json_correlation(logs, None).orderBy(F.desc("correlated_events"), *cor.CORRELATED)


def ip_correlation_recent(logs: Logs, as_of=None, limit: int | None = 10) -> DataFrame:
    until = as_timestamp(as_of)
    return cor.recent_ip_pairs(logs.json, logs.cef, until - period_interval("P1D"), until, limit=limit)


def ip_incident_counts(logs: Logs) -> DataFrame:
    """Incident pairs of all time, each with how often it occurs."""
    renamed = {"event_type": "json_event", "status": "json_status", "severity": "cef_severity"}
    return cor.ip_pair_counts(logs.json, logs.cef).withColumnsRenamed(renamed)


def event_frequency(logs: Logs, limit: int | None = 100) -> DataFrame:
    return act.event_frequency({"JSON": logs.json, "Syslog": logs.syslog, "CEF": logs.cef}, limit=limit)


def failure_sequences(logs: Logs, limit: int | None = None) -> DataFrame:
    return act.failure_sequences(logs.json, "2000-01-01", "3000-01-01", limit=limit)


def failed_login_state(logs: Logs) -> DataFrame:
    """The last suspicious login of every user."""
    matches = pattern.suspicious_logins(logs.json, keep=["log_id"])
    return upsert_latest(matches, "username", ["failure_time", "log_id"]).drop("log_id")


def enriched_failed_logins(spark: SparkSession, logs: Logs, every_match: bool = False) -> DataFrame:
    attempts = pattern.suspicious_logins(logs.json) if every_match else failed_login_state(logs)
    return enrich_users(attempts, seed_users(spark))


def generated_messages(spark: SparkSession, logs: Logs, model: TextModel | None = None) -> DataFrame:
    answers = ml_predict(enriched_failed_logins(spark, logs), model or TextModel(), "big_string", "email_message")
    return answers.select("username", "email_message")


def topic_records(logs: Logs, offset: str = "event_id") -> DataFrame:
    """All logs as records of their topics, with the text of each as its value and the ``offset`` column as its place."""
    parts = []
    for kind, text in (("json", "details"), ("syslog", "message"), ("cef", "extension.msg")):
        parts.append(getattr(logs, kind).select(
            F.lit(TOPICS[kind]).alias("topic"),
            F.lit(0).alias("partition"),
            F.col(offset).cast("long").alias("offset"),
            F.col("event_ts").alias("timestamp"),
            F.col(text).alias("value"),
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def newest_records(logs: Logs, topics: Iterable[str] | None = tuple(TOPICS.values()), offset: str = "event_id") -> DataFrame:
    return latest_per_topic(topic_records(logs, offset), topics)


def newest_json_log(logs: Logs) -> DataFrame:
    """The newest JSON log with all its columns: a bounded heap per task, no shuffle of rows."""
    return logs.json.orderBy(F.desc("event_time"), F.desc("log_id")).limit(1).drop("event_ts")

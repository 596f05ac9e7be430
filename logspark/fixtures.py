"""Log tables derived from a table of generic events.

Every event is a JSON log; events with an even id are also a syslog record, odd ones a CEF
record. The functions take and return DataFrames, batch or streaming.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.functions.text import zero_padded
from logspark.functions.time import event_timestamp, iso_text
from logspark.schemas import USER_DETAILS_DDL

# The user dimension and the domains of the derived logs.
USERS = [
    ("user1", "John", "Smith", "English", "john.smith@email.com"),
    ("user2", "Maria", "Garcia", "Spanish", "maria.garcia@email.com"),
    ("admin", "Hans", "Mueller", "German", "hans.mueller@email.com"),
    ("system", "Sophie", "Dubois", "French", "sophie.dubois@email.com"),
    ("root", "Anna", "Kowalski", "Polish", "anna.kowalski@email.com"),
    ("guest", "Marco", "Rossi", "Italian", "marco.rossi@email.com"),
    ("user3", "Lars", "Anderson", "Swedish", "lars.anderson@email.com"),
]
USERNAMES = ["admin", "user1", "user2", "user3", "system", "root", "guest", "nobody"]
VENDORS = ["Microsoft", "Cisco", "Symantec", "Palo Alto"]
KEYWORD_NOTES = {3: "unauthorized access", 7: "malware found", 11: "breach suspected", 13: "attack signature"}
NOTES = [KEYWORD_NOTES.get(i, "Security event details") for i in range(25)]


EVENTS_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@dataclass(frozen=True)
class Logs:
    json: DataFrame
    syslog: DataFrame
    cef: DataFrame


def seed_users(spark: SparkSession) -> DataFrame:
    """The user dimension as literal rows: a local relation, whose size the planner knows."""
    rows = ", ".join("(" + ", ".join(f"'{value}'" for value in row) + ")" for row in USERS)
    names = [part.split()[0] for part in USER_DETAILS_DDL.split(",")]
    return spark.sql(f"SELECT * FROM VALUES {rows} AS users({', '.join(names)})")


def _choose(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded_id() -> F.Column:
    return zero_padded(F.col("event_id"))


def prepare_events(events: DataFrame) -> DataFrame:
    """The columns all three derivations share. ``ts`` has no zone and is taken as UTC."""
    millis = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000")
    return events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("et"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        millis.alias("event_time"),
        iso_text(F.col("ts")).alias("timestamp"),
    ).withColumn("event_ts", event_timestamp())


def json_logs(prepared: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    k, et = F.col("k"), F.col("et")
    return prepared.select(
        _padded_id().alias("log_id"),
        "timestamp",
        F.when(k < 80, "login").when(k < 85, "logout").when(k < 90, "file_access")
        .when(k < 95, "network_access").otherwise("system_update").alias("event_type"),
        F.when(et == "error", "failure").when(et.isin("click", "view"), "warning")
        .otherwise("success").alias("status"),
        _choose(USERNAMES, F.col("user_id") % 8).alias("username"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 50).cast("string")).alias("source_ip"),
        F.concat(F.lit("192.168.0."), (k % 50).cast("string")).alias("destination_ip"),
        F.concat(_choose(NOTES, k % 25), F.lit(" for log "), _padded_id()).alias("details"),
        "event_time",
        "event_ts",
        *also,
    )


def syslog_logs(prepared: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return prepared.filter(F.col("event_id") % 2 == 0).select(
        F.col("k").alias("priority"),
        "timestamp",
        F.concat(F.lit("host-"), (1 + F.col("user_id") % 20).cast("string")).alias("hostname"),
        F.lit("security-app").alias("application"),
        (1000 + F.col("event_id") % 9000).cast("string").alias("process_id"),
        F.concat(F.lit("Security event "), _padded_id(), F.lit(" occurred")).alias("message"),
        "event_time",
        "event_ts",
        *also,
    )


def cef_logs(prepared: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    k, et = F.col("k"), F.col("et")
    return prepared.filter(F.col("event_id") % 2 == 1).select(
        F.lit("0").alias("version"),
        _choose(VENDORS, k % 4).alias("device_vendor"),
        F.when(F.col("event_id") % 4 == 1, "Windows").otherwise("ASA").alias("device_product"),
        F.lit("10.0").alias("device_version"),
        F.lit("4625").alias("signature_id"),
        F.when(et == "error", "Login Failure").when(et == "click", "Access Denied")
        .when(et == "view", "Malware Detected").otherwise("Traffic Allowed").alias("name"),
        (1 + k % 10).cast("string").alias("severity"),
        F.struct(
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 50).cast("string")).alias("src"),
            F.concat(F.lit("192.168.0."), (k % 50).cast("string")).alias("dst"),
            (1024 + k).alias("spt"),
            (1 + k).alias("dpt"),
            F.lit("TCP").alias("proto"),
            F.concat(F.lit("Security event "), _padded_id()).alias("msg"),
        ).alias("extension"),
        "event_time",
        "event_ts",
        *also,
    )


def derive_logs(events: DataFrame, also: Sequence[str] = ()) -> Logs:
    prepared = prepare_events(events)
    return Logs(*[logs(prepared, also) for logs in (json_logs, syslog_logs, cef_logs)])


def load_logs(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None, also: Sequence[str] = ()
) -> Logs:
    """Logs derived from a folder of tables, or those with event time in ``[since, until)``; ``also`` carries event columns.

    The range is on whole milliseconds and filters the stored time column, so the scan skips the
    row groups outside it.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return derive_logs(events, also)

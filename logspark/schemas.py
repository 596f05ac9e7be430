"""Declared schemas. Nothing in this library infers a schema."""

from __future__ import annotations

import json

from pyspark.sql import types as T

KINDS = ("json", "syslog", "cef")

# Topic names, record names and field lists.
TOPICS = {
    "json": "SECURITY_LOGS_JSON",
    "syslog": "SECURITY_LOGS_SYSLOG",
    "cef": "SECURITY_LOGS_CEF",
}
RECORD_NAMES = {"json": "JsonLogRecord", "syslog": "SyslogRecord", "cef": "CefLogRecord"}
LOG_DDL = {
    "json": (
        "log_id string, timestamp string, event_type string, status string, username string, "
        "source_ip string, destination_ip string, details string, event_time long"
    ),
    "syslog": (
        "priority int, timestamp string, hostname string, application string, "
        "process_id string, message string, event_time long"
    ),
    "cef": (
        "version string, device_vendor string, device_product string, device_version string, "
        "signature_id string, name string, severity string, "
        "extension struct<src: string, dst: string, spt: int, dpt: int, proto: string, msg: string>, "
        "event_time long"
    ),
}
USER_DETAILS_DDL = "username string, first_name string, last_name string, language string, mail string"
FAILED_LOGIN_ATTEMPTS_DDL = (
    "username string, warning_count long, failure_time string, failure_source_ip string, failed_details string"
)
ENRICHED_FAILED_LOGINS_DDL = "username string, big_string string"
GENERATED_MESSAGES_DDL = "username string, email_message string"

# A record as a topic delivers it.
TOPIC_RECORD_DDL = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def log_schema(kind: str) -> T.StructType:
    return schema_of(LOG_DDL[kind])


def avro_type(data_type: T.DataType, name: str):
    """The Avro type of a Spark type, for the types log records use."""
    if isinstance(data_type, T.StructType):
        fields = [{"name": f.name, "type": avro_type(f.dataType, f.name.capitalize())} for f in data_type]
        return {"type": "record", "name": name, "fields": fields}
    for spark_type, avro_name in ((T.StringType, "string"), (T.IntegerType, "int"), (T.LongType, "long")):
        if isinstance(data_type, spark_type):
            return avro_name
    raise TypeError(f"no Avro type for {data_type.simpleString()}")


def avro_schema(kind: str) -> str:
    """Avro schema text of a log kind; every field is required, as producers write it."""
    return json.dumps(avro_type(log_schema(kind), RECORD_NAMES[kind]))

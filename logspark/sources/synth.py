"""Synthetic logs as a Spark job: every row follows from its id and the seed.

Both generators take a DataFrame of ``id`` and ``event_time`` (epoch ms), so volume and clock are
the caller's; ``numbered_ids`` makes one of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.fixtures import Logs
from logspark.functions.picks import add_digests, address, address_pool, between, choice
from logspark.functions.text import zero_padded
from logspark.functions.time import event_timestamp, iso_text
from logspark.schemas import KINDS, log_schema

# The domains of generated logs.
POOL_SIZE = 50
EVENT_TYPES = ["login", "logout", "file_access", "network_access", "system_update"]
STATUSES = ["success", "failure", "warning"]
USERNAMES = ["admin", "user1", "user2", "system", "root", "guest"]
TOPUP_USERNAMES = ["admin", "user1", "user2", "user3", "system", "root", "guest"]
VENDORS = ["Microsoft", "Cisco", "Symantec", "Palo Alto"]
PRODUCTS = ["Windows", "ASA", "Endpoint Protection", "NGFW"]
DEVICE_VERSIONS = ["10.0", "9.8", "14.2", "8.1"]
SIGNATURES = ["4625", "106023", "8001", "13001"]
CEF_NAMES = ["Login Failure", "Access Denied", "Malware Detected", "Traffic Allowed"]
PROTOCOLS = ["TCP", "UDP", "ICMP"]

# Which number of a row each pick uses.
SLOT = {
    "kind": 0, "source": 1, "destination": 2, "event_type": 3, "status": 4, "username": 5, "priority": 6,
    "host": 7, "process": 8, "vendor": 9, "product": 10, "version": 11, "signature": 12, "name": 13,
    "severity": 14, "spt": 15, "dpt": 16, "proto": 17, "source_octets": 20, "destination_octets": 24,
}
DIGESTS = 7
FLAT_COLUMNS = ("src", "dst", "actor", "action", "level", "detail", "text")


def numbered_ids(spark: SparkSession, n: int, start_ms: int = 1_704_067_200_000, step_ms: int = 1) -> DataFrame:
    return spark.range(n).withColumn("event_time", F.lit(start_ms) + F.col("id") * step_ms)


def _log_columns(kind: str, counter: Column, text_counter: Column, source: Column, destination: Column,
                 usernames: list[str], name_addresses: bool) -> list[Column]:
    happened = F.concat(F.lit("Security event "), text_counter)
    occurred = F.concat(happened, F.lit(" occurred"))
    if name_addresses:
        occurred = F.concat(occurred, F.lit(" from "), source, F.lit(" to "), destination)
    columns = {
        "json": {
            "log_id": counter,
            "timestamp": F.col("timestamp"),
            "event_type": choice(SLOT["event_type"], EVENT_TYPES),
            "status": choice(SLOT["status"], STATUSES),
            "username": choice(SLOT["username"], usernames),
            "source_ip": source,
            "destination_ip": destination,
            "details": F.concat(F.lit("Security event details for log "), text_counter),
        },
        "syslog": {
            "priority": between(SLOT["priority"], 0, 191),
            "timestamp": F.col("timestamp"),
            "hostname": F.concat(F.lit("host-"), between(SLOT["host"], 1, 100).cast("string")),
            "application": F.lit("security-app"),
            "process_id": between(SLOT["process"], 1000, 9999).cast("string"),
            "message": occurred,
        },
        "cef": {
            "version": F.lit("0"),
            "device_vendor": choice(SLOT["vendor"], VENDORS),
            "device_product": choice(SLOT["product"], PRODUCTS),
            "device_version": choice(SLOT["version"], DEVICE_VERSIONS),
            "signature_id": choice(SLOT["signature"], SIGNATURES),
            "name": choice(SLOT["name"], CEF_NAMES),
            "severity": between(SLOT["severity"], 1, 10).cast("string"),
            "extension": F.struct(
                source.alias("src"),
                destination.alias("dst"),
                between(SLOT["spt"], 1024, 65535).cast("int").alias("spt"),
                between(SLOT["dpt"], 1, 1023).cast("int").alias("dpt"),
                choice(SLOT["proto"], PROTOCOLS).alias("proto"),
                happened.alias("msg"),
            ),
        },
    }[kind]
    columns["event_time"] = F.col("event_time")
    types = {f.name: f.dataType for f in log_schema(kind)}
    return [column.cast(types[name]).alias(name) for name, column in columns.items()]


def _prepared(ids: DataFrame, seed: int) -> DataFrame:
    timed = ids.select("id", "event_time", iso_text(event_timestamp()).alias("timestamp"))
    return add_digests(timed, seed, DIGESTS)


def synth_logs(ids: DataFrame, seed: int = 42) -> Logs:
    """One log per id, of a random kind; addresses from two shared pools of 50.

    The pools share no address, so source and destination always differ.
    """
    kind = choice(SLOT["kind"], list(KINDS))
    rows = _prepared(ids, seed)
    source = choice(SLOT["source"], address_pool(seed, "source", POOL_SIZE))
    destination = choice(SLOT["destination"], address_pool(seed, "destination", POOL_SIZE))
    counter = zero_padded(F.col("id"))

    def made(name):
        columns = _log_columns(name, counter, counter, source, destination, USERNAMES, True)
        return rows.filter(kind == name).select(*columns)

    return Logs(made("json"), made("syslog"), made("cef"))


def synth_topup(ids: DataFrame, seed: int = 43) -> Logs:
    """A log of every kind per id, with addresses from the whole range and unpadded counters in texts.

    Ten ids, as ``numbered_ids(spark, 10)`` makes them, are the usual top-up.
    """
    rows = _prepared(ids, seed)
    source, destination = address(SLOT["source_octets"]), address(SLOT["destination_octets"])
    counter, text_counter = zero_padded(F.col("id")), F.col("id").cast("string")

    def made(name):
        columns = _log_columns(name, counter, text_counter, source, destination, TOPUP_USERNAMES, False)
        return rows.select(*columns)

    return Logs(made("json"), made("syslog"), made("cef"))


def flat_logs(logs: Logs) -> DataFrame:
    """Generated logs of all kinds in one table of plain columns, to look at or compare."""
    none = F.lit(None).cast("string")
    device = F.concat_ws("/", "device_vendor", "device_product", "device_version")
    ports = [F.col(f"extension.{c}").cast("string") for c in ("proto", "spt", "dpt")]
    json = ["source_ip", "destination_ip", "username", "event_type", "status", "log_id", "details"]
    syslog = [none, none, "hostname", "application", F.col("priority").cast("string"), "process_id", "message"]
    cef = ["extension.src", "extension.dst", device, F.concat_ws(" ", "signature_id", "name"), "severity",
           F.concat_ws(" ", *ports), "extension.msg"]
    parts = []
    for kind, columns in (("json", json), ("syslog", syslog), ("cef", cef)):
        named = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(columns, FLAT_COLUMNS)]
        parts.append(getattr(logs, kind).select(F.lit(kind).alias("kind"), "event_time", *named))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

"""The registered queries: every one takes a session and a folder of tables and gives a DataFrame."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.fixtures import Logs, load_logs, prepare_events, seed_users
from logspark.functions.sql import register_functions, register_tables
from logspark.functions.time import DAY, HOUR, time_floor, time_prefix
from logspark.operators import activity as act, pattern
from logspark.operators.correlate import CORRELATED, JSON_CLASS, SYSLOG_CLASS, ip_incidents, recent_ip_pairs, total_pairs
from logspark.operators.enrich import message_text
from logspark.operators.feed import event_feed
from logspark.operators.infer import TextModel, register_predict_rows
from logspark.operators.keyed import KeyedTable, append_into, materialize
from logspark.operators.ledger import AnswerLedger
from logspark.plans import analytics as an, charts
from logspark.schemas import TOPICS
from logspark.session import scratch_dir, use_utc
from logspark.sources import synth
from logspark.sources.bronze import append_bronze, append_clustered, lookup, read_bronze, replace_day, write_bronze
from logspark.sources.days import DayTable
from logspark.sources.ingest import ingest, reject_outside
from logspark.sources.logs import decode_topic, log_table
from logspark.sources.monitor import as_attribute_rows
from logspark.sources.publish import log_value
from logspark.sources.quarantine import BadRecordPolicy, bad_records, good_records, quarantine
from logspark.sources.stored_topic import read_stored_topic, store_records
from logspark.streaming.batches import suspicious_logins_batches
from logspark.streaming.corrections import MatchState, corrected_logins
from logspark.streaming.feeds import EnrichedFeed, PairFeed, TotalsFeed, join_as_of, pair_rows
from logspark.streaming.pattern import suspicious_logins_stream
from logspark.streaming.replay import feed_in_time_order, feed_with_late_rows, replay, replayed, stream_session
from logspark.streaming.running import running_totals, store_entries
from logspark.streaming.sinks import LoginTables, append_stream, message_step, upsert_stream
from logspark.streaming.sketches import sketched_totals, store_sketches

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone (all are UTC) and no structs, as results leave the registry."""
    columns = []
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind == "struct":
            columns += [F.col(f"{field.name}.{inner}").alias(inner) for inner in field.dataType.names]
        elif kind == "timestamp":
            columns.append(F.col(field.name).cast("timestamp_ntz").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def over_logs(
    build: Callable[..., DataFrame], since: str | None = None, until: str | None = None, also: Sequence[str] = ()
) -> Query:
    """A query over the derived logs; ``build`` takes the logs.

    ``since`` and ``until`` name the range of whole buckets the query reads, for the scan to prune; ``also`` names
    event columns that the logs carry.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(load_logs(use_utc(spark), sf_dir, since, until, also)))

    return run


def _with_session(build) -> Query:
    return lambda spark, sf_dir: over_logs(lambda logs: build(spark, logs))(spark, sf_dir)


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and clock of the events, from which logs are generated."""
    events = prepare_events(use_utc(spark).read.parquet(f"{sf_dir}/events.parquet"))
    return events.select(F.col("event_id").alias("id"), "event_time")


def json_topic(logs: Logs) -> DataFrame:
    """JSON logs as Avro topic records; those with ``k = 97`` carry bytes that are no record."""
    broken = (F.col("event_type") == "system_update") & (F.col("destination_ip") == "192.168.0.47")
    junk = F.concat(F.lit("broken "), F.col("log_id")).cast("binary")
    return logs.json.select(
        F.lit(TOPICS["json"]).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("log_id").cast("long").alias("offset"),
        F.col("event_ts").alias("timestamp"),
        F.col("log_id").cast("binary").alias("key"),
        F.when(broken, junk).otherwise(log_value(logs.json, "json")).alias("value"),
    )


def streamed(build: Callable[[Logs], DataFrame], name: str, **options) -> Query:
    """A stream over the derived logs, run to its end."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(replayed(use_utc(spark), sf_dir, build, name, **options))

    return run


#: Incident pairs as text. Each side is counted before the join; the extension is JSON text.
PAIRS_IN_SQL = """
WITH a AS (
  SELECT TIME_FLOOR(__time, 'PT1H') AS time_window, source_ip, event_type, status, COUNT(*) AS n
  FROM SECURITY_LOGS_JSON GROUP BY ALL),
b AS (
  SELECT TIME_FLOOR(__time, 'PT1H') AS time_window, JSON_VALUE(extension, '$.src') AS source_ip, name, severity, COUNT(*) AS n
  FROM SECURITY_LOGS_CEF GROUP BY ALL)
SELECT time_window, source_ip, a.event_type AS json_event, a.status AS json_status, b.name AS cef_event,
       b.severity AS cef_severity, a.n * b.n AS pair_count
FROM a JOIN b USING (time_window, source_ip)
WHERE a.status = 'failure' OR CAST(b.severity AS INTEGER) >= 7
"""
#: Distinct pairs of a range with the exact time of the JSON row, as text.
RECENT_PAIRS_IN_SQL = """
WITH a AS (
  SELECT DISTINCT TIME_FLOOR(__time, 'PT1H') AS time_window, __time AS event_time, source_ip, event_type, status
  FROM SECURITY_LOGS_JSON WHERE __time >= TIMESTAMP '{since}' AND __time < TIMESTAMP '{until}'),
b AS (
  SELECT DISTINCT TIME_FLOOR(__time, 'PT1H') AS time_window, JSON_VALUE(extension, '$.src') AS source_ip, name, severity
  FROM SECURITY_LOGS_CEF WHERE __time >= TIMESTAMP '{since}' AND __time < TIMESTAMP '{until}')
SELECT time_window, event_time, source_ip, a.event_type, a.status, b.name AS cef_event, b.severity
FROM a JOIN b USING (time_window, source_ip)
WHERE a.status = 'failure' OR CAST(b.severity AS INTEGER) >= 7
"""


def as_text(text: str) -> Query:
    """A query in SQL over the tables of the topics."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_functions(use_utc(spark))
        register_tables(load_logs(spark, sf_dir), extension_as_text=True)
        return comparable(spark.sql(text))

    return run


#: Slots whose runs are summed up, in milliseconds; the given tables have few rows per hour.
SLOT_MILLIS = 86_400_000


def corrected(spark: SparkSession, sf_dir: str, name: str) -> MatchState:
    """Suspicious logins of a log stream in order of time with late rows among them, corrected as they come."""
    base = scratch_dir(use_utc(spark), name)
    stored = {}

    def sink(json: DataFrame, path: str, checkpoint: str):
        query, stored["state"] = corrected_logins(json, f"{base}/state", checkpoint, SLOT_MILLIS)
        return query

    replay(spark, sf_dir, lambda logs: logs.json, base, sink, feed_with_late_rows)
    return stored["state"]


def corrected_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrected(spark, sf_dir, "w2").matches(spark)


def match_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' corrections added up: each match with how often it stands at the end, all changes applied."""
    changes = corrected(spark, sf_dir, "w2c").all_changes(spark)
    rest = [c for c in changes.columns if c not in ("change", "batch_id")]
    return changes.groupBy(*rest).agg(F.sum("change").alias("n_matches")).where("n_matches != 0")


def login_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow from log stream to stored messages, in order of time."""
    base = scratch_dir(use_utc(spark), "w5")
    tables = LoginTables(f"{base}/tables")

    def sink(json: DataFrame, path: str, checkpoint: str):
        store = message_step(seed_users(json.sparkSession), tables)
        return suspicious_logins_batches(json, f"{base}/state", checkpoint, store, keep=["log_id"])

    replay(spark, sf_dir, lambda logs: logs.json, base, sink, feed_in_time_order, marks=True)
    return tables.messages.read(spark)


def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records of a topic stream with broken ones; the stream stops if more than a twentieth are bad."""
    base = scratch_dir(use_utc(spark), "w12")
    policy = BadRecordPolicy(max_bad=spark.read.parquet(f"{sf_dir}/events.parquet").count() // 20, keep=100)

    def sink(raw: DataFrame, path: str, checkpoint: str):
        return quarantine(raw, "json", path, f"{base}/bad", checkpoint, policy, available_now=True)

    path = replay(spark, sf_dir, json_topic, base, sink)
    return comparable(read_bronze(spark, path).drop("batch_id"))


def stored_counts(
    spark: SparkSession, sf_dir: str, rows: Callable[[Logs], DataFrame], by: list[str], distinct: dict[str, str], name: str
) -> str:
    """Where the counts of a stream's micro-batches are stored, whatever the order of its rows."""

    def sink(df: DataFrame, path: str, checkpoint: str):
        return store_entries(df, path, checkpoint, by, distinct)

    return replay(spark, sf_dir, rows, scratch_dir(use_utc(spark), name), sink)


def running(
    rows: Callable[[Logs], DataFrame], by: list[str], distinct: dict[str, str], name: str, min_count: int = 5
) -> Query:
    """Totals per group over a whole stream, kept up to date batch by batch.

    A time bucket is a group like any other: it can be read while it is open, and a late row still counts.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = stored_counts(spark, sf_dir, rows, by, distinct, name)
        return comparable(running_totals(spark, path, by, distinct, min_count))

    return run


def with_bucket(df: DataFrame, width: int) -> DataFrame:
    """The text bucket, as the batch analyses take it."""
    return df.withColumn("time_window", time_prefix("timestamp", width))


def kinds_by_half_hour(logs: Logs) -> DataFrame:
    parts = [
        df.select(time_floor("event_ts", "PT30M").alias("half_hour_bucket"), F.lit(kind).alias("log_type"))
        for kind, df in (("JSON", logs.json), ("Syslog", logs.syslog), ("CEF", logs.cef))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def correlation_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds counted per bucket and class as they come; the small totals are joined, not the streams."""
    sides = []
    for kind, classes in (("syslog", SYSLOG_CLASS), ("json", JSON_CLASS)):
        by = ["time_window", *classes]
        path = stored_counts(spark, sf_dir, lambda logs, k=kind: with_bucket(getattr(logs, k), HOUR), by, {}, f"w3-{kind}")
        totals = running_totals(spark, path, by).withColumnRenamed("event_count", f"{kind}_rows")
        sides.append(totals.withColumnsRenamed(classes))
    pairs = (F.col("syslog_rows") * F.col("json_rows")).alias("pairs")
    return total_pairs(sides[0].join(sides[1], "time_window").select(F.col("time_window").alias("bucket"), *CORRELATED, pairs))


def activity_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity as one has it who applies the changes that each micro-batch gives."""
    base, by, stored = scratch_dir(use_utc(spark), "w1c"), ("time_window", "event_type", "status"), {}
    day = F.unix_date(F.to_date("time_window"))

    def sink(df: DataFrame, path: str, checkpoint: str):
        stored["feed"] = TotalsFeed(f"{base}/state", df.schema, by, tuple(an.JSON_DISTINCT.items()), day)
        return stored["feed"].run(df, checkpoint)

    replay(spark, sf_dir, lambda logs: with_bucket(logs.json, DAY), base, sink)
    return comparable(stored["feed"].applied(spark, 10))


def incremental_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-occurrences of both kinds kept by what each micro-batch adds to them."""
    base, stored = scratch_dir(use_utc(spark), "w3i"), {}
    day = F.unix_date(F.to_date(F.substring("bucket", 1, DAY)))

    def rows(logs: Logs) -> DataFrame:
        return pair_rows((logs.syslog, logs.json), time_prefix("timestamp", HOUR), (SYSLOG_CLASS, JSON_CLASS))

    def sink(df: DataFrame, path: str, checkpoint: str):
        stored["feed"] = PairFeed(f"{base}/state", df.schema, tuple(SYSLOG_CLASS.values()), tuple(JSON_CLASS.values()), day)
        return stored["feed"].run(df, checkpoint)

    replay(spark, sf_dir, rows, base, sink)
    return stored["feed"].totals(spark, 1)


#: When the mail addresses of the users change.
MAIL_CHANGE = "2024-01-16"


def user_versions(spark: SparkSession) -> DataFrame:
    """The users, and again with another mail address from a day on."""
    users = seed_users(spark)
    first = users.withColumn("valid_from", F.lit("1970-01-01"))
    second = users.withColumns({"mail": F.concat(F.lit("new."), "mail"), "valid_from": F.lit(MAIL_CHANGE)})
    return first.unionByName(second)


def enriched_as_of(logs: Logs) -> DataFrame:
    """Every match with the details of its user at that time."""
    spark = logs.json.sparkSession
    matches = pattern.suspicious_logins(logs.json)
    dated = join_as_of(matches, user_versions(spark), "failure_time")
    return dated.select("username", message_text().alias("big_string")).distinct()


def enriched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest match of each user with newest details, by a stream of matches and of changing users, in order of time."""
    base = scratch_dir(use_utc(spark), "e2")
    matches = pattern.suspicious_logins(load_logs(spark, sf_dir).json, keep=["log_id"])
    users = user_versions(spark)
    rows = matches.select(F.struct(*matches.columns).alias("attempt"), F.col("failure_time").alias("at")).unionByName(
        users.select(F.struct(*users.columns).alias("user"), F.col("valid_from").alias("at")), allowMissingColumns=True)
    rows = materialize(rows, f"{base}/rows")
    for k, (low, high) in enumerate(itertools.pairwise(("", MAIL_CHANGE[:8] + "08", MAIL_CHANGE, MAIL_CHANGE[:8] + "24", "9"))):
        rows.where((F.col("at") >= low) & (F.col("at") < high)).drop("at").write.parquet(f"{base}/feed/part={k}")
    own = stream_session(spark)
    feed = EnrichedFeed(f"{base}/state", rows.schema["attempt"].dataType, rows.schema["user"].dataType, ("failure_time", "log_id"), ("valid_from",))
    for k in range(4):
        # A run per period, as a stream that is stopped and goes on.
        stream = own.readStream.schema(rows.drop("at").schema).parquet(f"{base}/feed/part={{{','.join(map(str, range(k + 1)))}}}")
        feed.run(stream, f"{base}/checkpoint").awaitTermination()
    return feed.enriched(spark)


def messages_in_sql(spark: SparkSession, logs: Logs) -> DataFrame:
    """Messages by the table function over a whole table, in batches."""
    register_predict_rows(spark, TextModel(input_col="big_string", output_col="email_message"))
    an.enriched_failed_logins(spark, logs).createOrReplaceTempView("enriched_failed_logins_to_ask")
    return spark.sql("SELECT username, email_message FROM ml_predict_rows(TABLE(enriched_failed_logins_to_ask), 'big_string')")


def messages_asked_once(spark: SparkSession, logs: Logs) -> DataFrame:
    """Messages from stored answers; the second run finds all of them and may call a model that only fails."""
    ledger, rows = AnswerLedger(scratch_dir(spark, "answers")), an.enriched_failed_logins(spark, logs)
    ledger.predict(rows, TextModel(), "big_string", "email_message", callers=2)
    return ledger.predict(rows, TextModel(client=_refused), "big_string", "email_message", callers=2).select("username", "email_message")


def _refused(prompt: str, texts: list[str]) -> list[str]:
    raise ConnectionError("asked again")


def bronze_stream(kind: str) -> Query:
    """A log stream stored by day: the first half streamed, the second appended, one day rewritten."""

    def sink(df: DataFrame, path: str, checkpoint: str):
        return write_bronze(df, path, checkpoint, available_now=True)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_dir(use_utc(spark), f"w6-{kind}")
        number = F.pmod(F.xxhash64("event_time"), F.lit(2))
        path = replay(spark, sf_dir, lambda logs: ingest(getattr(logs, kind).filter(number == 0), kind), base, sink)
        append_bronze(ingest(getattr(load_logs(spark, sf_dir), kind).filter(number == 1), kind), path)
        day = read_bronze(spark, path).agg(F.max("event_date")).first()[0]
        if day is not None:
            replace_day(spark, path, day)
        return comparable(read_bronze(spark, path))

    return run


def versioned_days(kind: str) -> Query:
    """A log stream stored by day in versions: parts merged as it runs, a day replaced, read while that happens.

    Half of the days come from the version a reader had opened before, half from the newest.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_dir(use_utc(spark), f"s12-{kind}")
        table = DayTable(f"{base}/table", ingest(getattr(load_logs(spark, sf_dir), kind), kind).schema, fan=2)

        def sink(df: DataFrame, path: str, checkpoint: str):
            return table.stream(df, checkpoint, available_now=True)

        replay(spark, sf_dir, lambda logs: ingest(getattr(logs, kind), kind), base, sink)
        opened = table.read(spark)
        day = opened.agg(F.max("event_date")).first()[0]
        if day is not None:
            table.replace_day(spark, day, table.read(spark, day, day + timedelta(1)))
        even = F.coalesce(F.day("event_date") % 2 == 0, F.lit(False))
        return comparable(opened.where(even).unionByName(table.read(spark).where(~even)))

    return run


def created_and_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a query, with the same rows inserted again."""
    path = scratch_dir(use_utc(spark), "created")
    rows = an.failure_sequences(load_logs(spark, sf_dir))
    materialize(rows, path)
    append_into(rows, path)
    stored = log_table(spark, path).groupBy("source_ip", "event_sequence_sample")
    return stored.agg(F.sum("event_count").alias("event_count"), F.count("*").alias("n_rows"))


def appended_enriched(spark: SparkSession, logs: Logs) -> DataFrame:
    """Every enriched match in a keyed table that only appends: two batches, of which the second runs again."""
    table = LoginTables(scratch_dir(spark, "appended")).enriched
    rows = an.enriched_failed_logins(spark, logs, every_match=True)
    part = F.pmod(F.xxhash64("username"), F.lit(2))
    for batch_id in (0, 1, 1):
        table.write(rows.filter(part == batch_id), batch_id)
    return table.read(spark)


#: A row to insert by hand.
LITERAL_ROW = ("198.51.100.1", 1, "login|failure")


def literal_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a query, with one literal row inserted."""
    path = scratch_dir(use_utc(spark), "literal")
    rows = materialize(an.failure_sequences(load_logs(spark, sf_dir)), path)
    append_into(spark.createDataFrame([LITERAL_ROW], rows.schema), path)
    return log_table(spark, path)


def topic_by_offsets(starting: str) -> Query:
    """Decoded records of a stored topic by a stream that is stopped when half of them are there, and then goes on."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_dir(use_utc(spark), "s1")
        raw = json_topic(load_logs(spark, sf_dir))
        half = raw.agg(F.max("offset")).first()[0]
        for part in (F.col("offset") <= (half or 0) // 2, F.col("offset") > (half or 0) // 2):
            store_records(raw.where(part), f"{base}/topic")
            records = decode_topic(read_stored_topic(spark, f"{base}/topic", TOPICS["json"], starting), "json")
            append_stream(good_records(records), f"{base}/result", f"{base}/checkpoint").awaitTermination()
        return comparable(spark.read.parquet(f"{base}/result"))

    return run


def latest_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest log of each address, upserted by a stream in order of time; old batches are merged as new ones come."""
    base, columns = scratch_dir(use_utc(spark), "s24"), ("source_ip", "event_time", "log_id", "status")
    table = KeyedTable(f"{base}/table", "source_ip string, event_time long, log_id string, status string",
                       ("source_ip",), order=("event_time", "log_id"), fan=2)

    def sink(json: DataFrame, path: str, checkpoint: str):
        return upsert_stream(json.select(*columns), table, checkpoint)

    replay(spark, sf_dir, lambda logs: logs.json, base, sink, feed_in_time_order)
    return table.read(spark)


#: Largest relative error of a distinct count that is told to be close: three standard errors.
SKETCH_ERROR = 0.05


def sketched_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct logs and addresses by stored sketches, and whether they are close to the exact ones."""
    base, by = scratch_dir(use_utc(spark), "w1s"), ["event_type", "status"]
    distinct = {"unique_logs": "log_id", "unique_sources": "source_ip"}

    def sink(json: DataFrame, path: str, checkpoint: str):
        return store_sketches(json, f"{base}/sketches", checkpoint, by, distinct, fan=2)

    replay(spark, sf_dir, lambda logs: logs.json, base, sink)
    totals = sketched_totals(spark, f"{base}/sketches", by, distinct)
    exact = load_logs(spark, sf_dir).json.groupBy(*by).agg(*[F.count_distinct(c).alias(f"exact_{a}") for a, c in distinct.items()])
    close = [(F.abs(F.col(a) - F.col(f"exact_{a}")) <= SKETCH_ERROR * F.col(f"exact_{a}")).alias(f"{a}_close") for a in distinct]
    return totals.join(exact, by).select(*by, "event_count", *[f"exact_{a}" for a in distinct], *close)


def address_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of one user from one address in a range of days, from a table clustered by both."""
    path = scratch_dir(use_utc(spark), "s10")
    append_clustered(ingest(load_logs(spark, sf_dir).json, "json"), path, ("source_ip", "username"))
    return comparable(lookup(spark, path, {"source_ip": "10.0.0.13", "username": "root"}, WEEK_AGO, AS_OF))


def feed_of(logs: Logs) -> DataFrame:
    return event_feed(logs.json, logs.syslog, logs.cef)


# Rows of one user in one slot must fit a task.
SLOT = "1 minute"

# Fixed clock of the analyses that look back, and the last day and week before it, all on whole hours.
AS_OF, DAY_AGO, WEEK_AGO = "2024-01-31 00:00:00", "2024-01-30 00:00:00", "2024-01-24 00:00:00"

QUERIES: dict[str, Query] = {
    "f1_json_activity": over_logs(an.json_activity),
    "f2_syslog_activity": over_logs(an.syslog_activity),
    "f3_cef_overview": over_logs(an.cef_overview),
    "f4_top_failure_sources": over_logs(an.top_failure_sources),
    "f5_high_severity": over_logs(lambda logs: act.high_severity(logs.cef, limit=100)),
    "f6_syslog_json_correlation": over_logs(an.syslog_json_correlation),
    "f7_incidents": over_logs(lambda logs: act.incidents(logs.json, limit=100)),
    "f1_json_activity_all": over_logs(partial(an.json_activity, limit=None)),
    "f2_syslog_activity_all": over_logs(partial(an.syslog_activity, limit=None)),
    "f3_cef_overview_all": over_logs(partial(an.cef_overview, limit=None)),
    "f4_top_failure_sources_all": over_logs(partial(an.top_failure_sources, limit=None)),
    "f5_high_severity_all": over_logs(lambda logs: act.high_severity(logs.cef, limit=None)),
    "f7_incidents_all": over_logs(lambda logs: act.incidents(logs.json, limit=None)),
    "m1_suspicious_logins_any": over_logs(lambda logs: pattern.suspicious_logins(logs.json, scope="any")),
    "m2_suspicious_logins": over_logs(lambda logs: pattern.suspicious_logins(logs.json)),
    "m3_failed_login_state": over_logs(an.failed_login_state),
    "e1_enriched_failed_logins": _with_session(an.enriched_failed_logins),
    "e1_enriched_every_match": _with_session(partial(an.enriched_failed_logins, every_match=True)),
    "n1_generated_messages": _with_session(an.generated_messages),
    "n2_messages_in_sql": _with_session(messages_in_sql),
    "n3_messages_asked_once": _with_session(messages_asked_once),
    "d1_ip_correlation_recent": over_logs(partial(an.ip_correlation_recent, as_of=AS_OF), DAY_AGO, AS_OF),
    "d1_ip_correlation_recent_all": over_logs(
        partial(an.ip_correlation_recent, as_of=AS_OF, limit=None), DAY_AGO, AS_OF),
    "d1_ip_correlation_split_keys": over_logs(
        lambda logs: recent_ip_pairs(logs.json, logs.cef, DAY_AGO, AS_OF, share=5, min_rows=10), DAY_AGO, AS_OF),
    "d2_event_frequency": over_logs(partial(an.event_frequency, limit=None)),
    "d2_event_frequency_first": over_logs(an.event_frequency),
    "d3_ip_incidents": over_logs(lambda logs: ip_incidents(logs.json, logs.cef, limit=50)),
    "d3_ip_incident_counts": over_logs(an.ip_incident_counts),
    "d1_recent_pairs_in_sql": as_text(RECENT_PAIRS_IN_SQL.format(since=DAY_AGO, until=AS_OF)),
    "d3_incident_counts_in_sql": as_text(PAIRS_IN_SQL),
    "d4_failure_sequences": over_logs(an.failure_sequences),
    "d4_failure_sequences_first": over_logs(partial(an.failure_sequences, limit=100)),
    "x1_average_severity": over_logs(lambda logs: act.average_severity(logs.cef, "PT1H", limit=None)),
    "c0_correlated_dataset": over_logs(an.correlated_dataset),
    "c1_event_feed": over_logs(lambda logs: event_feed(logs.json, logs.syslog, logs.cef)),
    "c2_frequency_by_type": over_logs(
        lambda logs: charts.event_frequency_chart(event_feed(logs.json, logs.syslog, logs.cef), AS_OF),
        WEEK_AGO, AS_OF),
    "c3_top_sources": over_logs(
        lambda logs: charts.top_sources_chart(event_feed(logs.json, logs.syslog, logs.cef), AS_OF), WEEK_AGO, AS_OF),
    "c4_incident_timeline": over_logs(
        lambda logs: charts.incident_timeline_chart(logs.json, logs.cef, AS_OF), WEEK_AGO, AS_OF),
    "c2_frequency_by_type_all": over_logs(
        lambda logs: charts.event_frequency_chart(feed_of(logs), AS_OF, row_limit=None), WEEK_AGO, AS_OF),
    "c3_top_sources_all": over_logs(
        lambda logs: charts.top_sources_chart(feed_of(logs), AS_OF, row_limit=None), WEEK_AGO, AS_OF),
    "c3_top_sources_second_page": over_logs(lambda logs: charts.top_sources_page(feed_of(logs), 1, AS_OF), WEEK_AGO, AS_OF),
    "c4_incident_timeline_all": over_logs(
        lambda logs: charts.incident_timeline_chart(logs.json, logs.cef, AS_OF, row_limit=None), WEEK_AGO, AS_OF),
    "s9_recent_json": over_logs(
        lambda logs: reject_outside(logs.json, "P7D", "P1D", AS_OF).select("log_id", "timestamp")),
    "s1_topic_from_earliest": topic_by_offsets("earliest"),
    "s8_topic_from_latest": topic_by_offsets("latest"),
    "s10_address_lookup": address_lookup,
    "s12_versioned_days_json": versioned_days("json"),
    "s12_versioned_days_cef": versioned_days("cef"),
    "s24_latest_by_source": latest_by_source,
    "w1_sketched_activity": sketched_activity,
    "s21_created_and_inserted": created_and_inserted,
    "s23_literal_row_inserted": literal_inserted,
    "s25_appended_keyed_table": _with_session(appended_enriched),
    "k1_latest_per_topic": over_logs(an.newest_records, also=("event_id",)),
    "k1_latest_of_every_topic": over_logs(partial(an.newest_records, topics=None), also=("event_id",)),
    "k2_attribute_rows": over_logs(lambda logs: as_attribute_rows(an.newest_json_log(logs))),
    "g1_synth_logs": lambda spark, sf_dir: synth.flat_logs(synth.synth_logs(_ids(spark, sf_dir), seed=42)),
    "g2_synth_topup": lambda spark, sf_dir: synth.flat_logs(synth.synth_topup(_ids(spark, sf_dir), seed=43)),
    "i2_quarantine_good": over_logs(lambda logs: good_records(decode_topic(json_topic(logs), "json"))),
    "i2_quarantine_bad": over_logs(lambda logs: bad_records(decode_topic(json_topic(logs), "json"))),
    "w1_json_activity_stream": running(
        lambda logs: with_bucket(logs.json, DAY), ["time_window", "event_type", "status"], an.JSON_DISTINCT, "w1", 10),
    "w2_suspicious_logins_stream": corrected_matches,
    "w2_match_changes": match_changes,
    "w2_suspicious_logins_keyed_state": streamed(
        lambda logs: suspicious_logins_stream(logs.json, slot=SLOT), "w2k", feed=feed_in_time_order, marks=True),
    "w1_activity_changes": activity_changes,
    "w3_incremental_pairs": incremental_pairs,
    "e2_enriched_user_changes": enriched_changes,
    "e3_enriched_as_of": over_logs(enriched_as_of),
    "w3_correlation_stream": correlation_stream,
    "w4_frequency_stream": running(kinds_by_half_hour, ["half_hour_bucket", "log_type"], {}, "w4", 0),
    "w5_login_messages_stream": login_messages,
    "w7_top_failure_sources_stream": running(
        lambda logs: logs.json.filter(F.col("status") == "failure"), ["source_ip"], an.FAILURE_DISTINCT, "w7"),
    "w8_cef_overview_stream": running(lambda logs: logs.cef, an.CEF_CLASS, an.CEF_DISTINCT, "w8"),
    "w9_high_severity_stream": streamed(lambda logs: act.high_severity(logs.cef), "w9"),
    "w10_incidents_stream": streamed(lambda logs: act.incidents(logs.json), "w10"),
    "w11_syslog_activity_stream": running(
        lambda logs: with_bucket(logs.syslog, DAY), ["time_window", "application", "priority"], an.SYSLOG_DISTINCT, "w11", 1),
    "w12_quarantine_stream": quarantine_stream,
    "w6_bronze_stream_json": bronze_stream("json"),
    "w6_bronze_stream_syslog": bronze_stream("syslog"),
    "w6_bronze_stream_cef": bronze_stream("cef"),
    "i1_bronze_json": over_logs(lambda logs: ingest(logs.json, "json")),
    "i1_bronze_syslog": over_logs(lambda logs: ingest(logs.syslog, "syslog")),
    "i1_bronze_cef": over_logs(lambda logs: ingest(logs.cef, "cef")),
}

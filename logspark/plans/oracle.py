"""ANSI SQL for the same answers, over the ``events`` table, for checks in another engine."""

from __future__ import annotations

from logspark.fixtures import USERS
from logspark.functions.picks import DIGITS, PER_DIGEST, address_pool
from logspark.schemas import KINDS
from logspark.sources import synth

AS_OF = "2024-01-31 00:00:00"

_PAD = "lpad(cast(event_id as varchar), cast(greatest(length(cast(event_id as varchar)), 9) as int), '0')"

VIEWS = f"""
e as (
  select event_id, user_id, event_type as et, cast(json_extract_string(props, '$.k') as int) as k,
         epoch_us(ts) // 1000 as event_time, make_timestamp(epoch_us(ts) // 1000 * 1000) as event_ts,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as "timestamp"
  from events),
j as (
  select {_PAD} as log_id, "timestamp",
         case when k < 80 then 'login' when k < 85 then 'logout' when k < 90 then 'file_access'
              when k < 95 then 'network_access' else 'system_update' end as event_type,
         case when et = 'error' then 'failure' when et in ('click', 'view') then 'warning'
              else 'success' end as status,
         case user_id % 8 when 0 then 'admin' when 1 then 'user1' when 2 then 'user2' when 3 then 'user3'
              when 4 then 'system' when 5 then 'root' when 6 then 'guest' else 'nobody' end as username,
         '10.0.0.' || cast(user_id % 50 as varchar) as source_ip,
         '192.168.0.' || cast(k % 50 as varchar) as destination_ip,
         case k % 25 when 3 then 'unauthorized access' when 7 then 'malware found' when 11 then 'breach suspected'
              when 13 then 'attack signature' else 'Security event details' end
           || ' for log ' || {_PAD} as details,
         event_time, event_ts
  from e),
s as (
  select cast(k as int) as priority, "timestamp", 'host-' || cast(1 + user_id % 20 as varchar) as hostname,
         'security-app' as application, cast(1000 + event_id % 9000 as varchar) as process_id,
         'Security event ' || {_PAD} || ' occurred' as message, event_time, event_ts
  from e where event_id % 2 = 0),
c as (
  select '0' as version,
         case k % 4 when 0 then 'Microsoft' when 1 then 'Cisco' when 2 then 'Symantec' else 'Palo Alto' end
           as device_vendor,
         case when event_id % 4 = 1 then 'Windows' else 'ASA' end as device_product,
         '10.0' as device_version, '4625' as signature_id,
         case et when 'error' then 'Login Failure' when 'click' then 'Access Denied'
                 when 'view' then 'Malware Detected' else 'Traffic Allowed' end as name,
         cast(1 + k % 10 as varchar) as severity,
         '10.0.0.' || cast(user_id % 50 as varchar) as src, '192.168.0.' || cast(k % 50 as varchar) as dst,
         1024 + k as spt, 1 + k as dpt, 'TCP' as proto, 'Security event ' || {_PAD} as msg,
         event_time, event_ts
  from e where event_id % 2 = 1)
"""


def _with(*ctes: str, select: str) -> str:
    return f"with {', '.join([VIEWS.strip(), *ctes])}\n{select.strip()}"


F1 = """
select substr("timestamp", 1, 10) as time_window, event_type, status, count(*) as event_count,
       count(distinct username) as unique_users, count(distinct source_ip) as unique_sources,
       count(distinct destination_ip) as unique_destinations
from j group by 1, 2, 3 having count(*) > 10
order by time_window desc, event_count desc, event_type, status"""
F2 = """
select substr("timestamp", 1, 10) as time_window, application, priority, count(*) as event_count,
       count(distinct hostname) as unique_hosts
from s group by 1, 2, 3 having count(*) > 1
order by time_window desc, event_count desc, application, priority"""
F3 = """
select device_vendor, device_product, name, severity, count(*) as event_count,
       count(distinct src) as unique_sources, count(distinct dst) as unique_destinations
from c group by 1, 2, 3, 4 having count(*) > 5
order by event_count desc, device_vendor, device_product, name, severity"""
F4 = """
select source_ip, count(*) as event_count, count(distinct event_type) as unique_event_types,
       count(distinct username) as unique_users
from j where status = 'failure' group by 1 having count(*) > 5
order by event_count desc, source_ip"""
F5 = """
select name as event_name, severity, src as source_ip, dst as destination_ip, msg as message
from c where try_cast(severity as int) >= 7
order by cast(severity as int) desc, event_name, source_ip, destination_ip, message"""
F6 = """
select s.hostname, s.application as syslog_application, s.priority as syslog_priority,
       j.event_type as json_event_type, j.status as json_status, count(*) as correlated_events
from s join j on substr(s."timestamp", 1, 13) = substr(j."timestamp", 1, 13)
group by 1, 2, 3, 4, 5 having count(*) > 1
order by correlated_events desc, hostname, syslog_application, syslog_priority, json_event_type, json_status"""
F7 = """
select "timestamp", log_id, event_type, status, username, source_ip, destination_ip, details
from j where status = 'failure' or details like '%unauthorized%' or details like '%malware%'
   or details like '%breach%' or details like '%attack%'
order by "timestamp" desc, log_id"""


def _matches(end: str) -> str:
    """Gaps and islands: a row that is no run row closes an island; runs share their island's number."""
    return f"""
classed as (
  select *, case when status = 'warning' and event_type = 'login' then 1 else 0 end as is_run,
         case when {end} then 1 else 0 end as is_end from j),
islands as (
  select *, sum(1 - is_run) over (partition by username order by event_time, log_id
                                  rows between unbounded preceding and 1 preceding) as island
  from classed),
lengths as (
  select *, sum(is_run) over (partition by username, coalesce(island, 0) order by event_time, log_id
                              rows between unbounded preceding and current row) as run from islands),
matches as (
  select username, cast(run as bigint) as warning_count, "timestamp" as failure_time,
         source_ip as failure_source_ip, details as failed_details, log_id
  from lengths where is_end = 1 and run >= 3)"""


ANY = _matches("status = 'failure'")
SAME = _matches("status = 'failure' and event_type = 'login'")
LATEST = """
latest as (
  select * from matches
  qualify row_number() over (partition by username order by failure_time desc, log_id desc) = 1)"""
USERS_CTE = "users(username, first_name, last_name, language, mail) as (values " + ", ".join(
    "(" + ", ".join(f"'{v}'" for v in row) + ")" for row in USERS
) + ")"


def _enriched(source: str) -> str:
    return f"""
enriched as (
  select distinct a.username, language || ', ' || first_name || ', ' || last_name || ', ' || mail || ', '
         || cast(warning_count as varchar) || ', ' || failure_time || ', ' || failure_source_ip || ', '
         || failed_details as big_string
  from {source} a join users u on a.username = u.username)"""


_MATCH_COLUMNS = "username, warning_count, failure_time, failure_source_ip, failed_details"

PAIRS = """
pairs as (
  select date_trunc('hour', j.event_ts) as time_window, j.event_ts as event_time, j.source_ip, j.event_type,
         j.status, c.name as cef_event, c.severity
  from j join c on j.source_ip = c.src and date_trunc('hour', j.event_ts) = date_trunc('hour', c.event_ts)
  where j.status = 'failure' or try_cast(c.severity as int) >= 7)"""
DAY_RANGE = f"event_time >= timestamp '{AS_OF}' - interval 1 day and event_time < timestamp '{AS_OF}'"
WEEK_RANGE = f"event_time >= timestamp '{AS_OF}' - interval 7 day and event_time < timestamp '{AS_OF}'"

D1 = f"""
select distinct time_window, event_time, source_ip, event_type, status, cef_event, severity
from pairs where {DAY_RANGE}
order by time_window desc, event_time desc, source_ip, event_type, status, cef_event, severity"""
D2 = """
select half_hour_bucket, log_type, count(*) as event_count from (
  select time_bucket(interval 30 minutes, event_ts) as half_hour_bucket, 'JSON' as log_type from j
  union all select time_bucket(interval 30 minutes, event_ts), 'Syslog' from s
  union all select time_bucket(interval 30 minutes, event_ts), 'CEF' from c)
group by 1, 2 order by half_hour_bucket, log_type"""
D3_COLUMNS = """time_window, source_ip, event_type as json_event, status as json_status, cef_event,
       severity as cef_severity"""
D3 = f"select {D3_COLUMNS} from pairs order by 1, 2, 3, 4, 5, 6"
D3_COUNTS = f"select {D3_COLUMNS}, count(*) as pair_count from pairs group by 1, 2, 3, 4, 5, 6"
D4 = """
select source_ip, count(*) as event_count, concat(event_type, '|', status) as event_sequence_sample
from j where status = 'failure' and event_ts between timestamp '2000-01-01' and timestamp '3000-01-01'
group by source_ip, concat(event_type, '|', status) order by source_ip, event_sequence_sample"""

FEED = """
feed as (
  select event_ts as event_time, 'JSON' as log_type, source_ip, status, cast(null as varchar) as cef_event from j
  union all select event_ts, 'Syslog', null, null, null from s
  union all select event_ts, 'CEF', src, null, name from c)"""
C2 = f"""
select date_trunc('hour', event_time) as time_bucket, log_type, count(event_time) as event_count
from feed where {WEEK_RANGE} group by 1, 2 order by event_count desc, time_bucket, log_type limit 10000"""
C3 = f"""
select source_ip, count(event_time) as event_count from feed where {WEEK_RANGE}
group by 1 order by event_count desc, source_ip limit 10000"""
C4 = f"""
select date_trunc('hour', event_time) as time_bucket, status, cef_event, count(event_time) as event_count
from pairs where {WEEK_RANGE} group by 1, 2, 3
order by event_count desc, time_bucket, status, cef_event limit 10000"""

RECORDS = """
records as (
  select 'SECURITY_LOGS_JSON' as topic, 0 as "partition", cast(log_id as bigint) as "offset",
         event_ts as "timestamp", details as value from j
  union all select 'SECURITY_LOGS_SYSLOG', 0, cast(substr(message, 16, length(message) - 24) as bigint), event_ts,
         message from s
  union all select 'SECURITY_LOGS_CEF', 0, cast(substr(msg, 16) as bigint), event_ts, msg from c)"""
K1 = """
select * from records
qualify row_number() over (partition by topic order by "timestamp" desc, "partition" desc, "offset" desc) = 1"""
K2 = """
select unnest(['log_id', 'timestamp', 'event_type', 'status', 'username', 'source_ip', 'destination_ip', 'details',
               'event_time']) as attribute,
       unnest([log_id, "timestamp", event_type, status, username, source_ip, destination_ip, details,
               cast(event_time as varchar)]) as value
from (select * from j order by event_time desc, log_id desc limit 1)"""

_INGESTED = "cast(event_ts as date) as event_date, cast(1 as bigint) as \"count\""
I1 = {
    "json": f"""select event_ts, log_id, "timestamp", event_type, status, username, source_ip, destination_ip,
       details, {_INGESTED} from j""",
    "syslog": f"""select event_ts, cast(priority as bigint) as priority, "timestamp", hostname, application,
       process_id, message, {_INGESTED} from s""",
    "cef": f"""select event_ts, version, device_vendor, device_product, device_version, signature_id, name, severity,
       src, dst, spt, dpt, proto, msg, {_INGESTED} from c""",
}


def _number(slot: int) -> str:
    at = 1 + DIGITS * (slot % PER_DIGEST)
    return f"cast('0x' || substr(d{slot // PER_DIGEST}, {at}, {DIGITS}) as bigint)"


def _between(name: str, low: int, high: int) -> str:
    return f"({low} + {_number(synth.SLOT[name])} % {high - low + 1})"


def _choice(name: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[cast(1 + {_number(synth.SLOT[name])} % {len(values)} as int)]"


def _address(name: str) -> str:
    first = synth.SLOT[name]
    parts = [
        f"cast({low} + {_number(first + i)} % {high - low + 1} as varchar)"
        for i, (low, high) in enumerate(((1, 255), (0, 255), (0, 255), (1, 254)))
    ]
    return " || '.' || ".join(parts)


def generated(seed: int, pooled: bool) -> str:
    """Generated logs of all kinds in one flat table; ``flat_logs`` makes the same in Spark."""
    digests = ", ".join(f"md5('{seed}:{i}:' || cast(event_id as varchar)) as d{i}" for i in range(synth.DIGESTS))
    if pooled:
        source = _choice("source", address_pool(seed, "source", synth.POOL_SIZE))
        destination = _choice("destination", address_pool(seed, "destination", synth.POOL_SIZE))
        usernames, counter, addresses = synth.USERNAMES, _PAD, " || ' from ' || src || ' to ' || dst"
    else:
        source, destination = _address("source_octets"), _address("destination_octets")
        usernames, counter, addresses = synth.TOPUP_USERNAMES, "cast(event_id as varchar)", ""
    kind = _choice("kind", list(KINDS))

    def rows(name: str, columns: dict[str, str]) -> str:
        columns = {"src": "src", "dst": "dst"} | columns
        listed = ", ".join(f"{columns[c]} as {c}" for c in synth.FLAT_COLUMNS)
        where = f" where kind = '{name}'" if pooled else ""
        return f"select '{name}' as kind, event_time, {listed} from made{where}"

    return f"""with digests as (
  select event_id, epoch_us(ts) // 1000 as event_time, {digests} from events),
made as (select *, {kind} as kind, {source} as src, {destination} as dst from digests)
{rows("json", {
    "actor": _choice("username", usernames), "action": _choice("event_type", synth.EVENT_TYPES),
    "level": _choice("status", synth.STATUSES), "detail": _PAD,
    "text": f"'Security event details for log ' || {counter}"})}
union all {rows("syslog", {
    "actor": f"'host-' || cast({_between('host', 1, 100)} as varchar)", "action": "'security-app'",
    "level": f"cast({_between('priority', 0, 191)} as varchar)",
    "detail": f"cast({_between('process', 1000, 9999)} as varchar)",
    "src": "cast(null as varchar)", "dst": "cast(null as varchar)",
    "text": f"'Security event ' || {counter} || ' occurred'{addresses}"})}
union all {rows("cef", {
    "actor": " || '/' || ".join([_choice("vendor", synth.VENDORS), _choice("product", synth.PRODUCTS),
                                 _choice("version", synth.DEVICE_VERSIONS)]),
    "action": f"{_choice('signature', synth.SIGNATURES)} || ' ' || {_choice('name', synth.CEF_NAMES)}",
    "level": f"cast({_between('severity', 1, 10)} as varchar)",
    "detail": f"{_choice('proto', synth.PROTOCOLS)} || ' ' || cast({_between('spt', 1024, 65535)} as varchar)"
              f" || ' ' || cast({_between('dpt', 1, 1023)} as varchar)",
    "text": f"'Security event ' || {counter}"})}"""


STREAM_TWINS = {
    "w1_activity_changes": "f1_json_activity_all",
    "w3_incremental_pairs": "c0_correlated_dataset",
    "w1_json_activity_stream": "f1_json_activity_all",
    "w2_suspicious_logins_stream": "m2_suspicious_logins",
    "w2_suspicious_logins_keyed_state": "m2_suspicious_logins",
    "w3_correlation_stream": "c0_correlated_dataset",
    "w4_frequency_stream": "d2_event_frequency",
    "w5_login_messages_stream": "n1_generated_messages",
    "w7_top_failure_sources_stream": "f4_top_failure_sources_all",
    "w8_cef_overview_stream": "f3_cef_overview_all",
    "w9_high_severity_stream": "f5_high_severity_all",
    "w10_incidents_stream": "f7_incidents_all",
    "w11_syslog_activity_stream": "f2_syslog_activity_all",
}
# Which events come with a broken record.
BROKEN = "k = 97"


def oracle_sql() -> dict[str, str]:
    sql = {
        "f1_json_activity": _with(select=F1 + " limit 100"),
        "f1_json_activity_all": _with(select=F1),
        "f2_syslog_activity": _with(select=F2 + " limit 100"),
        "f2_syslog_activity_all": _with(select=F2),
        "f3_cef_overview": _with(select=F3 + " limit 100"),
        "f3_cef_overview_all": _with(select=F3),
        "f4_top_failure_sources": _with(select=F4 + " limit 20"),
        "f4_top_failure_sources_all": _with(select=F4),
        "f5_high_severity": _with(select=F5 + " limit 100"),
        "f5_high_severity_all": _with(select=F5),
        "f6_syslog_json_correlation": _with(select=F6 + " limit 50"),
        "f7_incidents": _with(select=F7 + " limit 100"),
        "f7_incidents_all": _with(select=F7),
        "m1_suspicious_logins_any": _with(ANY, select=f"select {_MATCH_COLUMNS} from matches"),
        "m2_suspicious_logins": _with(SAME, select=f"select {_MATCH_COLUMNS} from matches"),
        "w2_match_changes": _with(SAME, select=f"select {_MATCH_COLUMNS}, count(*) as n_matches from matches group by all"),
        "m3_failed_login_state": _with(SAME, LATEST, select=f"select {_MATCH_COLUMNS} from latest"),
        "e1_enriched_failed_logins": _with(
            SAME, LATEST, USERS_CTE, _enriched("latest"), select="select * from enriched"),
        "e1_enriched_every_match": _with(SAME, USERS_CTE, _enriched("matches"), select="select * from enriched"),
        "e2_enriched_user_changes": _with(
            SAME, LATEST, USERS_CTE, _enriched("latest").replace("|| mail", "|| 'new.' || mail"), select="select * from enriched"),
        "e3_enriched_as_of": _with(
            SAME, USERS_CTE, _enriched("matches").replace(
                "|| mail", "|| case when failure_time >= '2024-01-16' then 'new.' else '' end || mail"), select="select * from enriched"),
        "n1_generated_messages": _with(SAME, LATEST, USERS_CTE, _enriched("latest"), select="""
select username, '{"mail": "' || split_part(big_string, ', ', 4) || '", "message": "Dear '
       || split_part(big_string, ', ', 2) || ' ' || split_part(big_string, ', ', 3) || ', '
       || split_part(big_string, ', ', 5) || ' warnings came before a failed login at '
       || split_part(big_string, ', ', 6) || ' from ' || split_part(big_string, ', ', 7) || ': '
       || split_part(big_string, ', ', 8) || '"}' as email_message
from enriched"""),
        "d1_ip_correlation_recent": _with(PAIRS, select=D1 + " limit 10"),
        "d1_ip_correlation_recent_all": _with(PAIRS, select=D1),
        "d2_event_frequency": _with(select=D2),
        "d2_event_frequency_first": _with(select=D2 + " limit 100"),
        "d3_ip_incidents": _with(PAIRS, select=D3 + " limit 50"),
        "d3_ip_incident_counts": _with(PAIRS, select=D3_COUNTS),
        "d4_failure_sequences": _with(select=D4),
        "d4_failure_sequences_first": _with(select=D4 + " limit 100"),
        "x1_average_severity": _with(select="""
select date_trunc('hour', event_ts) as time_window, device_vendor, avg(try_cast(severity as int)) as average_severity,
       count(distinct src) as unique_sources
from c group by 1, 2"""),
        "c0_correlated_dataset": _with(select=F6),
        "c1_event_feed": _with(FEED, select="select * from feed"),
        "c2_frequency_by_type": _with(FEED, select=C2),
        "c3_top_sources": _with(FEED, select=C3),
        "c4_incident_timeline": _with(PAIRS, select=C4),
        "d1_ip_correlation_split_keys": _with(PAIRS, select=D1),
        "c2_frequency_by_type_all": _with(FEED, select=C2.replace(" limit 10000", "")),
        "c3_top_sources_all": _with(FEED, select=C3.replace(" limit 10000", "")),
        "c3_top_sources_second_page": _with(FEED, select=C3.replace(" limit 10000", " limit 25 offset 25")),
        "c4_incident_timeline_all": _with(PAIRS, select=C4.replace(" limit 10000", "")),
        "s9_recent_json": _with(select=f"""
select log_id, "timestamp" from j where event_ts >= timestamp '{AS_OF}' - interval 7 day
  and event_ts <= timestamp '{AS_OF}' + interval 1 day"""),
        "s24_latest_by_source": _with(select="""
select source_ip, event_time, log_id, status from j
qualify row_number() over (partition by source_ip order by event_time desc, log_id desc) = 1"""),
        "w1_sketched_activity": _with(select="""
select event_type, status, count(*) as event_count, count(distinct log_id) as exact_unique_logs,
       count(distinct source_ip) as exact_unique_sources, true as unique_logs_close, true as unique_sources_close
from j group by event_type, status"""),
        "s21_created_and_inserted": _with(select=f"""
select source_ip, event_sequence_sample, cast(2 * event_count as bigint) as event_count, cast(2 as bigint) as n_rows from ({D4})"""),
        "s23_literal_row_inserted": _with(select=f"""
select * from ({D4}) union all select '198.51.100.1', cast(1 as bigint), 'login|failure'"""),
        "k1_latest_per_topic": _with(RECORDS, select=K1),
        "k2_attribute_rows": _with(select=K2),
        "g1_synth_logs": generated(42, pooled=True),
        "g2_synth_topup": generated(43, pooled=False),
        "i2_quarantine_good": _with(select=f"""
select j.log_id, j."timestamp", event_type, status, username, source_ip, destination_ip, details, j.event_time
from j join e on j.log_id = {_PAD} where not ({BROKEN})"""),
        "i2_quarantine_bad": _with(select=f"""
select 'SECURITY_LOGS_JSON' as topic, 0 as "partition", event_id as "offset",
       hex(encode('broken ' || {_PAD})) as raw_hex from e where {BROKEN}"""),
    }
    sql["w12_quarantine_stream"] = _with(select=I1["json"] + f" where log_id in (select {_PAD} from e where not ({BROKEN}))")
    for kind, text in I1.items():
        sql[f"i1_bronze_{kind}"] = sql[f"w6_bronze_stream_{kind}"] = _with(select=text)
    sql["k1_latest_of_every_topic"] = sql["k1_latest_per_topic"]
    sql["d1_recent_pairs_in_sql"] = sql["d1_ip_correlation_recent_all"]
    sql["d3_incident_counts_in_sql"] = sql["d3_ip_incident_counts"]
    for kind in ("json", "cef"):
        sql[f"s12_versioned_days_{kind}"] = sql[f"i1_bronze_{kind}"]
    sql["s1_topic_from_earliest"] = sql["i2_quarantine_good"]
    sql["s8_topic_from_latest"] = sql["i2_quarantine_good"] + " and event_id > (select max(event_id) // 2 from e)"
    sql["s10_address_lookup"] = f"""
select * from ({sql["i1_bronze_json"]}) where source_ip = '10.0.0.13' and username = 'root'
  and event_ts >= timestamp '2024-01-24' and event_ts < timestamp '{AS_OF}'"""
    sql["s25_appended_keyed_table"] = sql["e1_enriched_every_match"]
    for name in ("n2_messages_in_sql", "n3_messages_asked_once"):
        sql[name] = sql["n1_generated_messages"]
    # A stream gives what its batch form gives.
    for stream, batch in STREAM_TWINS.items():
        sql[stream] = sql[batch]
    return sql

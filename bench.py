"""Time the registered queries and print one JSON line.

BENCH_SF_DIR  folder of tables, default /root/testdata/sf0.1
BENCH_CPUS    cores, default 8
BENCH_RUNS    timed runs per batch query after one warm-up, default 3; the median counts
BENCH_ONLY    comma-separated query names, default all headline queries
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from logspark.plans.catalog import QUERIES
from logspark.session import build_session
from logspark.sources.synth import flat_logs, numbered_ids, synth_logs

GENERATED_ROWS = 1_000_000
BATCH = [
    "f1_json_activity", "f2_syslog_activity", "f3_cef_overview", "f4_top_failure_sources", "f5_high_severity",
    "f6_syslog_json_correlation", "f7_incidents", "m1_suspicious_logins_any", "m2_suspicious_logins",
    "m3_failed_login_state", "e1_enriched_failed_logins", "n1_generated_messages", "d1_ip_correlation_recent",
    "d2_event_frequency", "d3_ip_incidents", "d3_ip_incident_counts", "d4_failure_sequences", "c0_correlated_dataset",
    "c1_event_feed", "c2_frequency_by_type", "c3_top_sources", "c4_incident_timeline", "k1_latest_per_topic",
    "k2_attribute_rows", "g1_synth_logs", "i1_bronze_json", "i2_quarantine_good",
]
# Started once each: a stream run includes its start, its state store and its closing run.
STREAMS = ["w1_json_activity_stream", "w2_suspicious_logins_stream", "w3_correlation_stream", "w4_frequency_stream"]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "logspark-bench", master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in only or BATCH + STREAMS:
        def run(query=QUERIES[name]):
            return query(spark, sf_dir)

        if name.startswith("w"):
            took[name] = seconds(run)
        else:
            seconds(run)
            took[name] = statistics.median(seconds(run) for _ in range(runs))
        print(f"{name}: {took[name]:.2f} s", file=sys.stderr, flush=True)
    rates = {}
    if not only:
        made = seconds(lambda: flat_logs(synth_logs(numbered_ids(spark, GENERATED_ROWS))))
        rates["generated_rows_per_sec"] = round(GENERATED_ROWS / made)
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        rates["pattern_rows_per_sec"] = round(events / took["m2_suspicious_logins"])
        rates["pattern_stream_rows_per_sec"] = round(events / took["w2_suspicious_logins_stream"])
    print(json.dumps({
        "metric": "sum of query times (batch: median of warm runs; streams: one run)",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in took.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
        **rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Saved datasets: named views that charts and SQL users start from."""

from __future__ import annotations

from logspark.fixtures import Logs
from logspark.functions.sql import register_tables
from logspark.functions.time import MINUTE
from logspark.operators.correlate import correlate_by_prefix
from logspark.operators.feed import event_feed


def register_datasets(logs: Logs, width: int = MINUTE) -> None:
    """The three logs whole, their correlation, and the event feed of the charts, as temporary views."""
    register_tables(logs)
    correlated = correlate_by_prefix(logs.syslog, logs.json, width, limit=None)
    correlated.createOrReplaceTempView("Correlated_Security_Events")
    event_feed(logs.json, logs.syslog, logs.cef).createOrReplaceTempView("Security_Event_Feed")

"""Enrichment of failed logins with user details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The parts of the text, in order.
MESSAGE_FIELDS = (
    "language", "first_name", "last_name", "mail",
    "warning_count", "failure_time", "failure_source_ip", "failed_details",
)


def message_text(fields: Sequence[str] = MESSAGE_FIELDS, sep: str = ", ") -> Column:
    """The text for the model; null if any part is null."""
    return F.concat(*[part for field in fields for part in (F.lit(sep), F.col(field).cast("string"))][1:])


def enrich_users(
    attempts: DataFrame,
    users: DataFrame,
    fields: Sequence[str] = MESSAGE_FIELDS,
    sep: str = ", ",
) -> DataFrame:
    """Distinct ``username, big_string`` of attempts by known users.

    The text is null if any part is null. The join carries no hint: Spark broadcasts the users
    only if their size is known to be small, and otherwise sorts and splits hot users.
    """
    return attempts.join(users, "username").select("username", message_text(fields, sep).alias("big_string")).distinct()

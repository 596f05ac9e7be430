"""SQL names for users who write queries as text.

``TIME_FLOOR`` and ``JSON_VALUE`` are SQL functions that Catalyst inlines into the plan, so a
query that uses them is optimized as if it were written with built-in functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.fixtures import Logs
from logspark.schemas import TOPICS

TIME_FLOOR = """
CREATE OR REPLACE TEMPORARY FUNCTION time_floor(ts TIMESTAMP, period STRING)
RETURNS TIMESTAMP
RETURN CASE
  WHEN period = 'P1M' THEN date_trunc('MONTH', ts)
  WHEN period = 'P3M' THEN date_trunc('QUARTER', ts)
  WHEN period = 'P1Y' THEN date_trunc('YEAR', ts)
  WHEN NOT period RLIKE '^P(?=.*[1-9])([0-9]+W|([0-9]+D)?(T(?=[0-9])([0-9]+H)?([0-9]+M)?([0-9]+S)?)?)$'
    THEN cast(raise_error(concat('time_floor: no period: ', period)) AS TIMESTAMP)
  ELSE timestamp_micros(unix_micros(ts) - pmod(
    unix_micros(ts) - CASE WHEN period LIKE '%W' THEN 345600000000 ELSE 0 END,
    (coalesce(cast(nullif(regexp_extract(period, '([0-9]+)W', 1), '') AS BIGINT), 0) * 604800
     + coalesce(cast(nullif(regexp_extract(period, '([0-9]+)D', 1), '') AS BIGINT), 0) * 86400
     + coalesce(cast(nullif(regexp_extract(period, 'T.*?([0-9]+)H', 1), '') AS BIGINT), 0) * 3600
     + coalesce(cast(nullif(regexp_extract(period, 'T.*?([0-9]+)M', 1), '') AS BIGINT), 0) * 60
     + coalesce(cast(nullif(regexp_extract(period, 'T.*?([0-9]+)S', 1), '') AS BIGINT), 0)) * 1000000))
END
"""
JSON_VALUE = """
CREATE OR REPLACE TEMPORARY FUNCTION json_value(doc STRING, path STRING)
RETURNS STRING
RETURN get_json_object(doc, path)
"""


def register_functions(spark: SparkSession) -> None:
    for text in (TIME_FLOOR, JSON_VALUE):
        spark.sql(text)


def register_tables(logs: Logs, extension_as_text: bool = False) -> None:
    """Temporary views named like the topics.

    ``extension_as_text`` gives the CEF extension as JSON text, which ``JSON_VALUE`` reads; as a
    struct it reads as ``extension.src`` or ``extension['src']`` and only used fields are scanned.
    """
    for kind, topic in TOPICS.items():
        table: DataFrame = getattr(logs, kind).withColumn("__time", F.col("event_ts"))
        if kind == "cef" and extension_as_text:
            table = table.withColumn("extension", F.to_json("extension"))
        table.createOrReplaceTempView(topic)

"""The event table as the reports read it, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.readers import table

SECOND = 1000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

ORDER = ["ms", "event_id"]

STORES = 5


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with time in milliseconds and value in whole cents."""
    return as_events(table(spark, folder, "events"))


def as_events(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        F.unix_millis("ts").alias("ms"),
        "user_id",
        "event_type",
        "value",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.pmod("user_id", F.lit(STORES)).alias("store"),
    )


# The division of microseconds floors, as unix_millis does.
EVENTS = f"""e AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ms, user_id, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS cents, user_id % {STORES} AS store
  FROM events)"""


def with_events(body: str, *ctes: str, recursive: bool = False) -> str:
    """SQL over the event table ``e`` and further common table expressions."""
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} " + ",\n".join([EVENTS, *ctes]) + "\n" + body


def pane(column: str, size: int) -> str:
    """SQL of the start of a tumbling pane."""
    return f"({column} // {size}) * {size}"

"""Keyed state machines over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import stateful as K
from tidemark.plans.inputs import HOUR, ORDER, events, with_events
from tidemark.plans.registry import report


def _delta_sql(key: str) -> str:
    by = f"PARTITION BY {key}" if key else ""
    pre = f"n.{key}" if key else "0"
    return with_events(
        f"SELECT event_id, cents FROM d WHERE kept",
        f"""n AS (SELECT *, {key or '0'} AS k, row_number() OVER ({by} ORDER BY ms, event_id) AS r
  FROM e)""",
        """d AS (
  SELECT k, r, event_id, cents, (cents = 0 OR abs(cents) > 500) AS kept,
    CASE WHEN abs(cents) > 500 OR cents = 0 THEN cents ELSE 0 END AS last FROM n WHERE r = 1
  UNION ALL
  SELECT n.k, n.r, n.event_id, n.cents, (n.cents = 0 OR abs(n.cents - d.last) > 500),
    CASE WHEN n.cents = 0 OR abs(n.cents - d.last) > 500 THEN n.cents ELSE d.last END
  FROM d JOIN n ON n.k = d.k AND n.r = d.r + 1)""",
        recursive=True,
    )


@report(_delta_sql("user_id"))
def delta_filter(spark, folder):
    """Events whose value moved by more than 5.00 since the last one kept."""
    rows = events(spark, folder).select("event_id", "ms", "user_id", "cents")
    return K.delta_filter(rows, ["user_id"], ORDER, "cents", 500).select(
        "event_id", "cents"
    )


@report(_delta_sql("event_type"))
def delta_filter_type(spark, folder):
    """The same per event type: five heavy keys, cut into chunks."""
    rows = events(spark, folder).select("event_id", "ms", "event_type", "cents")
    return K.delta_filter(
        rows, ["event_type"], ORDER, "cents", 500
    ).select("event_id", "cents")


def _runs_sql(key: str) -> str:
    return with_events(
        f"""SELECT {key}, category, min(ms) AS start_ms, max(ms + cents * 1000) AS end_ms,
  CAST(sum(cents) * 1000 AS BIGINT) AS duration_ms,
  CAST(min((ms % 86400000) // 1000) AS INTEGER) AS start_second
FROM g GROUP BY {key}, run, last_run, category HAVING run < last_run""",
        f"""c AS (SELECT *, event_type AS category, CASE WHEN event_type = lag(event_type)
    OVER (PARTITION BY {key} ORDER BY ms, event_id) THEN 0 ELSE 1 END AS starts FROM e)""",
        f"""r AS (SELECT *, sum(starts) OVER (PARTITION BY {key} ORDER BY ms, event_id
    ROWS UNBOUNDED PRECEDING) AS run FROM c)""",
        f"g AS (SELECT *, max(run) OVER (PARTITION BY {key}) AS last_run FROM r)",
    )


def _usage_rows(spark, folder, key):
    return events(spark, folder).select(
        "event_id", "ms", key,
        F.col("event_type").alias("category"),
        F.col("ms").alias("start_ms"),
        S.end_time(F.col("ms"), F.col("cents") * 1000).alias("end_ms"),
        (F.col("cents") * 1000).alias("duration_ms"),
        S.seconds_of_day(F.col("ms")).alias("start_second"),
    )


def _runs(rows, key, **split):
    return K.merge_runs(
        rows, [key], ORDER, "category", "start_ms", "end_ms", "duration_ms",
        "start_second", **split,
    )


@report(_runs_sql("user_id"))
def merge_runs(spark, folder):
    """Consecutive events of one type as one record; the open run is left out."""
    return _runs(_usage_rows(spark, folder, "user_id"), "user_id")


@report(_runs_sql("store"))
def merge_runs_store(spark, folder):
    """The same per store: five heavy keys, cut into chunks."""
    return _runs(
        _usage_rows(spark, folder, "store"), "store"
    )


_SIX_HOURS = 6 * HOUR


def _interval_rows(spark, folder, key):
    start = F.col("ms") - F.pmod("ms", F.lit(_SIX_HOURS))
    duration = (1 + F.pmod("event_id", F.lit(4))) * _SIX_HOURS
    return events(spark, folder).select(
        key, "event_id", "ms",
        start.alias("start_ms"),
        S.end_time(start, duration).alias("end_ms"),
        duration.alias("duration_ms"),
        S.seconds_of_day(F.col("ms")).alias("start_second"),
    )


def _interval_cte(key: str) -> str:
    return f"""i AS (SELECT {key} AS k, event_id, ms, (ms // {_SIX_HOURS}) * {_SIX_HOURS} AS s,
    (ms // {_SIX_HOURS}) * {_SIX_HOURS} + (1 + event_id % 4) * {_SIX_HOURS} AS t,
    (1 + event_id % 4) * {_SIX_HOURS} AS d, (ms % 86400000) // 1000 AS c,
    row_number() OVER (PARTITION BY {key} ORDER BY ms, event_id) AS r FROM e)"""


def _anchored_sql(key: str) -> str:
    return with_events(
        f"""SELECT k AS {key}, event_id, os AS start_ms, ot AS end_ms,
  CAST(od AS BIGINT) AS duration_ms, CAST(oc AS INTEGER) AS start_second FROM a WHERE r > 1""",
        _interval_cte(key),
        """a AS (
  SELECT k, r, event_id, s AS os, t AS ot, d AS od, c AS oc,
    s AS xs, t AS xt, d AS xd, c AS xc FROM i WHERE r = 1
  UNION ALL
  SELECT i.k, i.r, i.event_id,
    CASE WHEN i.s = a.xt THEN a.xs ELSE i.s END, i.t,
    CASE WHEN i.s = a.xt THEN a.xd + i.d ELSE i.d END,
    CASE WHEN i.s = a.xt THEN least(a.xc, i.c) ELSE i.c END,
    a.xs, CASE WHEN i.s = a.xt THEN i.t ELSE a.xt END,
    CASE WHEN i.s = a.xt THEN a.xd + i.d ELSE a.xd END,
    CASE WHEN i.s = a.xt THEN least(a.xc, i.c) ELSE a.xc END
  FROM a JOIN i ON i.k = a.k AND i.r = a.r + 1)""",
        recursive=True,
    )


_INTERVAL = ["start_ms", "end_ms", "duration_ms", "start_second"]


@report(_anchored_sql("user_id"))
def merge_adjacent(spark, folder):
    """Intervals that extend the first one of the user are merged into it."""
    return K.merge_anchored(
        _interval_rows(spark, folder, "user_id"), ["user_id"], ORDER, *_INTERVAL
    ).select("user_id", "event_id", *_INTERVAL)


@report(_anchored_sql("store"))
def merge_adjacent_store(spark, folder):
    """The same per store: five heavy keys."""
    return K.merge_anchored(
        _interval_rows(spark, folder, "store"), ["store"], ORDER, *_INTERVAL,
    ).select("store", "event_id", *_INTERVAL)


@report(
    with_events(
        """SELECT k AS user_id, min(s) AS start_ms, max(t) AS end_ms,
  CAST(sum(d) AS BIGINT) AS duration_ms, CAST(min(c) AS INTEGER) AS start_second
FROM g GROUP BY k, island""",
        _interval_cte("user_id"),
        """b AS (SELECT *, CASE WHEN s = lag(t) OVER (PARTITION BY k ORDER BY s, event_id)
  THEN 0 ELSE 1 END AS starts FROM i)""",
        """g AS (SELECT *, sum(starts) OVER (PARTITION BY k ORDER BY s, event_id
  ROWS UNBOUNDED PRECEDING) AS island FROM b)""",
    )
)
def merge_chained(spark, folder):
    """Intervals in order of start, each chain of touching ones merged."""
    return K.merge_chains(
        _interval_rows(spark, folder, "user_id"), ["user_id"], ["start_ms", "event_id"],
        *_INTERVAL,
    )

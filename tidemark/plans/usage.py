"""Device usage and rest: hourly use, long use, and averages of rest periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import stateful as K
from tidemark.operators import windows as W
from tidemark.operators.chunks import Fold
from tidemark.plans.inputs import DAY, HOUR, MINUTE, ORDER, events, pane, with_events
from tidemark.plans.registry import report
from tidemark.session import cut_lineage
from tidemark.sources.sinks import labelled

REST = "Sleep"
REST_MARK = "Screen"
REST_AT_LEAST = 4 * HOUR
AVERAGED_OVER = 3 * DAY


def typed_usage(raw: DataFrame) -> DataFrame:
    """Raw usage rows (name, day, time, duration as text) with numbers."""
    start = S.parse_date_time(F.col("date"), F.col("time"))
    duration = S.parse_hms(F.col("duration"))
    kept = [c for c in raw.columns if c not in ("date", "time", "duration")]
    return raw.select(*kept, start.alias("start_ms"), duration.alias("duration_ms")).select(
        *kept,
        "start_ms",
        S.end_time(F.col("start_ms"), F.col("duration_ms")).alias("end_ms"),
        "duration_ms",
        S.seconds_of_day(F.col("start_ms")).alias("start_second"),
    )


def rest_periods(
    usage: DataFrame, device: str, order: list[str], mark: str = REST_MARK,
    at_least: int = REST_AT_LEAST, merge: str = "anchor", **split,
) -> DataFrame:
    """Rest periods per device: runs of marked records that are long enough.

    ``merge="anchor"`` joins a period to the first one of the device that it
    extends; ``merge="chain"`` joins any periods that touch.
    """
    fields = ["start_ms", "end_ms", "duration_ms", "start_second"]
    recoded = usage.withColumn(
        "app_name", S.recode_containing(F.col("app_name"), mark, REST)
    )
    runs = K.merge_runs(recoded, [device], order, "app_name", *fields, **split)
    rest = runs.filter((F.col("app_name") == REST) & (F.col("duration_ms") >= at_least))
    merged = K.merge_chains if merge == "chain" else K.merge_anchored
    return merged(
        rest.drop("app_name"), [device], ["start_ms", "end_ms"], *fields,
        costly=True, **split,
    )


def mean_hours(
    rest: DataFrame, by: list[str] | None = None, size: int = AVERAGED_OVER
) -> DataFrame:
    """Mean hours of rest per pane (and key)."""
    by = by or []
    folds = [Fold("__ms", "sum", F.col("duration_ms")), Fold("__n", "count", F.lit(1))]
    return W.aggregate_tumbling(rest, by, "start_ms", size, folds).select(
        *by, W.W_START, W.W_END,
        (F.col("__ms") / (F.col("__n") * float(HOUR))).alias("mean_hours"),
    )


def mean_start(rest: DataFrame, size: int = AVERAGED_OVER) -> DataFrame:
    """Mean time of day at which rest starts; a plain mean, not a circular one."""
    folds = [Fold("__s", "sum", F.col("start_second")), Fold("__n", "count", F.lit(1))]
    return W.aggregate_tumbling(rest, [], "start_ms", size, folds).select(
        W.W_START, W.W_END,
        S.format_hms(F.expr("__s div __n")).alias("mean_start"),
    )


def mean_hours_by_weekday(rest: DataFrame, size: int = AVERAGED_OVER) -> DataFrame:
    named = rest.withColumn("weekday", S.weekday_name(F.col("start_ms")))
    return mean_hours(named, ["weekday"], size)


# -- reports over the event table -------------------------------------------------


@report(
    with_events(
        f"""SELECT event_type, {pane('ms', HOUR)} AS w_start, {pane('ms', HOUR)} + {HOUR} AS w_end,
  count(*) AS n FROM e GROUP BY ALL"""
    )
)
def usage_hourly(spark, folder):
    """Uses per app and hour."""
    return W.aggregate_tumbling(
        events(spark, folder), ["event_type"], "ms", HOUR, [W.count_fold()]
    )


@report("SELECT event_id, event_type, value FROM events WHERE value >= 30")
def usage_long(spark, folder):
    rows = events(spark, folder)
    return rows.filter(F.col("value") >= 30).select("event_id", "event_type", "value")


@report(
    with_events(
        f"""SELECT event_id, event_type, w_start, w_start + {HOUR} AS w_end FROM (
  SELECT e.*, (ms // {15 * MINUTE}) * {15 * MINUTE} - k * {15 * MINUTE} AS w_start
  FROM e, (SELECT unnest(range(0, 4)) AS k) ks WHERE value >= 30) c WHERE w_start > ms - {HOUR}"""
    )
)
def usage_long_sliding(spark, folder):
    """Long uses, one copy for each of the overlapping hours they lie in."""
    long_use = events(spark, folder).filter(F.col("value") >= 30)
    return W.sliding(long_use, "ms", HOUR, 15 * MINUTE).select(
        "event_id", "event_type", W.W_START, W.W_END
    )


def _event_usage(spark, folder) -> DataFrame:
    """Events as usage records that last as many seconds as the value has cents."""
    return events(spark, folder).select(
        "event_id", "user_id",
        F.col("event_type").alias("app_name"),
        F.col("ms").alias("start_ms"),
        S.end_time(F.col("ms"), F.col("cents") * 1000).alias("end_ms"),
        (F.col("cents") * 1000).alias("duration_ms"),
        S.seconds_of_day(F.col("ms")).alias("start_second"),
        "ms",
    )


@report(
    with_events(
        """SELECT event_id, event_type AS app_name, s * 1000 AS start_ms, (s + cents) * 1000 AS end_ms,
  cents * 1000 AS duration_ms, CAST(s % 86400 AS INTEGER) AS start_second
FROM (SELECT *, ms // 1000 AS s FROM e) t"""
    )
)
def usage_typed(spark, folder):
    """Events as raw text (day, time of day, duration), read back as typed records."""
    at = F.timestamp_millis("ms")
    cents = F.col("cents")
    parts = [F.call_function("div", cents, F.lit(3600)), F.pmod(F.call_function("div", cents, F.lit(60)), F.lit(60)), F.pmod(cents, F.lit(60))]
    raw = events(spark, folder).select(
        "event_id",
        F.col("event_type").alias("app_name"),
        F.date_format(at, "dd/MM/yyyy").alias("date"),
        F.date_format(at, "HH:mm:ss").alias("time"),
        S.message("%d:%02d:%02d", *parts).alias("duration"),
    )
    return typed_usage(raw)


_PANES = f"{pane('ms', 3 * DAY)} AS w_start, {pane('ms', 3 * DAY)} + {3 * DAY} AS w_end"


@report(
    with_events(
        f"""SELECT {_PANES}, CAST(sum(cents) * 1000 AS BIGINT) / (count(*) * CAST(3600000 AS DOUBLE))
  AS mean_hours FROM e GROUP BY ALL"""
    )
)
def avg_duration_3d(spark, folder):
    return mean_hours(_event_usage(spark, folder))


@report(
    with_events(
        f"""SELECT w_start, w_end, strftime(make_timestamp(CAST(s // n AS BIGINT) * 1000000), '%H:%M:%S')
  AS mean_start
FROM (SELECT {_PANES}, sum((ms % 86400000) // 1000) AS s, count(*) AS n FROM e GROUP BY ALL) t"""
    )
)
def avg_time_of_day_3d(spark, folder):
    return mean_start(_event_usage(spark, folder))


@report(
    with_events(
        f"""SELECT upper(dayname(make_timestamp(ms * 1000))) AS weekday, {_PANES},
  CAST(sum(cents) * 1000 AS BIGINT) / (count(*) * CAST(3600000 AS DOUBLE)) AS mean_hours
FROM e GROUP BY ALL"""
    )
)
def avg_weekday_3d(spark, folder):
    return mean_hours_by_weekday(_event_usage(spark, folder))


_REST = (
    """u AS (SELECT *, CASE WHEN contains(event_type, 'e') THEN 'Sleep' ELSE event_type END AS app,
    cents * 1000 AS d FROM e)""",
    """v AS (SELECT *, CASE WHEN app = lag(app) OVER (PARTITION BY user_id ORDER BY ms, event_id)
    THEN 0 ELSE 1 END AS starts FROM u)""",
    """x AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ms, event_id
    ROWS UNBOUNDED PRECEDING) AS run FROM v)""",
    "y AS (SELECT *, max(run) OVER (PARTITION BY user_id) AS last_run FROM x)",
    f"""z AS (SELECT user_id AS k, min(ms) AS s, max(ms + d) AS t, CAST(sum(d) AS BIGINT) AS d,
    min((ms % 86400000) // 1000) AS c FROM y WHERE run < last_run AND app = 'Sleep'
    GROUP BY user_id, run HAVING sum(d) >= {REST_AT_LEAST})""",
    "i AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY s, t) AS r FROM z)",
    """a AS (
  SELECT k, r, s AS os, d AS od, c AS oc, s AS xs, t AS xt, d AS xd, c AS xc FROM i WHERE r = 1
  UNION ALL
  SELECT i.k, i.r, CASE WHEN i.s = a.xt THEN a.xs ELSE i.s END,
    CASE WHEN i.s = a.xt THEN a.xd + i.d ELSE i.d END,
    CASE WHEN i.s = a.xt THEN least(a.xc, i.c) ELSE i.c END,
    a.xs, CASE WHEN i.s = a.xt THEN i.t ELSE a.xt END,
    CASE WHEN i.s = a.xt THEN a.xd + i.d ELSE a.xd END,
    CASE WHEN i.s = a.xt THEN least(a.xc, i.c) ELSE a.xc END
  FROM a JOIN i ON i.k = a.k AND i.r = a.r + 1)""",
    "q AS (SELECT os AS ms, od AS d, oc AS c FROM a WHERE r > 1)",
)


def _event_rest(spark, folder) -> DataFrame:
    """Rest periods of the users, with most event types taken as rest."""
    return rest_periods(
        _event_usage(spark, folder), "user_id", ORDER, mark="e"
    )


@report(
    with_events(
        f"SELECT {_PANES}, CAST(sum(d) AS BIGINT) / (count(*) * CAST(3600000 AS DOUBLE)) AS mean_hours "
        "FROM q GROUP BY ALL",
        *_REST,
        recursive=True,
    )
)
def rest_mean_hours(spark, folder):
    """Whole analysis: recode, merge runs, keep long ones, merge, average."""
    return mean_hours(_event_rest(spark, folder))


@report(
    with_events(
        f"""SELECT w_start, w_end, strftime(make_timestamp(CAST(s // n AS BIGINT) * 1000000), '%H:%M:%S')
  AS mean_start FROM (SELECT {_PANES}, sum(c) AS s, count(*) AS n FROM q GROUP BY ALL) t""",
        *_REST,
        recursive=True,
    )
)
def rest_mean_start(spark, folder):
    return mean_start(_event_rest(spark, folder))


@report(
    with_events(
        f"""SELECT upper(dayname(make_timestamp(ms * 1000))) AS weekday, {_PANES},
  CAST(sum(d) AS BIGINT) / (count(*) * CAST(3600000 AS DOUBLE)) AS mean_hours FROM q GROUP BY ALL""",
        *_REST,
        recursive=True,
    )
)
def rest_by_weekday(spark, folder):
    return mean_hours_by_weekday(_event_rest(spark, folder))


@report(
    with_events(
        f"""SELECT 'hours' AS output, NULL AS weekday, {_PANES},
  CAST(sum(d) AS BIGINT) / (count(*) * CAST(3600000 AS DOUBLE)) AS mean_hours, NULL AS mean_start FROM q GROUP BY ALL
UNION ALL SELECT 'start', NULL, w_start, w_end, NULL,
  strftime(make_timestamp(CAST(s // n AS BIGINT) * 1000000), '%H:%M:%S')
FROM (SELECT {_PANES}, sum(c) AS s, count(*) AS n FROM q GROUP BY ALL) t
UNION ALL SELECT 'weekday', upper(dayname(make_timestamp(ms * 1000))) AS weekday, {_PANES},
  CAST(sum(d) AS BIGINT) / (count(*) * CAST(3600000 AS DOUBLE)), NULL FROM q GROUP BY ALL""",
        *_REST,
        recursive=True,
    )
)
def rest_outputs(spark, folder):
    """The whole analysis once, and its three outputs from what it found."""
    rest = cut_lineage(_event_rest(spark, folder))
    outputs = {"hours": mean_hours(rest), "start": mean_start(rest), "weekday": mean_hours_by_weekday(rest)}
    hours, start, weekday = (labelled(df, name) for name, df in outputs.items())
    together = hours.unionByName(start, allowMissingColumns=True).unionByName(weekday, allowMissingColumns=True)
    return together.select(
        F.col("label").alias("output"), "weekday", "w_start", "w_end", "mean_hours", "mean_start"
    )

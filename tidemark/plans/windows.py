"""Window aggregates over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import fahrenheit_to_celsius
from tidemark.functions.user import Accumulator, accumulate
from tidemark.operators import windows as W
from tidemark.operators.chunks import Fold
from tidemark.operators.eventtime import refired_panes, side_output, split_late, with_lateness
from tidemark.plans.inputs import (
    DAY, HOUR, MINUTE, ORDER, events, pane, with_events,
)
from tidemark.plans.registry import report

_HOURLY = f"{pane('ms', HOUR)} AS w_start, {pane('ms', HOUR)} + {HOUR} AS w_end"


def _sliding_cte(size: int, slide: int) -> str:
    """Events with the start of every sliding pane they lie in."""
    return f"""p AS (
  SELECT * FROM (
    SELECT e.*, (ms // {slide}) * {slide} - k * {slide} AS w_start
    FROM e, (SELECT unnest(range(0, {-(-size // slide)})) AS k) ks) c
  WHERE w_start > ms - {size})"""


@report(
    with_events(
        f"SELECT store, {_HOURLY}, count(*) AS n FROM e WHERE event_type = 'error' GROUP BY ALL"
    )
)
def tumbling_count_hour(spark, folder):
    """Errors per store and hour."""
    errors = events(spark, folder).filter(F.col("event_type") == "error")
    return W.aggregate_tumbling(errors, ["store"], "ms", HOUR, [W.count_fold()])


@report(
    with_events(
        f"""SELECT user_id, {pane('ms', DAY)} AS w_start, {pane('ms', DAY)} + {DAY} AS w_end,
  CAST(sum(cents) AS BIGINT) / CAST(count(*) AS DOUBLE) AS mean FROM e GROUP BY ALL"""
    )
)
def tumbling_avg_key(spark, folder):
    """Mean reading per sensor and day."""
    return W.average_tumbling(
        events(spark, folder), ["user_id"], "ms", DAY, F.col("cents")
    )


@report(
    with_events(
        f"""SELECT user_id AS id, {pane('ms', DAY)} + {DAY} AS ts,
  (CAST(sum(cents) AS BIGINT) / CAST(count(*) AS DOUBLE) / 100 - 32)
    * (CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)) AS celsius
FROM e GROUP BY user_id, {pane('ms', DAY)}"""
    )
)
def sensor_average(spark, folder):
    """Mean reading per sensor and day in degrees Celsius, at the end of the pane."""
    means = W.average_tumbling(
        events(spark, folder), ["user_id"], "ms", DAY, F.col("cents")
    )
    return means.select(
        F.col("user_id").alias("id"),
        F.col(W.W_END).alias("ts"),
        fahrenheit_to_celsius(F.col("mean") / 100).alias("celsius"),
    )


def _extreme_sql(direction: str) -> str:
    return with_events(
        f"""SELECT event_type, {_HOURLY}, event_id, cents FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, {pane('ms', HOUR)}
    ORDER BY cents {direction}, ms, event_id) AS r FROM e) t WHERE r = 1"""
    )


@report(_extreme_sql("ASC"))
def tumbling_argmin(spark, folder):
    return W.extreme_tumbling(
        events(spark, folder), ["event_type"], "ms", HOUR, F.col("cents"), ORDER,
        ["event_id", "cents"], largest=False,
    )


@report(_extreme_sql("DESC"))
def tumbling_argmax(spark, folder):
    return W.extreme_tumbling(
        events(spark, folder), ["event_type"], "ms", HOUR, F.col("cents"), ORDER,
        ["event_id", "cents"], largest=True,
    )


@report(
    with_events(
        """SELECT w_start, w_end, part, count(*) AS n_items, max(r) AS n_upto,
  string_agg(CAST(event_id AS VARCHAR), ', ' ORDER BY r) AS items
FROM (SELECT *, (r - 1) // 10 AS part FROM n) t GROUP BY w_start, w_end, part""",
        f"""n AS (SELECT *, row_number() OVER (PARTITION BY w_start ORDER BY ms, event_id) AS r
  FROM (SELECT *, {_HOURLY} FROM e) x)""",
    )
)
def tumbling_collect(spark, folder):
    """The events of every hour, listed in parts of ten."""
    rows = events(spark, folder).select("event_id", "ms")
    panes = W.tumbling(rows, "ms", HOUR)
    return W.collect_panes(
        panes, [], ORDER, F.col("event_id").cast("string"), part_size=10
    )


@report(
    with_events(
        f"""SELECT event_type, w_start, w_start + {2 * HOUR} AS w_end,
  min(cents) AS low, max(cents) AS high FROM p GROUP BY event_type, w_start""",
        _sliding_cte(2 * HOUR, HOUR),
    )
)
def sliding_minmax(spark, folder):
    return W.aggregate_sliding(
        events(spark, folder), ["event_type"], "ms", 2 * HOUR, HOUR,
        W.min_max_folds(F.col("cents")),
    )


@report(
    with_events(
        f"""SELECT w_start, w_start + {5 * HOUR} AS w_end, count(*) AS n,
  CAST(sum(cents) AS BIGINT) AS total FROM p GROUP BY w_start""",
        _sliding_cte(5 * HOUR, 3 * HOUR),
    )
)
def sliding_nondivisible(spark, folder):
    return W.aggregate_sliding(
        events(spark, folder), [], "ms", 5 * HOUR, 3 * HOUR,
        [W.count_fold(), Fold("total", "sum", F.col("cents"))],
    )


def _session_ctes(keys: str, gap: int) -> tuple[str, str]:
    """Events with the number of their session."""
    by = f"PARTITION BY {keys}" if keys else ""
    return (
        f"""f AS (SELECT *, CASE WHEN ms - lag(ms) OVER ({by} ORDER BY ms, event_id) <= {gap}
  THEN 0 ELSE 1 END AS starts FROM e)""",
        f"""s AS (SELECT *, sum(starts) OVER ({by} ORDER BY ms, event_id
  ROWS UNBOUNDED PRECEDING) AS session FROM f)""",
    )


def _sessions_sql(keys: str, gap: int) -> str:
    pre = f"{keys}, " if keys else ""
    return with_events(
        f"""SELECT {pre}min(ms) AS w_start, max(ms) + {gap} AS w_end, count(*) AS n
FROM s GROUP BY {pre}session""",
        *_session_ctes(keys, gap),
    )


@report(_sessions_sql("user_id", 6 * HOUR))
def session_count_user(spark, folder):
    return W.sessions(events(spark, folder), ["user_id"], "ms", 6 * HOUR)


@report(_sessions_sql("", 5 * MINUTE))
def session_count_all(spark, folder):
    """Sessions of the whole table, merged across ranges of time."""
    return W.sessions(
        events(spark, folder), [], "ms", 5 * MINUTE,
    )


@report(
    with_events(
        """SELECT user_id, w_start, w_end, part, count(*) AS n_items, max(r) AS n_upto,
  string_agg(CAST(event_id AS VARCHAR), ', ' ORDER BY r) AS items
FROM (SELECT *, (r - 1) // 10 AS part FROM n) t GROUP BY user_id, w_start, w_end, part""",
        *_session_ctes("user_id", 6 * HOUR),
        f"""n AS (SELECT *, min(ms) OVER (PARTITION BY user_id, session) AS w_start,
    max(ms) OVER (PARTITION BY user_id, session) + {6 * HOUR} AS w_end,
    row_number() OVER (PARTITION BY user_id, session ORDER BY ms, event_id) AS r FROM s)""",
    )
)
def session_collect(spark, folder):
    """The events of every session, listed in parts of ten."""
    rows = events(spark, folder).select("event_id", "ms", "user_id")
    panes = W.in_sessions(rows, ["user_id"], "ms", 6 * HOUR)
    return W.collect_panes(
        panes, ["user_id"], ORDER, F.col("event_id").cast("string"), part_size=10
    )


@report(
    with_events(
        f"""SELECT outer_start, outer_start + {DAY} AS outer_end, w_start, w_end, n
FROM (SELECT *, row_number() OVER (PARTITION BY outer_start ORDER BY n DESC, w_start) AS r
  FROM (SELECT *, {pane('(w_end - 1)', DAY)} AS outer_start FROM c) x) y WHERE r = 1""",
        _sliding_cte(2 * HOUR, HOUR),
        f"c AS (SELECT w_start, w_start + {2 * HOUR} AS w_end, count(*) AS n FROM p GROUP BY w_start)",
    )
)
def chained_peak(spark, folder):
    """The fullest two hours of each day."""
    panes = W.aggregate_sliding(
        events(spark, folder), [], "ms", 2 * HOUR, HOUR, [W.count_fold()]
    )
    return W.peak_pane(panes, DAY, "n")


@report(
    with_events(f"SELECT {_HOURLY}, count(*) AS n FROM e GROUP BY ALL HAVING count(*) > 20")
)
def side_output_big(spark, folder):
    """The tagged second output: hours with more than 20 events."""
    panes = W.aggregate_tumbling(events(spark, folder), [], "ms", HOUR, [W.count_fold()])
    return side_output(panes, F.col("n") > 20)[1]


_ARRIVAL = f"ms + ((event_id * 7919) % 13) * {5 * MINUTE}"
_LATE = (
    f"""m AS (SELECT *, {_HOURLY}, max(ms) OVER (ORDER BY {_ARRIVAL}, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {10 * MINUTE} AS reached FROM e)"""
)


def _marked(spark, folder, **split):
    """Events in a shuffled order of arrival, marked late or on time."""
    rows = events(spark, folder).select("event_id", "ms", "user_id")
    delay = F.pmod(F.col("event_id") * 7919, F.lit(13)) * (5 * MINUTE)
    arriving = rows.withColumn("arrival", F.col("ms") + delay)
    return with_lateness(
        arriving, ["arrival", "event_id"], "ms", HOUR, 10 * MINUTE, **split
    )


@report(
    with_events(
        "SELECT event_id, user_id, w_start, w_end, 'Late Data: ' || event_id AS message "
        "FROM m WHERE w_end <= reached",
        _LATE,
    )
)
def late_events(spark, folder):
    """The side output of events whose hour was closed when they arrived."""
    late = split_late(_marked(spark, folder))[1]
    text = F.concat(F.lit("Late Data: "), F.col("event_id").cast("string"))
    return late.select("event_id", "user_id", "w_start", "w_end", text.alias("message"))


@report(
    with_events(
        """SELECT w_start, w_end, count(CASE WHEN late THEN NULL ELSE 1 END) AS on_time,
  count(CASE WHEN late THEN 1 END) AS late
FROM (SELECT *, coalesce(w_end <= reached, false) AS late FROM m) t GROUP BY w_start, w_end""",
        _LATE,
    )
)
def late_split_counts(spark, folder):
    marked = _marked(spark, folder)
    return marked.groupBy("w_start", "w_end").agg(
        F.count(F.when(~F.col("is_late"), 1)).alias("on_time"),
        F.count(F.when(F.col("is_late"), 1)).alias("late"),
    )


_KEPT = f"""l AS (SELECT *, coalesce(w_end <= reached, false) AS late,
    count(*) OVER w AS n, CAST(sum(user_id) OVER w AS BIGINT) AS users
  FROM m WHERE coalesce(reached < w_end + {20 * MINUTE}, true)
  WINDOW w AS (PARTITION BY w_start ORDER BY {_ARRIVAL}, event_id ROWS UNBOUNDED PRECEDING))"""


@report(
    with_events(
        f"""SELECT NULL AS event_id, w_start, w_end, 0 AS firing, max(n) AS n, max(users) AS users
FROM l WHERE NOT late GROUP BY w_start, w_end
UNION ALL SELECT event_id, w_start, w_end, row_number() OVER (
  PARTITION BY w_start ORDER BY {_ARRIVAL}, event_id) AS firing, n, users FROM l WHERE late""",
        _LATE,
        _KEPT,
    )
)
def late_refired(spark, folder):
    """Hours fire at their end, and again for every row up to 20 minutes late."""
    rows = events(spark, folder).select("event_id", "ms", "user_id")
    delay = F.pmod(F.col("event_id") * 7919, F.lit(13)) * (5 * MINUTE)
    folds = [W.count_fold(), Fold("users", "sum", F.col("user_id"))]
    fired = refired_panes(
        rows.withColumn("arrival", F.col("ms") + delay), [], ["arrival", "event_id"], "ms",
        HOUR, 10 * MINUTE, 20 * MINUTE, folds,
    )
    return fired.select("event_id", "w_start", "w_end", "firing", "n", "users")


class MeanValue(Accumulator):
    """Sum and number, merged and divided at the end."""

    def create(self):
        return 0, 0

    def add(self, accumulator, rows):
        return accumulator[0] + int(rows["cents"].sum()), accumulator[1] + len(rows)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, accumulator):
        return accumulator[0] / accumulator[1]


@report(
    with_events(
        f"""SELECT sensor, w_start, w_start + {HOUR} AS w_end,
  CAST(sum(cents) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_cents
FROM (SELECT CASE WHEN store > 0 THEN store END AS sensor, {pane('ms', HOUR)} AS w_start, cents
  FROM e WHERE cents IS NOT NULL) x GROUP BY sensor, w_start"""
    )
)
def tumbling_accumulated(spark, folder):
    """Mean per sensor and hour by an accumulator of the user; one sensor has no name."""
    rows = events(spark, folder).filter("cents is not null")
    named = rows.select("ms", "cents", F.when(F.col("store") > 0, F.col("store")).alias("sensor"))
    panes = W.tumbling(named, "ms", HOUR)
    return accumulate(panes, ["sensor", W.W_START, W.W_END], ["cents"], MeanValue(), "double", "mean_cents")

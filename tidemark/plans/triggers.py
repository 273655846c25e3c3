"""Count, threshold and dynamic triggers over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import triggers as G
from tidemark.operators import windows as W
from tidemark.plans.inputs import DAY, HOUR, ORDER, events, pane, with_events
from tidemark.plans.registry import report


@report(
    with_events(
        f"""SELECT event_id, w_start, w_start + {HOUR} AS w_end, n_so_far FROM (
  SELECT *, row_number() OVER (PARTITION BY w_start ORDER BY ms, event_id) AS n_so_far
  FROM (SELECT *, {pane('ms', HOUR)} AS w_start FROM e) x) y WHERE n_so_far % 2 = 0"""
    )
)
def count_trigger(spark, folder):
    """Every second event of an hour fires with the count so far."""
    panes = W.tumbling(events(spark, folder).select("event_id", "ms"), "ms", HOUR)
    return G.every_nth(panes, [], ORDER, 2).select(
        "event_id", "w_start", "w_end", "n_so_far"
    )


@report(
    with_events(
        f"""SELECT pane_number, peak_start, peak_start + {HOUR} AS peak_end, peak_count
FROM (SELECT n, row_number() OVER w AS pane_number,
    -(max(n * 10000000000000 - w_start) OVER w
      - (max(n) OVER w) * 10000000000000) AS peak_start,
    max(n) OVER w AS peak_count
  FROM c WINDOW w AS (ORDER BY w_start ROWS UNBOUNDED PRECEDING)) t
WHERE pane_number >= n""",
        f"c AS (SELECT {pane('ms', HOUR)} AS w_start, count(*) AS n FROM e GROUP BY 1)",
    )
)
def dynamic_trigger(spark, folder):
    """An hour fires once as many hours were seen as it has events."""
    rows = events(spark, folder)
    panes = W.aggregate_tumbling(rows, [], "ms", HOUR, [W.count_fold()])
    return G.dynamic_peak(panes, "n", costly=True)


@report(
    with_events(
        """SELECT event_id, store, count(*) OVER (PARTITION BY store
  ORDER BY ms, event_id ROWS 50 PRECEDING) AS retained FROM e"""
    )
)
def evict_last_50(spark, folder):
    rows = events(spark, folder).select("event_id", "ms", "store")
    return G.last_n_count(rows, ["store"], ORDER, 50).select("event_id", "store", "retained")


@report(
    with_events(
        """SELECT event_id, store, CAST(sum(cents) OVER w AS BIGINT) AS sum_cents, min(cents) OVER w AS least_cents,
  string_agg(CAST(user_id AS VARCHAR), ',') OVER w AS users
FROM e WINDOW w AS (PARTITION BY store ORDER BY ms, event_id ROWS 50 PRECEDING)"""
    )
)
def evict_last_50_values(spark, folder):
    """Sum, minimum and list of the elements that an evictor left."""
    rows = events(spark, folder).select("event_id", "ms", "store", "user_id", "cents")
    seen = {"sum_cents": F.sum("cents"), "least_cents": F.min("cents"), "users": F.collect_list("user_id")}
    return G.last_n(rows, ["store"], ORDER, 50, seen).select(
        "event_id", "store", "sum_cents", "least_cents",
        F.array_join(F.col("users").cast("array<string>"), ",").alias("users"),
    )


@report(
    with_events(
        f"""SELECT store, event_type, w_start, w_start + {DAY} AS w_end,
  string_agg(CAST(user_id AS VARCHAR), ', ' ORDER BY r) AS items
FROM (SELECT *, row_number() OVER (PARTITION BY store, event_type, w_start
    ORDER BY ms, event_id) AS r
  FROM (SELECT *, {pane('ms', DAY)} AS w_start FROM e) x) y
WHERE r <= 3 GROUP BY store, event_type, w_start"""
    )
)
def top3_first(spark, folder):
    """The first three apps of each event type, store and day."""
    panes = W.tumbling(events(spark, folder), "ms", DAY)
    return W.first_of_each(
        panes, ["store", "event_type", W.W_START, W.W_END], ORDER, 3,
        F.col("user_id").cast("string"),
    )

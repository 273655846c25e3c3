"""Interval and window joins of purchases and clicks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.joins import interval_join as join_interval
from tidemark.operators.joins import window_join as join_window
from tidemark.operators.joins import window_pairs
from tidemark.plans.inputs import DAY, HOUR, events, pane, with_events
from tidemark.plans.registry import report


def _side(spark, folder, event_type, prefix):
    rows = events(spark, folder).filter(F.col("event_type") == event_type)
    return rows.select(
        "user_id",
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ms").alias(f"{prefix}_ms"),
    )


_SIDES = (
    "p AS (SELECT user_id, event_id AS purchase_id, ms AS purchase_ms FROM e WHERE event_type = 'purchase')",
    "c AS (SELECT user_id, event_id AS click_id, ms AS click_ms FROM e WHERE event_type = 'click')",
)


@report(
    with_events(
        f"""SELECT p.user_id, purchase_id, click_id, greatest(purchase_ms, click_ms) AS joined_ts
FROM p JOIN c ON p.user_id = c.user_id
  AND click_ms BETWEEN purchase_ms - {2 * HOUR} AND purchase_ms + {HOUR}""",
        *_SIDES,
    )
)
def interval_join(spark, folder):
    """Purchases with the clicks of the user from 2 h before to 1 h after."""
    return join_interval(
        _side(spark, folder, "purchase", "purchase"),
        _side(spark, folder, "click", "click"),
        "user_id", "purchase_ms", "click_ms", -2 * HOUR, HOUR,
        ["purchase_id"], ["click_id"],
    ).select("user_id", "purchase_id", "click_id", "joined_ts")


@report(
    with_events(
        f"""SELECT p.user_id, {pane('purchase_ms', 6 * HOUR)} AS w_start, purchase_id, click_id
FROM p JOIN c ON p.user_id = c.user_id
  AND {pane('purchase_ms', 6 * HOUR)} = {pane('click_ms', 6 * HOUR)}""",
        *_SIDES,
    )
)
def window_join(spark, folder):
    """Purchases and clicks of a user within the same six hours."""
    return join_window(
        _side(spark, folder, "purchase", "purchase"),
        _side(spark, folder, "click", "click"),
        "user_id", "purchase_ms", "click_ms", 6 * HOUR,
        ["purchase_id"], ["click_id"],
    ).select("user_id", "w_start", "purchase_id", "click_id")


@report(
    with_events(
        f"""SELECT p.store, {pane('purchase_ms', 3 * DAY)} AS w_start, count(*) AS pairs,
  CAST(sum(abs(purchase_ms - click_ms)) AS BIGINT) AS apart_ms
FROM ps p JOIN cs c ON p.store = c.store
  AND {pane('purchase_ms', 3 * DAY)} = {pane('click_ms', 3 * DAY)} GROUP BY 1, 2""",
        "ps AS (SELECT store, event_id AS purchase_id, ms AS purchase_ms FROM e WHERE event_type = 'purchase')",
        "cs AS (SELECT store, event_id AS click_id, ms AS click_ms FROM e WHERE event_type = 'click')",
    )
)
def window_join_store(spark, folder):
    """Pairs per store and three days: heavy groups, counted without making pairs."""

    def side(event_type, prefix):
        rows = events(spark, folder).filter(F.col("event_type") == event_type)
        return rows.select(
            "store", F.col("event_id").alias(f"{prefix}_id"), F.col("ms").alias(f"{prefix}_ms")
        )

    return window_pairs(
        side("purchase", "purchase"), side("click", "click"),
        "store", "purchase_ms", "click_ms", 3 * DAY, "purchase_id", "click_id",
    )

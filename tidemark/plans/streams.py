"""Reports that run whole tables as streams, with state, watermarks and timers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import rolling as R
from tidemark.plans import rolling  # noqa: F401  SQL of the static twin
from tidemark.plans.inputs import DAY, MINUTE, as_events, with_events
from tidemark.plans.registry import SQL, report
from tidemark.plans.windows import _session_ctes
from tidemark.sources.readers import whole_stream
from tidemark.sources.sinks import drained
from tidemark.streaming import processors as P
from tidemark.streaming.sessions import sessions

_GAP = 5 * MINUTE
_EXPIRE = 30 * DAY


@report(
    with_events(
        f"""SELECT w_start, w_end, n FROM p, (SELECT max(ms) AS reached FROM e) r
WHERE w_end + {_GAP} <= reached OR following // {_GAP} * {_GAP} + {_GAP} <= reached""",
        *_session_ctes("", _GAP),
        f"""p AS (SELECT min(ms) AS w_start, max(ms) + {_GAP} AS w_end, count(*) AS n,
  lead(min(ms)) OVER (ORDER BY min(ms)) AS following FROM s GROUP BY session)""",
    )
)
def stream_session_all(spark, folder):
    """Sessions over all rows, as far as the watermark closes them."""
    timed = whole_stream(spark, folder, "events").withWatermark("ts", "0 seconds")
    return drained(sessions(timed, [], "ts", _GAP))


@report(SQL["rolling_map"])
def stream_map_user(spark, folder):
    """Counts per event type so far, in the map state of a user."""
    rows = as_events(whole_stream(spark, folder, "events")).select("event_id", "ms", "user_id", "event_type")
    counted = drained(P.rolling_map_count(rows, ["user_id"], ["ms", "event_id"], "event_type"), "update")
    return counted.select("event_id", "user_id", R.format_map(F.col("counts")).alias("counts"))


@report(
    f"""SELECT o_orderkey AS id, order_ms, delivery_ms, order_ms + {3 * DAY} AS deadline_ms,
  CASE WHEN delivery_ms < order_ms + {3 * DAY} THEN 'on_time' ELSE 'late' END AS status
FROM (SELECT o_orderkey, order_ms, coalesce(
    CASE WHEN order_ms - before_ms < {_EXPIRE} THEN before_ms END,
    CASE WHEN after_ms - order_ms < {_EXPIRE} THEN after_ms END) AS delivery_ms
  FROM (SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS order_ms,
      max(CASE WHEN l_shipdate < o_orderdate THEN epoch_us(l_shipdate) // 1000 END) AS before_ms,
      min(CASE WHEN l_shipdate >= o_orderdate THEN epoch_us(l_shipdate) // 1000 END) AS after_ms
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL) d) m
WHERE delivery_ms IS NOT NULL"""
)
def stream_order_matches(spark, folder):
    """An order and the last shipment before it or the first one after it, at most 30 days apart.

    Rows of either stream wait in state for the other side, and expire.
    """
    orders = whole_stream(spark, folder, "orders").select("o_orderkey", F.unix_millis("o_orderdate").alias("order_ms"))
    shipped = whole_stream(spark, folder, "lineitem").select("l_orderkey", F.unix_millis("l_shipdate").alias("delivery_ms"))
    return drained(P.match_deliveries(
        orders, shipped, "o_orderkey", "l_orderkey", "order_ms", "delivery_ms", 3 * DAY, _EXPIRE,
    ))

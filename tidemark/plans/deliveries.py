"""Delivery deadlines: orders matched with their first shipment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.joins import match_deliveries
from tidemark.plans.inputs import DAY
from tidemark.plans.registry import report
from tidemark.sources.readers import table


@report(
    f"""WITH d AS (SELECT l_orderkey, min(epoch_us(l_shipdate)) // 1000 AS delivery_ms
  FROM lineitem GROUP BY l_orderkey),
m AS (SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS order_ms, delivery_ms
  FROM orders JOIN d ON o_orderkey = l_orderkey),
s AS (SELECT *, order_ms + {3 * DAY} AS deadline_ms,
  CASE WHEN delivery_ms < order_ms + {3 * DAY} THEN 'on_time' ELSE 'late' END AS status FROM m)
SELECT o_orderkey, order_ms, delivery_ms, deadline_ms, status,
  row_number() OVER (PARTITION BY status ORDER BY delivery_ms, o_orderkey) AS class_number
FROM s"""
)
def delivery_sla(spark, folder):
    """Was the first shipment of an order sent within three days of it?"""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.unix_millis("o_orderdate").alias("order_ms")
    )
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first"))
        .select("l_orderkey", F.unix_millis("first").alias("delivery_ms"))
    )
    return match_deliveries(
        orders, shipped, "o_orderkey", "l_orderkey", "order_ms", "delivery_ms",
        3 * DAY,
    ).select(
        "o_orderkey", "order_ms", "delivery_ms", "deadline_ms", "status", "class_number"
    )

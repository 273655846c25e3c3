"""Rolling aggregates over the event and document tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import rolling as R
from tidemark.plans.inputs import ORDER, events, with_events
from tidemark.plans.registry import report
from tidemark.sources.readers import spread, table

_PRIME = 1_000_003
_SO_FAR = "ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING"


@report(
    """WITH words AS (
  SELECT doc_id, regexp_split_to_array(lower(text), '[^a-z0-9_]+') AS w FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM words)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, word,
  count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS total
FROM tokens WHERE word IN ('the', 'a')"""
)
def article_rolling(spark, folder):
    """Running count of each article over all documents: two very heavy keys."""
    texts = spread(table(spark, folder, "documents").select("doc_id", "text"))
    tokens = texts.select(
        "doc_id", F.posexplode(S.lower_split(F.col("text"))).alias("pos", "word")
    )
    articles = tokens.filter(F.col("word").isin("the", "a"))
    return R.rolling_count(
        articles, ["word"], ["doc_id", "pos"], "total", costly=True
    )


@report(
    with_events(
        f"""SELECT event_id, user_id, n, printf('user %d made %d click(s)', user_id, n) AS message
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, event_id) AS n FROM e) t"""
    )
)
def rolling_count_user(spark, folder):
    counted = R.rolling_count(
        events(spark, folder).select("event_id", "ms", "user_id"), ["user_id"], ORDER
    )
    text = S.message("user %d made %d click(s)", F.col("user_id"), F.col("n"))
    return counted.select("event_id", "user_id", "n", text.alias("message"))


@report(
    with_events(
        f"""SELECT event_id, user_id,
  CAST(sum(cents) OVER (PARTITION BY user_id {_SO_FAR}) AS BIGINT) AS total FROM e"""
    )
)
def rolling_sum_user(spark, folder):
    rows = events(spark, folder).select("event_id", "ms", "user_id", "cents")
    return R.rolling_sum(rows, ["user_id"], ORDER, F.col("cents")).select(
        "event_id", "user_id", "total"
    )


@report(
    with_events(
        f"""SELECT event_id, event_type,
  CAST(sum(cents) OVER (PARTITION BY event_type {_SO_FAR}) AS BIGINT) AS total FROM e"""
    )
)
def rolling_sum_type(spark, folder):
    """Running usage per app: few keys, so each of them is chunked."""
    rows = events(spark, folder).select("event_id", "ms", "event_type", "cents")
    return R.rolling_sum(
        rows, ["event_type"], ORDER, F.col("cents")
    ).select("event_id", "event_type", "total")


@report(
    with_events(
        f"SELECT event_id, CAST(sum(cents) OVER ({_SO_FAR}) AS BIGINT) AS total FROM e"
    )
)
def rolling_sum_all(spark, folder):
    """Running total of the whole table, which is one key."""
    rows = events(spark, folder).select("event_id", "ms", "cents")
    return R.rolling_sum(
        rows, [], ORDER, F.col("cents")
    ).select("event_id", "total")


@report(
    with_events(
        f"""SELECT event_id, event_type,
  max(cents) OVER (PARTITION BY event_type {_SO_FAR}) AS largest FROM e"""
    )
)
def rolling_reduce_type(spark, folder):
    """Running reduce by a Python function, few heavy keys."""
    rows = events(spark, folder).select("event_id", "ms", "event_type", "cents")
    return R.rolling_reduce(
        rows, ["event_type"], ORDER, "cents", np.maximum, "largest",
    ).select("event_id", "event_type", "largest")


@report(
    with_events(
        f"""SELECT event_id, event_type,
  list_reduce(list(1 + abs(cents) % 1000) OVER (PARTITION BY event_type {_SO_FAR}),
    lambda a, b: a * b % {_PRIME}) AS product FROM e"""
    )
)
def rolling_product_type(spark, folder):
    """Running product modulo a prime: a reduce function without a built-in form."""
    rows = events(spark, folder).select("event_id", "ms", "event_type", "cents")
    small = rows.withColumn("factor", 1 + F.abs("cents") % 1000)
    return R.rolling_reduce(
        small, ["event_type"], ORDER, "factor", lambda a, b: a * b % _PRIME, "product",
    ).select("event_id", "event_type", "product")


@report(
    with_events(
        f"""SELECT event_id, user_id,
  string_agg(event_type || ', ', '') OVER (PARTITION BY user_id {_SO_FAR}) AS texts FROM e"""
    )
)
def rolling_concat(spark, folder):
    rows = events(spark, folder).select("event_id", "ms", "user_id", "event_type")
    text = F.concat("event_type", F.lit(", "))
    return R.rolling_concat(rows, ["user_id"], ORDER, text).select(
        "event_id", "user_id", "texts"
    )


@report(
    with_events(
        f"""SELECT event_id, user_id,
  string_agg(event_type, ', ') OVER (PARTITION BY user_id {_SO_FAR}) AS buttons FROM e"""
    )
)
def rolling_list(spark, folder):
    rows = events(spark, folder).select("event_id", "ms", "user_id", "event_type")
    return R.rolling_list(rows, ["user_id"], ORDER, F.col("event_type")).select(
        "event_id", "user_id", S.concat_all(F.col("items"), ", ").alias("buttons")
    )


@report(
    with_events(
        """SELECT c.event_id, c.user_id,
  string_agg(t.event_type || '=' || c.counts[t.i], ', ' ORDER BY t.event_type) AS counts
FROM c JOIN t ON c.counts[t.i] > 0 GROUP BY c.event_id, c.user_id""",
        """t AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS INTEGER) AS i
  FROM (SELECT DISTINCT event_type FROM events) d)""",
        f"""s AS (SELECT e.event_id, e.user_id, t.i,
    count(CASE WHEN e.event_type = t.event_type THEN 1 END)
      OVER (PARTITION BY e.user_id, t.i {_SO_FAR.replace("ms", "e.ms").replace("event_id", "e.event_id")}) AS n
  FROM e CROSS JOIN t)""",
        "c AS (SELECT event_id, user_id, list(n ORDER BY i) AS counts FROM s GROUP BY event_id, user_id)",
    )
)
def rolling_map(spark, folder):
    """All button counts of the user so far, on every click."""
    rows = events(spark, folder).select("event_id", "ms", "user_id", "event_type")
    return R.rolling_map_count(rows, ["user_id"], ORDER, "event_type").select(
        "event_id", "user_id", R.format_map(F.col("counts")).alias("counts")
    )


@report(
    with_events(
        """SELECT event_id, day, part,
  row_number() OVER (PARTITION BY part ORDER BY ms, event_id) AS n
FROM (SELECT *, strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS day,
  CASE WHEN h >= 4 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 17 THEN 'day'
       WHEN h >= 17 THEN 'evening' ELSE 'night' END AS part
  FROM (SELECT *, (ms // 3600000) % 24 AS h FROM e WHERE event_type = 'click') x) y"""
    )
)
def time_of_day_rolling(spark, folder):
    """Running number of comments per part of the day: four keys."""
    clicks = events(spark, folder).filter(F.col("event_type") == "click")
    seconds = S.to_seconds(F.col("ms"))
    dated = clicks.select(
        "event_id", "ms",
        S.date_from_seconds(seconds).cast("string").alias("day"),
        S.part_of_day(seconds).alias("part"),
    )
    return R.rolling_count(dated, ["part"], ORDER).select(
        "event_id", "day", "part", "n"
    )

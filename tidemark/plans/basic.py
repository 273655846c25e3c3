"""Filters, projections, tokens, message decoding, user rows, SQL insert."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions import schemas
from tidemark.functions.user import expand
from tidemark.plans.inputs import events, with_events
from tidemark.plans.registry import report
from tidemark.session import shared_folder
from tidemark.sources.readers import decode_csv_value, generated_users, spread, table
from tidemark.sources.sinks import insert_select as insert_into


@report("SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def filter_error(spark, folder):
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "error")
        .select("event_id", "user_id", "value")
    )


@report("SELECT event_id, user_id FROM events WHERE user_id % 2 <> 0")
def filter_odd(spark, folder):
    rows = table(spark, folder, "events")
    return rows.filter(F.col("user_id") % 2 != 0).select("event_id", "user_id")


@report(
    "SELECT event_id, event_type, value FROM events "
    "WHERE value > 0 AND event_type IN ('click', 'purchase')"
)
def filter_positive_set(spark, folder):
    rows = table(spark, folder, "events")
    return rows.filter(
        (F.col("value") > 0) & F.col("event_type").isin("click", "purchase")
    ).select("event_id", "event_type", "value")


@report(
    "SELECT event_id, user_id AS id, "
    "(value - 32) * (CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)) AS celsius FROM events"
)
def project_fahrenheit(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("id"),
        S.fahrenheit_to_celsius(F.col("value")).alias("celsius"),
    )


@report(
    with_events(
        "SELECT event_id, CASE WHEN contains(event_type, 'sign') THEN 'Sleep' "
        "ELSE event_type END AS category, ms AS start_ms, ms + cents * 1000 AS end_ms FROM e"
    )
)
def recode_category(spark, folder):
    return events(spark, folder).select(
        "event_id",
        S.recode_containing(F.col("event_type"), "sign", "Sleep").alias("category"),
        F.col("ms").alias("start_ms"),
        S.end_time(F.col("ms"), F.col("cents") * 1000).alias("end_ms"),
    )


@report(
    with_events(
        """SELECT event_id,
  CASE WHEN h >= 4 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 17 THEN 'day'
       WHEN h >= 17 THEN 'evening' ELSE 'night' END AS part,
  strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS day,
  upper(dayname(make_timestamp(ms * 1000))) AS weekday,
  CAST((ms % 86400000) // 1000 AS INTEGER) AS second_of_day,
  strftime(make_timestamp(ms * 1000), '%H:%M:%S') AS time_of_day,
  strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%SZ') AS instant,
  printf('user %d made %s', user_id, event_type) AS message
FROM (SELECT *, (ms // 3600000) % 24 AS h FROM e) t"""
    )
)
def calendar_fields(spark, folder):
    ms = F.col("ms")
    return events(spark, folder).select(
        "event_id",
        S.part_of_day(S.to_seconds(ms)).alias("part"),
        S.date_from_seconds(S.to_seconds(ms)).cast("string").alias("day"),
        S.weekday_name(ms).alias("weekday"),
        S.seconds_of_day(ms).alias("second_of_day"),
        S.format_hms(S.seconds_of_day(ms)).alias("time_of_day"),
        S.format_instant(F.timestamp_millis(ms)).alias("instant"),
        S.message("user %d made %s", F.col("user_id"), F.col("event_type")).alias("message"),
    )


@report(
    """WITH words AS (
  SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM documents)
SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word"""
)
def token_counts(spark, folder):
    texts = spread(table(spark, folder, "documents").select("text"))
    words = texts.select(
        F.explode(S.lower_split(F.col("text"))).alias("word")
    )
    return words.filter(F.col("word") != "").groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def _long_words(texts: pa.Array) -> tuple[list[int], pa.RecordBatch]:
    """Place and text of every long word; expressions give matches, but not their places."""
    found = [
        (row, m.start(), m.group())
        for row, text in enumerate(texts.to_pylist()) if text
        for m in re.finditer("[a-z0-9_]{12,}", text.lower())
    ]
    rows, starts, words = zip(*found) if found else ((), (), ())
    columns = {"start": pa.array(starts, pa.int32()), "word": pa.array(words, pa.string())}
    return list(rows), pa.RecordBatch.from_pydict(columns)


@report(
    """WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9_]+|[^a-z0-9_]+') AS parts FROM documents),
p AS (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM t),
s AS (SELECT *, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM p)
SELECT doc_id, CAST(start AS INTEGER) AS start, part AS word FROM s
WHERE length(part) >= 12 AND regexp_matches(part, '^[a-z0-9_]')"""
)
def long_word_places(spark, folder):
    """Every long word of the documents with its place, by a user's row expansion."""
    texts = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return expand(texts, ["text"], _long_words, "start int, word string", keep=["doc_id"])


@report(
    with_events(
        """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(event_id AS INTEGER) AS item_id,
  CAST(cents AS INTEGER) AS category_id, event_type AS behavior, CAST(ms AS VARCHAR) AS ts FROM e"""
    )
)
def kafka_decode(spark, folder):
    fields = ["user_id", "event_id", "cents", "event_type", "ms"]
    messages = events(spark, folder).select(
        F.concat_ws(",", F.lit("x"), *[F.col(c).cast("string") for c in fields])
        .cast("binary")
        .alias("value")
    )
    return decode_csv_value(messages, schemas.USER_BEHAVIOR)


_USERS = """g AS (
  SELECT c_custkey AS id, ((c_custkey + 42) % 2147483647) * 48271 % 2147483647 AS s,
         CAST(c_nationkey AS INTEGER) AS nation,
         CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS in_credit FROM customer),
u AS (
  SELECT id, CAST(1 + s % 100 AS INTEGER) AS rating,
         CAST(((s + 1) % 2147483647) * 48271 % 2147483647 % 2 = 0 AS INTEGER) AS subscribed,
         nation, in_credit FROM g)"""


def _users(spark, folder):
    """Customers as user rows: generated rating and subscription, own nation and whether in credit."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("int").alias("nation"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("in_credit"),
    )
    users = generated_users(customers, "c_custkey", keep=["nation", "in_credit"])
    return users.select("id", "rating", F.col("subscription").cast("int").alias("subscribed"), "nation", "in_credit")


@report(f"WITH {_USERS} SELECT id, rating, subscribed, nation, in_credit FROM u")
def datagen_users(spark, folder):
    """A generated user row for every customer, with the customer's own columns."""
    return _users(spark, folder)


@report(f"WITH {_USERS} SELECT rating, subscribed, nation, in_credit FROM u")
def insert_select(spark, folder):
    """All columns of the user rows but the key, inserted into a sink table."""
    name = f"user_output_{uuid.uuid4().hex[:12]}"
    _users(spark, folder).createOrReplaceTempView(f"source_of_{name}")
    location = f"{shared_folder(spark)}/{name}"
    spark.sql(
        f"CREATE TABLE {name} (rating INT, subscribed INT, nation INT, in_credit INT) "
        f"USING parquet LOCATION '{location}'"
    )
    found = insert_into(spark, name, f"source_of_{name}", ["rating", "subscribed", "nation", "in_credit"])
    spark.catalog.dropTempView(f"source_of_{name}")
    return found

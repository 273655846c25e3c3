"""Two inputs matched one to one, with expiry: static, stream and plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import drain, same, write_as_files
from tidemark.operators import joins
from tidemark.sources import readers
from tidemark.streaming import processors as P


def walked(rows, limit, expire):
    """rows: (id, time, side), matched as they come."""
    out, kept = [], {}
    for key, t, side in sorted(rows, key=lambda r: (r[1], r[2])):
        if key in kept and expire is not None and t - kept[key][0] >= expire:
            del kept[key]
        if key in kept and kept[key][1] != side:
            other = kept.pop(key)[0]
            o, d = (other, t) if side else (t, other)
            out.append((key, o, d, "on_time" if d < o + limit else "late"))
        else:
            kept[key] = (t, side)
    numbers, named = defaultdict(int), []
    for key, o, d, status in sorted(out, key=lambda r: (r[2], r[0])):
        numbers[status] += 1
        named.append((key, o, d, status, numbers[status]))
    return named


def tables(spark, rows):
    orders = spark.createDataFrame([(k, t) for k, t, s in rows if not s], "o long, order_ms long")
    deliveries = spark.createDataFrame([(k, t) for k, t, s in rows if s], "d long, delivery_ms long")
    return orders, deliveries


@pytest.fixture
def rows():
    rng = random.Random(8)
    # one id has a third of all rows; times differ within an id
    found = {(rng.choice([1, 1, *range(2, 60)]) if rng.random() < 0.6 else 1, rng.randrange(4000)) for _ in range(500)}
    return [(k, t, rng.randrange(2)) for k, t in sorted(found)]


@pytest.mark.parametrize("expire", [None, 40, 500])
def test_matches_one_to_one(spark, tiny_chunks, rows, expire):
    orders, deliveries = tables(spark, rows)
    due = walked(rows, 30, expire)
    for options in ({}, {"rows_per_chunk": 20}):
        found = joins.match_deliveries(orders, deliveries, "o", "d", "order_ms", "delivery_ms", 30, expire_ms=expire, **options)
        got = sorted(tuple(r) for r in found.select("o", "order_ms", "delivery_ms", "status", "class_number").collect())
        assert got == sorted(due) and len(due) > 20


def test_one_order_with_many_deliveries(spark):
    orders, deliveries = tables(spark, [(1, 0, 0), (1, 5, 1), (1, 6, 1), (1, 7, 1), (2, 9, 1), (2, 10, 0), (3, 1, 0)])
    none = spark.createDataFrame([(None, 4)], "d long, delivery_ms long")
    found = joins.match_deliveries(orders, deliveries.union(none), "o", "d", "order_ms", "delivery_ms", 5)
    got = sorted(tuple(r) for r in found.select("o", "delivery_ms", "status", "class_number").collect())
    assert got == [(1, 5, "late", 1), (2, 9, "on_time", 1)]


def test_stream_with_expiry_equals_the_table(spark, tmp_path, rows):
    orders, deliveries = tables(spark, rows)
    times = spark.createDataFrame(rows, "id long, t long, side int")
    write_as_files(times, tmp_path / "both", order="t")
    columns = ["id", "order_ms", "delivery_ms", "status"]
    for expire in (None, 500):
        source = readers.table_stream(spark, str(tmp_path / "both"), times.schema)
        left = source.filter("side = 0").select(F.col("id").alias("o"), F.col("t").alias("order_ms"))
        source = readers.table_stream(spark, str(tmp_path / "both"), times.schema)
        right = source.filter("side = 1").select(F.col("id").alias("d"), F.col("t").alias("delivery_ms"))
        streamed = P.match_deliveries(left, right, "o", "d", "order_ms", "delivery_ms", 30, expire, "10 seconds")
        batch = joins.match_deliveries(orders, deliveries, "o", "d", "order_ms", "delivery_ms", 30, expire_ms=expire)
        assert same(drain(streamed, "append" if expire else "update"), batch.withColumnRenamed("o", "id"), *columns)


def test_state_of_a_stream_is_kept_by_bucket(spark, tmp_path, rows, monkeypatch):
    """Cells and timers are as many as buckets, not as ids; rows without a time match nothing."""
    monkeypatch.setattr(P, "BUCKETS", 4)
    orders, deliveries = tables(spark, rows)
    times = spark.createDataFrame([*rows, (2, None, 0), (61, None, 0), (61, None, 1)], "id long, t long, side int")
    write_as_files(times, tmp_path / "both", order="t")
    source = [readers.table_stream(spark, str(tmp_path / "both"), times.schema).filter(f"side = {i}") for i in (0, 1)]
    left, right = (s.select(F.col("id").alias(i), F.col("t").alias(t)) for s, i, t in zip(source, "od", ("order_ms", "delivery_ms")))
    streamed = P.match_deliveries(left, right, "o", "d", "order_ms", "delivery_ms", 30, 500, "10 seconds")
    query = streamed.writeStream.format("memory").queryName("by_bucket").trigger(availableNow=True).start()
    query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    timers = [s.customMetrics["numRegisteredTimers"] for s in states]
    assert 0 < max(timers) <= 4
    batch = joins.match_deliveries(orders, deliveries, "o", "d", "order_ms", "delivery_ms", 30, expire_ms=500)
    columns = ["id", "order_ms", "delivery_ms", "status"]
    assert same(spark.table("by_bucket"), batch.withColumnRenamed("o", "id"), *columns)

"""Inputs that once gave wrong results."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.user import Accumulator, accumulate
from tidemark.operators import joins, rolling, stateful, windows
from tidemark.operators.chunks import Fold


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_light_keys_stay_when_a_heavy_one_is_cut(spark, ansi):
    rows = [("heavy", i, i * 10, i * 10 + 5, 5, 1) for i in range(400)] + [("light", i, i * 10, i * 10 + 5, 5, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, i long, s long, e long, d long, t long")
    found = stateful.merge_anchored(df, ["k"], ["i"], "s", "e", "d", "t", rows_per_chunk=50)
    assert {r["k"]: r["count"] for r in found.groupBy("k").count().collect()} == {"heavy": 399, "light": 2}


@pytest.mark.parametrize("rows_per_chunk", [4_000_000, 2])
def test_states_of_any_size(spark, rows_per_chunk):
    far = (1 << 63) - 10
    df = spark.createDataFrame([("k", i, far + i) for i in range(8)], "k string, i long, v long")
    found = stateful.delta_filter(df, ["k"], ["i"], "v", 5, rows_per_chunk=rows_per_chunk)
    assert sorted(r["i"] for r in found.collect()) == [0, 6]


class Count(Accumulator):
    def create(self):
        return 0

    def add(self, n, rows):
        return n + len(rows)

    def merge(self, a, b):
        return a + b

    def result(self, n):
        return n


def test_large_keys_next_to_a_null_stay_apart(spark):
    rows = [(9007199254740993, 1), (9007199254740992, 1), (None, 1), (9007199254740993, 1)]
    df = spark.createDataFrame(rows, "k long, v long").coalesce(1)
    found = {r["k"]: r["result"] for r in accumulate(df, ["k"], ["v"], Count(), "long").collect()}
    assert found == {9007199254740993: 2, 9007199254740992: 1, None: 1}


def test_rows_without_a_time_are_in_no_pane(spark):
    df = spark.createDataFrame([("a", None), ("a", 1000), ("a", 2000)], "k string, t long")
    assert [r["n"] for r in windows.sessions(df, ["k"], "t", 5000).collect()] == [2]
    assert [r["n"] for r in windows.aggregate_tumbling(df, ["k"], "t", 10_000, [windows.count_fold()]).collect()] == [2]
    assert windows.tumbling(df, "t", 1000).count() == 2


def test_ordered_folds_of_a_pane_are_refused(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t long")
    for kind in ("last", "list"):
        with pytest.raises(ValueError):
            windows.sessions(df, ["k"], "t", 10, [Fold("x", kind, F.col("t"))])


def test_buckets_of_large_numbers(spark):
    df = spark.createDataFrame([(1700000000000000123,)], "t long")
    assert df.select(windows.bucket(F.col("t"), 7)).first()[0] == 1700000000000000123 // 7


def test_cells_keep_their_budget_of_pairs(spark):
    n = 3_000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    every = 4
    sizes = [joins._group_sizes(df, ["k"], [i], every, c) for df, i, c in ((left, "l", "__l"), (right, "r", "__r"))]
    grid = {r["k"]: (r["__l"], r["__r"]) for r in joins._grid(*sizes, ["k"], every, 40_000).collect()}
    assert set(grid) == {0}
    assert (n / 3 / grid[0][0]) * (n / 3 / grid[0][1]) < 1.5 * 40_000
    assert joins.salted_join(left, right, ["k"], ["l"], ["r"], pairs_per_cell=40_000).count() == (n // 3) ** 2 + n - n // 3


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("rows_per_chunk", [4_000_000, 20])
def test_elements_of_sessions(spark, keys, rows_per_chunk):
    times = [0, 3, 10, 16, 17, 40, 50, 61, 70] + list(range(100, 400, 3))
    rows = [(k, t, i) for i, (k, t) in enumerate((k, t) for k in ("a", None) for t in times)] + [("a", None, -1)]
    df = spark.createDataFrame(rows, "k string, t long, i long")
    panes = windows.in_sessions(df, keys, "t", 10, rows_per_chunk=rows_per_chunk)
    found = windows.collect_panes(panes, keys, ["t", "i"], F.col("i").cast("string"), part_size=1000, rows_per_chunk=rows_per_chunk)
    got = sorted((r["w_start"], r["w_end"], sorted(map(int, r["items"].split(", ")))) for r in found.collect())
    want = []
    for group in ([["a"], [None]] if keys else [["a", None]]):
        last = None
        for t, i in sorted((t, i) for k, t, i in rows if k in group and t is not None):
            if last is None or t - last > 10:
                want.append([t, 0, []])
            want[-1][1], last = t + 10, t
            want[-1][2].append(i)
    assert got == sorted((s, e, sorted(ids)) for s, e, ids in want)


@pytest.mark.parametrize("rows_per_chunk", [4_000_000, 20])
def test_pairs_of_a_window_are_counted_without_them(spark, rows_per_chunk):
    left = spark.range(200).select((F.col("id") % 2).alias("k"), (F.col("id") * 7 % 90).alias("lt"), F.col("id").alias("l"))
    right = spark.range(150).select((F.col("id") % 3).alias("k"), (F.col("id") * 11 % 90).alias("rt"), F.col("id").alias("r"))
    found = joins.window_pairs(left, right, "k", "lt", "rt", 40, "l", "r", rows_per_chunk=rows_per_chunk)
    pairs = joins.window_join(left, right, "k", "lt", "rt", 40, ["l"], ["r"])
    want = pairs.groupBy("k", "w_start").agg(F.count("*").alias("pairs"), F.sum(F.abs(F.col("lt") - F.col("rt"))).alias("apart_ms"))
    assert found.count() == want.count() and found.exceptAll(want).count() == 0

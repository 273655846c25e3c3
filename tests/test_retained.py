"""What a key retains: first entries, last rows, counts per sub-key, accumulators."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_chunks import data, df, small_chunks  # noqa: F401
from tests.test_user import Mean
from tidemark.functions import user
from tidemark.operators import rolling, triggers
from tidemark.operators.chunks import ROWS_PER_CHUNK


def by_key(rows):
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        found[r[0]].append(r)
    return found.values()


@pytest.mark.parametrize("rows_per_chunk", [7, 50, ROWS_PER_CHUNK])
def test_first_entries_so_far(df, data, small_chunks, rows_per_chunk):  # noqa: F811
    entries = {"low": F.struct("v", "i"), "x": F.when(F.col("c") == "x", F.struct(F.col("v"), (-F.col("i")).alias("j")))}
    found = rolling.rolling_firsts(df, ["k"], ["t", "i"], entries, 3, rows_per_chunk=rows_per_chunk)
    got = {r["i"]: ([tuple(e) for e in r["low"]], [tuple(e) for e in r["x"]]) for r in found.collect()}
    assert len(got) == len(data)

    for rows in by_key(data):
        low, x = [], []
        for _, _, i, v, c in rows:
            low = sorted([*low, (v, i)], key=lambda e: (e[0] is not None, e[0] or 0, e[1]))[:3]
            if c == "x":
                x = sorted([*x, (v, -i)], key=lambda e: (e[0] is not None, e[0] or 0, e[1]))[:3]
            assert got[i] == (low, x)


def test_first_apps_in_any_order_of_arrival(spark):
    # a4 arrives last of the installs, and is the first by event time
    rows = [("s", "a1", 10, 0, "install"), ("s", "a2", 5, 1, "install"), ("s", "a3", 7, 2, "install"),
            ("s", "a4", 1, 3, "install"), ("s", "a1", 11, 4, "other"), ("s", "a2", 5, 5, "install")]
    df = spark.createDataFrame(rows, "store string, app string, at long, arrival long, kind string")  # noqa: F811
    fired = df.filter("arrival in (0, 2, 4, 5)").select("store", "app", "arrival")
    for rows_per_chunk in (1, 1000):
        found = triggers.first_apps_so_far(
            fired, df, "store", "app", ["arrival"], "kind", ["install", "other"], 3, ["at"], rows_per_chunk=rows_per_chunk)
        assert {r["arrival"]: (r["first_install"], r["first_other"]) for r in found.collect()} == {
            0: ("a1", ""), 2: ("a2, a3, a1", ""), 4: ("a4, a2, a3", "a1"), 5: ("a4, a2, a2", "a1")}


@pytest.mark.parametrize("rows_per_chunk", [7, 50, ROWS_PER_CHUNK])
@pytest.mark.parametrize("n", [1, 5, 60])
def test_last_rows(df, data, small_chunks, rows_per_chunk, n):  # noqa: F811
    seen = {"total": F.sum("v"), "least": F.min("v"), "items": F.collect_list("i")}
    found = triggers.last_n(df, ["k"], ["t", "i"], n, seen, rows_per_chunk=rows_per_chunk)
    got = {r["i"]: (r["total"], r["least"], r["items"]) for r in found.collect()}
    assert len(got) == len(data) and found.count() == len(data)
    for rows in by_key(data):
        for at, row in enumerate(rows):
            kept = rows[max(0, at - n) : at + 1]
            values = [r[3] for r in kept if r[3] is not None]
            due = (sum(values) if values else None, min(values, default=None), [r[2] for r in kept])
            assert got[row[2]] == due


@pytest.mark.parametrize("rows_per_chunk", [7, 50, ROWS_PER_CHUNK])
def test_counts_per_sub_key(df, data, small_chunks, rows_per_chunk):  # noqa: F811
    named = df.withColumn("sub", F.concat("c", F.col("v").cast("string")))
    found = rolling.rolling_map_count(named, ["k"], ["t", "i"], "sub", rows_per_chunk=rows_per_chunk)
    shown = found.select("i", F.map_keys("counts").alias("subs"), F.map_values("counts").alias("n"))
    got = {r["i"]: (r["subs"], r["n"]) for r in shown.collect()}
    assert len(got) == len(data)
    for rows in by_key(data):
        counts = Counter()
        for _, _, i, v, c in rows:
            if v is not None:
                counts[f"{c}{v}"] += 1
            assert got[i] == (sorted(counts), [counts[s] for s in sorted(counts)])


def test_very_many_sub_keys(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 20_000).alias("k"), "id", F.concat(F.lit("b"), (F.col("id") % 100_000).cast("string")).alias("button")
    )
    found = rolling.rolling_map_count(rows, ["k"], ["id"], "button")
    last = found.groupBy("k").agg(F.max_by("counts", "id").alias("c"), F.count("*").alias("n"))
    # every user presses five of the 100 000 buttons twice
    assert last.filter("n = 10 and size(c) = 5 and forall(map_values(c), x -> x = 2)").count() == 20_000


def test_accumulators_without_keys_and_with_null_keys(spark, monkeypatch):
    rows = [(None, 1), ("a", 2), (None, 4), ("b", 8), ("a", 16)]
    df = spark.createDataFrame(rows * 40, "k string, cents long").repartition(9)  # noqa: F811
    for fan_in in (1, 2, 1024):
        monkeypatch.setattr(user, "_FAN_IN", fan_in)
        found = user.accumulate(df, ["k"], ["cents"], Mean(), "double", "mean")
        assert {r["k"]: r["mean"] for r in found.collect()} == {None: 2.5, "a": 9.0, "b": 8.0}
        whole = user.accumulate(df, [], ["cents"], Mean(), "double", "mean")
        assert [tuple(r) for r in whole.collect()] == [(6.2,)]
    assert user.accumulate(df.limit(0), [], ["cents"], Mean(), "double").count() == 0
    assert user.accumulate(df.limit(0), ["k"], ["cents"], Mean(), "double").count() == 0


@pytest.mark.parametrize("rows_per_chunk", [7, ROWS_PER_CHUNK])
@pytest.mark.parametrize("lateness", [0, 3000])
def test_panes_that_fire_again(spark, small_chunks, rows_per_chunk, lateness):  # noqa: F811
    import random

    from tidemark.operators.chunks import Fold
    from tidemark.operators.eventtime import refired_panes
    from tidemark.operators.windows import count_fold

    rng = random.Random(5)
    rows = [(i, max(0, i * 100 + rng.randrange(-6000, 300)), rng.choice("ab")) for i in range(400)]
    due, panes, seen = [], defaultdict(list), None
    fired = defaultdict(int)
    for i, t, k in rows:
        end = t // 1000 * 1000 + 1000
        reached = None if seen is None else seen - 500
        seen = t if seen is None else max(seen, t)
        if reached is None or reached < end:
            panes[k, end].append((i, False))
        elif reached < end + lateness:
            panes[k, end].append((i, True))
            fired[k, end] += 1
            ids = [x for x, _ in panes[k, end]]
            due.append((k, end, fired[k, end], i, len(ids), sum(ids)))
    for (k, end), found in panes.items():
        ids = [x for x, late in found if not late]
        if ids:
            due.append((k, end, 0, None, len(ids), sum(ids)))
    df = spark.createDataFrame(rows, "i long, t long, k string").repartition(3)  # noqa: F811
    out = refired_panes(df, ["k"], ["i"], "t", 1000, 500, lateness, [count_fold(), Fold("ids", "sum", F.col("i"))],
                        rows_per_chunk=rows_per_chunk)
    got = [(r["k"], r["w_end"], r["firing"], r["i"], r["n"], r["ids"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(due, key=str)
    assert any(f for _, _, f, *_ in due) == (lateness > 0)

"""Chunked results equal those of plain Python on skewed rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks, joins, rolling, stateful
from tidemark.operators import windows as W
from tidemark.operators.chunks import CHUNK, LAST_CHUNK, Fold

ROWS = 1500


@pytest.fixture(scope="module")
def data():
    """Half of the rows have one key, some have none; values and times repeat."""
    rng = random.Random(7)
    keys = [rng.choice(["hot"] * 10 + ["a", "b", "c", None] * 2) for _ in range(ROWS)]
    times = sorted(rng.randrange(0, 4000) for _ in range(ROWS))
    return [
        (k, t, i, rng.choice([None, *range(-20, 21)]), rng.choice("xxy"))
        for i, (k, t) in enumerate(zip(keys, times))
    ]


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(
        data, "k string, t bigint, i bigint, v bigint, c string"
    ).repartition(5)


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(chunks, "SAMPLES_PER_CHUNK", 8)
    monkeypatch.setattr(joins, "SAMPLES_PER_CHUNK", 8)
    return {"rows_per_chunk": 50}


def test_chunks_are_balanced_and_in_order(df, small_chunks):
    tagged, split = chunks.tag_chunks(df, ["k"], ["t", "i"], 50)
    assert split
    rows = sorted((r for r in tagged.collect() if r.k == "hot"), key=lambda r: (r.t, r.i))
    numbers = [r[CHUNK] for r in rows]
    assert numbers == sorted(numbers)
    sizes = defaultdict(int)
    for n in numbers:
        sizes[n] += 1
    assert len(sizes) > 5 and max(sizes.values()) < 250
    assert {r[LAST_CHUNK] for r in rows} == {max(numbers)}


def reference_folds(data, keyed, exclusive):
    out, seen = {}, defaultdict(list)
    for k, t, i, v, c in sorted(data, key=lambda r: (r[1], r[2])):
        group = seen[k if keyed else 0]
        if not exclusive:
            group.append(v)
        known = [x for x in group if x is not None]
        out[i] = (
            len(known), sum(known) if known else None,
            min(known, default=None), max(known, default=None),
            known[-1] if known else None, known,
        )
        if exclusive:
            group.append(v)
    return out


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("exclusive", [True, False])
def test_running_folds(df, data, small_chunks, keyed, exclusive):
    kinds = ["count", "sum", "min", "max", "last", "list"]
    out = chunks.running(
        df, ["k"] if keyed else [], ["t", "i"],
        [Fold(f"f_{kind}", kind, F.col("v")) for kind in kinds],
        exclusive=exclusive, costly=True, **small_chunks,
    )
    found = {r.i: tuple(r[f"f_{kind}"] for kind in kinds) for r in out.collect()}
    assert found == reference_folds(data, keyed, exclusive)


@pytest.mark.parametrize("keyed", [True, False])
def test_running_reduce(df, data, small_chunks, keyed):
    """Function composition: associative, but not commutative."""

    def compose(a, b):
        return "".join(a[int(x)] for x in b)

    rows = df.withColumn(
        "f", F.when(F.col("v").isNotNull(), F.element_at(
            F.array(*[F.lit(x) for x in ("120", "021", "101", "202")]),
            (F.pmod("v", F.lit(4)) + 1).cast("int"))))
    codes = ("120", "021", "101", "202")
    expected, total = {}, {}
    for k, t, i, v, c in sorted(data, key=lambda r: (r[1], r[2])):
        key = k if keyed else 0
        if v is not None:
            f = codes[v % 4]
            total[key] = compose(total[key], f) if key in total else f
        expected[i] = total.get(key)
    for options in ({}, small_chunks):
        out = rolling.rolling_reduce(
            rows, ["k"] if keyed else [], ["t", "i"], "f", rolling.of_values(compose), **options)
        assert {r.i: r.reduced for r in out.collect()} == expected


@pytest.mark.parametrize("include_open", [True, False])
def test_runs(df, data, small_chunks, include_open):
    expected, open_run = [], {}
    for k, t, i, v, c in sorted(data, key=lambda r: (r[1], r[2])):
        run = open_run.get(k)
        if run and run[1] == c:
            open_run[k] = (k, c, run[2], max(run[3], t + 5), run[4] + 1)
        else:
            if run:
                expected.append(run)
            open_run[k] = (k, c, t, t + 5, 1)
    if include_open:
        expected += open_run.values()
    rows = df.withColumns({"e": F.col("t") + 5, "d": F.lit(1).cast("bigint")})
    out = stateful.merge_runs(
        rows, ["k"], ["t", "i"], "c", "t", "e", "d", include_open=include_open, **small_chunks
    )
    key = lambda r: (str(r[0]), *r[1:])
    found = [(r.k, r.c, r.t, r.e, r.d) for r in out.collect()]
    assert sorted(found, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("limit", [0, 5, 15, 50])
def test_delta_filter(df, data, small_chunks, limit):
    expected, last = set(), defaultdict(int)
    for k, t, i, v, c in sorted(data, key=lambda r: (r[1], r[2])):
        if v is not None and (v == 0 or abs(v - last[k]) > limit):
            expected.add(i)
            last[k] = v
    plain = stateful.delta_filter(df, ["k"], ["t", "i"], "v", limit)
    split = stateful.delta_filter(df, ["k"], ["t", "i"], "v", limit, **small_chunks)
    assert {r.i for r in plain.collect()} == expected
    assert {r.i for r in split.collect()} == expected


def test_jumps_match_a_walk():
    rng = random.Random(4)
    for spread in (3, 20, 1 << 62):
        for _ in range(150):
            limit = rng.randrange(0, 8)
            values = np.array([rng.choice([0, rng.randrange(-spread, spread + 1)]) if rng.random() < 0.3
                               else rng.randrange(-spread, spread + 1) for _ in range(rng.randrange(1, 60))])
            opening = np.array([0, *sorted(rng.sample(range(1, len(values)), min(len(values) - 1, 3)))])
            states = np.array([rng.randrange(-spread, spread + 1) for _ in opening])
            due, last = [], 0
            for i, v in enumerate(values.tolist()):
                if i in opening:
                    last = int(states[list(opening).index(i)])
                due.append(v == 0 or abs(v - last) > limit)
                last = v if due[-1] else last
            assert stateful.Jumps(values, opening, limit).kept(states).tolist() == due


def test_state_steps_match_a_walk():
    rng = random.Random(3)
    for _ in range(300):
        limit = rng.randrange(0, 8)
        values = [rng.randrange(-15, 16) or rng.choice([0, 1]) for _ in range(rng.randrange(1, 30))]
        steps = stateful.StateSteps(limit)
        cut = rng.randrange(0, len(values))
        for part in (values[:cut], values[cut:]):
            if part:
                steps.add(np.array(part))
        pieces = list(steps.steps())
        for state in range(-40, 41):
            last = state
            for v in values:
                if v == 0 or abs(v - last) > limit:
                    last = v
            matching = [out for low, high, out in pieces if low <= state <= high]
            assert len(matching) == 1
            assert last == (state if matching[0] is None else matching[0])


@pytest.mark.parametrize("step", [1, 7])
def test_anchored_merge(spark, small_chunks, step):
    rng = random.Random(step)
    data, clock = [], 0
    for i in range(900):
        clock += rng.choice([0, 1, 2]) if step > 1 else 1
        key = rng.choice(["hot", "hot", "a", "b"]) if step > 1 else "hot"
        data.append((key, i, clock, clock + rng.choice([0, 1, 2, 3, 10][: 5 if step > 1 else 2]), rng.randrange(100)))
    expected, anchors = {}, {}
    for k, i, s, e, c in data:
        if k not in anchors:
            anchors[k] = (s, e, e - s, c)
            continue
        record = (s, e, e - s, c)
        a = anchors[k]
        if s == a[1]:
            record = (a[0], e, a[2] + e - s, min(a[3], c))
            anchors[k] = record
        expected[i] = (k, *record)
    df = spark.createDataFrame(
        [(k, i, s, e, e - s, c) for k, i, s, e, c in data],
        "k string, i bigint, s bigint, e bigint, d bigint, c bigint",
    ).repartition(4)
    for options in ({}, small_chunks):
        out = stateful.merge_anchored(df, ["k"], ["i"], "s", "e", "d", "c", **options)
        assert {r.i: (r.k, r.s, r.e, r.d, r.c) for r in out.collect()} == expected
    if step == 1:
        assert any(r[1] == 0 for r in expected.values()) or expected


def test_an_anchor_through_a_thousand_chunks(spark, tiny_chunks, monkeypatch):
    """Every record is a chunk; the anchor is extended by every third, others stand in between."""
    rounds = []
    monkeypatch.setattr(stateful, "cut_lineage", lambda df, cut=stateful.cut_lineage: rounds.append(1) or cut(df))
    rows, end = [], 0
    for i in range(1200):
        if i % 3 == 0:
            rows.append(("k", i, end, end + i % 5 + 1, i % 5 + 1, 2000 - i))
            end += i % 5 + 1
        else:
            rows.append(("k", i, -i, end if i % 3 == 1 else -i - 1, 1, 1))
    df = spark.createDataFrame(rows, "k string, i bigint, s bigint, e bigint, d bigint, c bigint")
    out = stateful.merge_anchored(df, ["k"], ["i"], "s", "e", "d", "c", rows_per_chunk=1)
    last = {r.i: (r.s, r.e, r.d, r.c) for r in out.collect()}
    assert len(last) == 1199 and last[1197] == (0, end, end, 2000 - 1197)
    assert last[1198] == (-1198, end, 1, 1)
    assert len(rounds) <= 2 * 11 + 4


def test_salted_join_meets_every_pair_once(df, data, small_chunks):
    left = df.select("k", F.col("i").alias("l"))
    right = df.filter("i % 3 = 0").select("k", F.col("i").alias("r"))
    out = joins.salted_join(left, right, ["k"], ["l"], ["r"], pairs_per_cell=2_500)
    expected = defaultdict(int)
    for a in data:
        for b in data:
            if b[2] % 3 == 0 and a[0] is not None and a[0] == b[0]:
                expected[a[0]] += 1
    pairs = out.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("l", "r").alias("d"))
    assert {r.k: (r.n, r.d) for r in pairs.collect()} == {k: (n, n) for k, n in expected.items()}


@pytest.mark.parametrize("gap", [1, 5, 60])
def test_sessions(df, data, small_chunks, gap):
    expected, current = [], {}
    for k, t, i, v, c in sorted(data, key=lambda r: (r[1], r[2])):
        s = current.get(k)
        if s and t - s[2] <= gap:
            current[k] = (k, s[1], t, s[3] + 1)
        else:
            if s:
                expected.append(s)
            current[k] = (k, t, t, 1)
    expected += current.values()
    expected = sorted(((k, a, b + gap, n) for k, a, b, n in expected), key=str)
    for options in ({}, small_chunks):
        out = W.sessions(df, ["k"], "t", gap, **options)
        assert sorted([(r.k, r.w_start, r.w_end, r.n) for r in out.collect()], key=str) == expected


def test_parts_of_a_large_pane(df, data, small_chunks):
    panes = W.tumbling(df, "t", 2000)
    out = W.collect_panes(
        panes, ["k"], ["t", "i"], F.col("i").cast("string"), part_size=100, **small_chunks
    )
    listed = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: r.part):
        assert r.n_items <= 100
        listed[(r.k, r.w_start)] += [int(x) for x in r["items"].split(", ")]
        assert r.n_upto == len(listed[(r.k, r.w_start)])
    expected = defaultdict(list)
    for k, t, i, v, c in sorted(data, key=lambda r: (r[1], r[2])):
        expected[(k, t // 2000 * 2000)].append(i)
    assert listed == expected

"""Operators on the small inputs with known results (FIXTURES.md)."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions import schemas
from tidemark.operators import eventtime, joins, rolling, stateful, triggers
from tidemark.operators import windows as W
from tidemark.operators.chunks import Fold
from tidemark.sources import readers

pytestmark = pytest.mark.usefixtures("tiny_chunks")

T0 = 1689379200000
SEC = 1000


def make(spark, names, data):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{names}, arrival bigint")


def got(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def at(seconds):
    return [s * SEC for s in seconds]


def test_filters(spark):
    df = make(spark, "n int", [(1,), (2,), (3,), (4,), (5,)])
    assert sorted(got(df.filter(F.col("n") % 2 != 0), "n")) == [(1,), (3,), (5,)]
    df = make(spark, "n int", [(1,), (-2,), (-3,), (4,), (5,)])
    assert sorted(got(df.filter("n > 0"), "n")) == [(1,), (4,), (5,)]
    assert sorted(got(df.filter(F.col("n") % 2 != 0), "n")) == [(-3,), (1,), (5,)]


SENTENCES = [
    ("The river community is excited to announce the opening of Mill Park!",),
    ("This opening focuses on widening the river and its paths.",),
    ("Visitors now find thirty three benches,",),
    ("making it a more pleasant park for longer walks.",),
]


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_rolling_articles(spark, rows_per_chunk):
    df = make(spark, "text string", SENTENCES)
    words = df.select("arrival", F.posexplode(S.lower_split(F.col("text"))).alias("pos", "word"))
    out = rolling.rolling_count(
        words.filter(F.col("word").isin("the", "a")), ["word"], ["arrival", "pos"],
        rows_per_chunk=rows_per_chunk,
    )
    assert sorted(got(out, "word", "n")) == [("a", 1), ("the", 1), ("the", 2), ("the", 3)]


def test_rolling_concat(spark):
    df = make(
        spark, "lang string, text string",
        [("en", "car, bus, "), ("ru", "машина, "), ("en", "course, "), ("en", "house, ")],
    )
    out = rolling.rolling_concat(df, ["lang"], ["arrival"], F.col("text"))
    expected = [
        ("en", "car, bus, "), ("en", "car, bus, course, "),
        ("en", "car, bus, course, house, "), ("ru", "машина, "),
    ]
    assert sorted(got(out, "lang", "texts")) == expected
    for rows_per_chunk in (1_000, 1):
        out = rolling.rolling_reduce(
            df, ["lang"], ["arrival"], "text", lambda a, b: a + b, rows_per_chunk=rows_per_chunk)
        assert sorted(got(out, "lang", "reduced")) == expected


def test_rolling_map(spark):
    df = make(spark, "k string, b string", [("u", "x"), ("u", "a"), ("u", "x"), ("v", "x")])
    for rows_per_chunk in (1_000, 1):
        out = rolling.rolling_map_count(df, ["k"], ["arrival"], "b", rows_per_chunk=rows_per_chunk)
        out = out.select("arrival", rolling.format_map(F.col("counts")).alias("t"))
        assert sorted(got(out, "arrival", "t")) == [(0, "x=1"), (1, "a=1, x=1"), (2, "a=1, x=2"), (3, "x=1")]


def test_tumbling_counts(spark):
    df = make(spark, "t bigint", [(t,) for t in (1000, 2000, 6000, 9000, 9600, 10000)])
    out = W.aggregate_tumbling(df, [], "t", 2000, [W.count_fold()])
    assert sorted(got(out, "w_start", "n")) == [(0, 1), (2000, 1), (6000, 1), (8000, 2), (10000, 1)]


def test_sliding_not_divisible(spark):
    df = make(spark, "t bigint", [(t,) for t in (2000, 4000, 8000, 9000)])
    panes = W.sliding(df, "t", 5000, 3000)
    out = W.collect_panes(panes, [], ["arrival"], F.col("t").cast("string"))
    assert sorted(got(out, "w_start", "w_end", "items")) == [
        (0, 5000, "2000, 4000"), (3000, 8000, "4000"),
        (6000, 11000, "8000, 9000"), (9000, 14000, "9000"),
    ]
    out = W.aggregate_sliding(df, [], "t", 5000, 3000, [W.count_fold()])
    assert sorted(got(out, "w_start", "n")) == [(0, 2), (3000, 1), (6000, 2), (9000, 1)]


def test_sliding_with_gaps_between_panes(spark):
    df = make(spark, "t bigint", [(t,) for t in range(-3000, 9000, 500)])
    panes = W.sliding(df, "t", 2000, 3000).groupBy("w_start").agg(F.count("*").alias("n"))
    sliced = W.aggregate_sliding(df, [], "t", 2000, 3000, [W.count_fold()])
    expected = [(-3000, 4), (0, 4), (3000, 4), (6000, 4)]
    assert sorted(got(panes, "w_start", "n")) == expected
    assert sorted(got(sliced, "w_start", "n")) == expected


SESSION_CASES = [
    (at([1, 2, 4, 8]), 2000, [(1000, 6000, 3), (8000, 10000, 1)]),
    (
        at([1, 1, 1, 2, 2, 3, 4, 4, 4, 8, 8, 9, 10, 11, 11, 12, 12, 18]),
        3000,
        [(1000, 7000, 9), (8000, 15000, 8), (18000, 21000, 1)],
    ),
]


@pytest.mark.parametrize("times,gap,expected", SESSION_CASES)
@pytest.mark.parametrize("options", [{}, {"rows_per_chunk": 1}])
def test_sessions(spark, times, gap, expected, options):
    df = make(spark, "t bigint", [(t,) for t in times])
    out = W.sessions(df, [], "t", gap, **options)
    assert sorted(got(out, "w_start", "w_end", "n")) == expected
    keyed = df.withColumn("k", F.lit(None).cast("string"))
    out = W.sessions(keyed, ["k"], "t", gap, **options)
    assert sorted(got(out, "w_start", "w_end", "n")) == expected


def test_pane_aggregates(spark):
    df = make(
        spark, "t bigint, name string, value int",
        [(1000, "kA/SA1", -1), (1000, "kB", 12), (2000, "kC", 0),
         (6000, "kA", 100), (7000, "kC/SC9.6", -12), (8000, "kD", 150)],
    )
    folds = W.min_max_folds(F.col("value"))
    assert sorted(got(W.aggregate_tumbling(df, [], "t", 3000, folds), "w_start", "low", "high")) == [
        (0, -1, 12), (6000, -12, 150)]
    means = sorted(got(W.average_tumbling(df, [], "t", 3000, F.col("value")), "w_start", "mean"))
    assert [round(m, 4) for _, m in means] == [3.6667, 79.3333]
    low = W.extreme_tumbling(df, [], "t", 3000, F.col("value"), ["t", "arrival"], ["name"], False)
    assert sorted(got(low, "w_start", "name")) == [(0, "kA/SA1"), (6000, "kC/SC9.6")]


def test_extremes_prefer_the_earlier_on_ties(spark):
    df = make(spark, "t bigint, name string, v int", [(1, "a", 5), (2, "b", 5), (3, "c", 5)])
    for largest in (True, False):
        out = W.extreme_tumbling(df, [], "t", 10, F.col("v"), ["t", "arrival"], ["name"], largest)
        assert got(out, "name") == [("a",)]


JOIN_LEFT = [("B", t) for t in (2000, 3000, 8000, 10000)]
JOIN_RIGHT = [("B", 1000, "B1-1"), ("B", 1000, "B1-2"), ("B", 2000, "B2"), ("B", 5000, "B5"), ("B", 10000, "B10")]


@pytest.mark.parametrize("pairs_per_cell", [1_000_000, 1])
def test_interval_join(spark, pairs_per_cell):
    left = make(spark, "k string, lt bigint", JOIN_LEFT).withColumnRenamed("arrival", "la")
    right = make(spark, "k string, rt bigint, name string", JOIN_RIGHT).withColumnRenamed("arrival", "ra")
    out = joins.interval_join(
        left, right, "k", "lt", "rt", -2000, 1000, ["la"], ["ra"], pairs_per_cell=pairs_per_cell
    )
    assert sorted(got(out, "lt", "name", "joined_ts")) == [
        (2000, "B1-1", 2000), (2000, "B1-2", 2000), (2000, "B2", 2000),
        (3000, "B1-1", 3000), (3000, "B1-2", 3000), (3000, "B2", 3000),
        (10000, "B10", 10000),
    ]


WINDOW_A = [("kA", 1000, "SA1-1"), ("kB", 1000, "SA2-1"), ("kC", 1000, "SA3-1"),
            ("kA", 3000, "SA4-3"), ("kC", 3000, "SA5-3"), ("kC", 2000, "SA6-2")]
WINDOW_B = [("kA", 0, "SB1-0"), ("kB", 0, "SB2-0"), ("kA", 0, "SB6-0"),
            ("kC", 1000, "SB3-1"), ("kC", 3000, "SB4-3"), ("kA", 4000, "SB5-4")]
WINDOW_PAIRS = [("SA1-1", "SB1-0"), ("SA1-1", "SB6-0"), ("SA2-1", "SB2-0"),
                ("SA3-1", "SB3-1"), ("SA5-3", "SB4-3"), ("SA6-2", "SB4-3")]


def test_window_join(spark):
    a = make(spark, "k string, at bigint, a string", WINDOW_A).drop("arrival")
    b = make(spark, "k string, bt bigint, b string", WINDOW_B).drop("arrival")
    out = joins.window_join(a, b, "k", "at", "bt", 2000, ["a"], ["b"])
    assert sorted(got(out, "a", "b")) == WINDOW_PAIRS


REGIONS = [("D", t, c) for t, c in ((1000, 4), (1000, 10), (2100, 0), (3000, 2), (6700, 1), (8000, 3), (8400, 14))] + [
    ("I", t, c) for t, c in ((1000, 6), (1200, 7), (1800, 12), (1500, 4), (2000, 1), (6000, 8),
                             (6000, 1), (7200, 5), (8100, 6), (9000, 2), (9000, 4))]
REGION_RANGES = {
    "D": {0: (4, 10), 1000: (0, 10), 2000: (0, 2), 3000: (2, 2), 5000: (1, 1), 6000: (1, 1),
          7000: (3, 14), 8000: (3, 14)},
    "I": {0: (4, 12), 1000: (1, 12), 2000: (1, 1), 5000: (1, 8), 6000: (1, 8), 7000: (5, 6),
          8000: (2, 6), 9000: (2, 4)},
}


def test_sliding_min_max_by_region(spark):
    df = make(spark, "region string, t bigint, n int", REGIONS)
    out = W.aggregate_sliding(df, ["region"], "t", 2000, 1000, W.min_max_folds(F.col("n")))
    found = {}
    for region, start, low, high in got(out, "region", "w_start", "low", "high"):
        found.setdefault(region, {})[start] = (low, high)
    assert found == REGION_RANGES


PANE_TIMES = (1000, 1500, 1700, 2000, 2100, 3000, 4000, 7000, 8000, 8700)


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_count_trigger_and_side_output(spark, rows_per_chunk):
    df = make(spark, "t bigint", [(t,) for t in PANE_TIMES])
    panes = W.tumbling(df, "t", 3000)
    out = triggers.every_nth(
        panes, [], ["arrival"], 2, F.col("t"), rows_per_chunk=rows_per_chunk
    )
    assert sorted(got(out, "w_start", "n_so_far", F.size("items"))) == [
        (0, 2, 2), (0, 4, 4), (3000, 2, 2), (6000, 2, 2)]
    counts = W.aggregate_tumbling(df, [], "t", 3000, [W.count_fold()])
    main, tagged = eventtime.side_output(counts, F.col("n") > 3)
    assert sorted(got(main, "w_start", "n")) == [(0, 5), (3000, 2), (6000, 3)]
    assert got(tagged, "w_start") == [(0,)]


CLICKS = [1, 1, 1, 2, 3, 3, 4, 4, 4, 4, 5, 6, 6, 7, 8, 9, 10, 11, 12]


def test_chained_windows(spark):
    df = make(spark, "t bigint", [(t,) for t in at([*CLICKS, 12])])
    panes = W.aggregate_sliding(df, [], "t", 2000, 1000, [W.count_fold()])
    counts = [n for _, n in sorted(got(panes, "w_start", "n"))]
    assert counts == [3, 4, 3, 6, 5, 3, 3, 2, 2, 2, 2, 3, 2]
    out = W.peak_pane(panes, 60_000, "n")
    assert got(out, "w_start", "w_end", "n") == [(3000, 5000, 6)]


DYNAMIC = [(3, 1000, 3000, 4)] + [(n, 3000, 5000, 6) for n in (5, *range(6, 15))]


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_dynamic_trigger(spark, rows_per_chunk):
    df = make(spark, "t bigint", [(t,) for t in at([*CLICKS, 13])])
    panes = W.aggregate_sliding(df, [], "t", 2000, 1000, [W.count_fold()])
    out = triggers.dynamic_peak(panes, "n", rows_per_chunk=rows_per_chunk)
    assert sorted(got(out, "pane_number", "peak_start", "peak_end", "peak_count")) == DYNAMIC


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


DELIVERIES = [
    ("aaaaa", "2023-06-15T12:07:13", "2023-06-16T14:11:54", "on_time"),
    ("bbbbb", "2023-06-19T23:15:44", "2023-06-25T18:04:40", "late"),
    ("ccccc", "2023-06-03T14:35:05", "2023-06-05T17:17:36", "on_time"),
    ("ddddd", "2023-07-01T00:18:34", "2023-07-04T02:18:34", "late"),
    ("eeeee", "2023-06-30T13:55:21", "2023-06-02T03:42:11", "on_time"),
]
THREE_DAYS = 3 * 24 * 3600 * 1000


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_delivery_deadlines(spark, rows_per_chunk):
    orders = spark.createDataFrame([(i, ms(o)) for i, o, _, _ in DELIVERIES], "id string, order_ms bigint")
    sent = spark.createDataFrame([(i, ms(d)) for i, _, d, _ in DELIVERIES], "order_id string, delivery_ms bigint")
    out = joins.match_deliveries(
        orders, sent, "id", "order_id", "order_ms", "delivery_ms", THREE_DAYS,
        rows_per_chunk=rows_per_chunk,
    )
    assert sorted(got(out, "id", "status")) == [(i, s) for i, _, _, s in DELIVERIES]
    assert sorted(got(out, "status", "class_number", "id")) == [
        ("late", 1, "bbbbb"), ("late", 2, "ddddd"),
        ("on_time", 1, "eeeee"), ("on_time", 2, "ccccc"), ("on_time", 3, "aaaaa")]


def test_csv(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("first record,1\nsecond record,2\n")
    df = readers.csv(spark, str(path), schemas.CSV_SAMPLE)
    assert sorted(got(df, "value", "id")) == [("first record", 1), ("second record", 2)]
    path.write_text("first record,x\n")
    with pytest.raises(Exception):
        readers.csv(spark, str(path), schemas.CSV_SAMPLE).collect()


NIGHTS = [
    ("2019-11-23T23:35:41", "2019-11-24T08:01:06"),
    ("2019-11-25T00:02:41", "2019-11-25T07:48:21"),
    ("2019-11-26T00:06:20", "2019-11-26T08:15:48"),
]


def test_rest_by_weekday(spark):
    from tidemark.plans.usage import mean_hours_by_weekday

    df = spark.createDataFrame(
        [(ms(a), ms(b) - ms(a)) for a, b in NIGHTS], "start_ms bigint, duration_ms bigint"
    )
    out = mean_hours_by_weekday(df)
    assert {d: round(h, 4) for d, h in got(out, "weekday", "mean_hours")} == {
        "SATURDAY": 8.4236, "MONDAY": 7.7611, "TUESDAY": 8.1578}


def test_long_usage(spark):
    df = spark.createDataFrame(
        [("Instagram", 1574634735000, (31 * 60 + 44) * 1000), ("Phone", 1574634735000, 29 * 60 * 1000)],
        "app string, t bigint, d bigint",
    )
    long_use = df.filter(F.col("d") >= 30 * 60 * 1000)
    assert got(long_use, "app") == [("Instagram",)]
    assert W.sliding(long_use, "t", 3_600_000, 60_000).count() == 60


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_delta_filter(spark, rows_per_chunk):
    df = make(spark, "k string, n int", [("a", n) for n in (3, 7, 9, 0, 6, 12)])
    out = stateful.delta_filter(df, ["k"], ["arrival"], "n", rows_per_chunk=rows_per_chunk)
    assert [n for _, n in sorted(got(out, "arrival", "n"))] == [7, 0, 6, 12]


THRESHOLD_ROWS = [("s", a, e) for a, e in (
    ("a", "install"), ("a", "install"), ("a", "install"), ("b", "install"),
    ("a", "page_view"), ("b", "uninstall"), ("b", "error"))]


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_threshold_trigger(spark, rows_per_chunk):
    df = make(spark, "store string, app string, type string", THRESHOLD_ROWS)
    options = {"installs": 2, "uninstalls": 1, "rows_per_chunk": rows_per_chunk}
    fired = triggers.over_threshold(df, "store", "app", ["arrival"], F.col("type"), **options)
    assert sorted(got(fired, "arrival")) == [(2,), (4,), (6,)]
    first = triggers.first_apps_so_far(
        fired, df, "store", "app", ["arrival"], "type", ["install", "uninstall"])
    assert sorted(got(first, "arrival", "first_install", "first_uninstall")) == [
        (2, "a, a, a", ""), (4, "a, a, a", ""), (6, "a, a, a", "b")]
    edges = triggers.over_threshold(
        df, "store", "app", ["arrival"], F.col("type"), edge_only=True, **options)
    assert sorted(got(edges, "arrival")) == [(2,), (6,)]


RUNS = [("d", "A", 0, 10), ("d", "A", 10, 20), ("d", "B", 30, 40), ("d", "A", 50, 60)]


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_merge_runs(spark, rows_per_chunk):
    df = make(spark, "dev string, cat string, s bigint, e bigint", RUNS)
    df = df.withColumn("d", F.col("e") - F.col("s"))
    args = (df, ["dev"], ["arrival"], "cat", "s", "e", "d")
    out = stateful.merge_runs(*args, rows_per_chunk=rows_per_chunk)
    assert sorted(got(out, "cat", "s", "e", "d")) == [("A", 0, 20, 20), ("B", 30, 40, 10)]
    out = stateful.merge_runs(*args, include_open=True, rows_per_chunk=rows_per_chunk)
    assert sorted(got(out, "cat", "s", "e", "d")) == [
        ("A", 0, 20, 20), ("A", 50, 60, 10), ("B", 30, 40, 10)]


ADJACENT = [(0, 5), (5, 9), (20, 25), (9, 12)]


@pytest.mark.parametrize("rows_per_chunk", [1_000, 1])
def test_merge_adjacent(spark, rows_per_chunk):
    df = make(spark, "k int, s bigint, e bigint", [(1, *p) for p in ADJACENT])
    df = df.withColumns({"d": F.col("e") - F.col("s"), "c": F.col("s").cast("int")})
    out = stateful.merge_anchored(
        df, ["k"], ["arrival"], "s", "e", "d", "c", rows_per_chunk=rows_per_chunk)
    assert [r[1:] for r in sorted(got(out, "arrival", "s", "e", "d", "c"))] == [
        (0, 9, 9, 0), (20, 25, 5, 20), (0, 12, 12, 0)]
    out = stateful.merge_chains(
        df, ["k"], ["s", "arrival"], "s", "e", "d", "c", rows_per_chunk=rows_per_chunk)
    assert sorted(got(out, "s", "e", "d")) == [(0, 12, 12), (20, 25, 5)]


def test_decode_message(spark):
    df = spark.createDataFrame([(bytearray(b"x,1,2,3,pv,2017-11-27"),)], "value binary")
    out = readers.decode_csv_value(df, schemas.USER_BEHAVIOR)
    assert got(out, "*") == [(1, 2, 3, "pv", "2017-11-27")]
    for bad in (b"x,one,2,3,pv,2017", b"x,1,2"):
        df = spark.createDataFrame([(bytearray(bad),)], "value binary")
        with pytest.raises(Exception, match="is not"):
            readers.decode_csv_value(df, schemas.USER_BEHAVIOR).collect()


def test_part_of_day(spark):
    cases = {0: "night", 14399: "night", 14400: "morning", 43200: "day", 61200: "evening", 86399: "evening"}
    df = spark.createDataFrame([(s,) for s in cases], "s bigint")
    assert dict(got(df, "s", S.part_of_day(F.col("s")))) == cases


def test_text_split_drops_trailing_empties_only(spark):
    df = spark.createDataFrame([("x y. ",), ("!a b",), ("!!",), ("",)], "t string")
    out = [r[0] for r in got(df, S.lower_split(F.col("t")))]
    assert out == [["x", "y"], ["", "a", "b"], [], [""]]


def test_time_text(spark):
    df = spark.createDataFrame([("23/11/2019", "23:35:41", "26:00:05")], "d string, t string, h string")
    row = df.select(
        S.parse_date_time(F.col("d"), F.col("t")).alias("ms"), S.parse_hms(F.col("h")).alias("span")
    ).first()
    assert (row.ms, row.span) == (ms("2019-11-23T23:35:41"), (26 * 3600 + 5) * 1000)
    df = spark.createDataFrame([(row.ms,)], "ms bigint")
    assert got(
        df, S.weekday_name(F.col("ms")), S.format_hms(S.seconds_of_day(F.col("ms"))),
        S.format_instant(S.deadline(S.parse_instant(F.lit("2023-06-15T12:07:13Z")), 60)),
        S.to_hours(F.lit(5_400_000)), S.to_seconds(F.lit(1999)),
        S.differs_by_more(F.lit(1), F.lit(7), 5), S.smaller(F.lit(1), F.lit(2)),
        S.larger(F.lit(1), F.lit(2)), S.before(F.lit(1), F.lit(2)),
    ) == [("SATURDAY", "23:35:41", "2023-06-15T12:08:13Z", 1.5, 1, True, 1, 2, True)]


def test_raw_usage_to_rest(spark, tmp_path):
    from tidemark.plans import usage

    path = tmp_path / "usage.csv"
    path.write_text(
        "Screen off (locked),23/11/2019,23:00:00,5:00:00\n"
        "Screen off,24/11/2019,04:00:00,1:00:00\n"
        "Phone,24/11/2019,05:00:00,0:10:00\n"
        "Screen off,24/11/2019,05:10:00,4:00:00\n"
        "Phone,24/11/2019,09:10:00,0:10:00\n"
        "Screen off,24/11/2019,23:00:00,3:00:00\n"
        "Phone,25/11/2019,02:00:00,0:10:00\n"
    )
    raw = readers.csv(spark, str(path), schemas.RAW_USAGE).withColumn("device", F.lit("d1"))
    typed = usage.typed_usage(raw)
    rest = usage.rest_periods(typed, "device", ["start_ms"])
    assert got(rest, "start_ms", "duration_ms") == [(ms("2019-11-24T05:10:00"), 4 * 3_600_000)]
    chained = usage.rest_periods(typed, "device", ["start_ms"], merge="chain")
    assert sorted(got(chained, "duration_ms")) == [(4 * 3_600_000,), (6 * 3_600_000,)]
    assert got(usage.mean_start(rest), "mean_start") == [("05:10:00",)]
    assert [h for (h,) in got(usage.mean_hours(rest), "mean_hours")] == [4.0]


def test_late_rows(spark):
    df = make(spark, "t bigint", [(t,) for t in (1000, 8000, 500, 9000, 700, 20000)])
    for rows_per_chunk in (1_000, 1):
        marked = eventtime.with_lateness(
            df, ["arrival"], "t", 2000, 1000, rows_per_chunk=rows_per_chunk)
        on_time, late = eventtime.split_late(marked)
        assert sorted(got(late, "arrival")) == [(2,), (4,)]
        assert on_time.count() == 4


def test_rows_and_time_columns(spark):
    start = datetime(2023, 7, 15)
    clicks = readers.rows(
        spark, [("u", start + timedelta(seconds=s)) for s in (1, 2)], schemas.CLICK)
    assert clicks.columns == ["user_id", "click_time", "arrival"]
    out = W.stream_panes(clicks, [], "click_time", "2 seconds").count()
    assert sorted(got(out, *W.pane_bounds(), "count")) == [(T0, T0 + 2000, 1), (T0 + 2000, T0 + 4000, 1)]


def test_generated_rows(spark):
    df = readers.generated_table(spark, 2_000)
    stats = df.agg(F.min("rating"), F.max("rating"), F.countDistinct("id"), F.avg(F.col("subscription").cast("int"))).first()
    assert stats[0] >= 1 and stats[1] <= 100 and stats[2] == 2_000 and 0.4 < stats[3] < 0.6
    assert sorted(df.collect()) == sorted(df.repartition(7).collect())
    assert Fold("x", "sum", F.lit(1)).kind == "sum"

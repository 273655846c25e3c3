"""Streaming twins give what the static operators give."""

import os
import shutil
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions import schemas
from tidemark.operators import eventtime, joins, rolling, stateful, triggers
from tidemark.operators import windows as W
from tidemark.plans import usage
from tidemark.plans.inputs import HOUR, ORDER, events
from tidemark.sources import readers, sinks
from tidemark.streaming import processors as P
from tidemark.streaming.late import LateSplit

FILES = 3


def write_as_files(df, target, files=FILES, order="event_id"):
    df.repartitionByRange(files, order).sortWithinPartitions(order).write.parquet(str(target))
    # the file source reads oldest first
    for i, path in enumerate(sorted(Path(target).glob("*.parquet"))):
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture(scope="module")
def static(spark, folder, tmp_path_factory):
    """Events with a timestamp, and a folder of three files to stream."""
    target = tmp_path_factory.mktemp("stream") / "events"
    rows = events(spark, folder).withColumn("ts", F.timestamp_millis("ms"))
    write_as_files(rows, target)
    return spark.read.parquet(str(target)), str(target)


@pytest.fixture
def stream(spark, static):
    df, path = static
    return readers.table_stream(spark, path, df.schema)


def drain(df, mode="append"):
    name = f"out_{uuid.uuid4().hex}"
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def same(a, b, *columns):
    return sorted(map(tuple, a.select(*columns).collect()), key=str) == sorted(
        map(tuple, b.select(*columns).collect()), key=str
    )


def test_tumbling_complete_equals_static_and_append_is_a_prefix(static, stream):
    df, _ = static
    batch = W.aggregate_tumbling(df, ["store"], "ms", HOUR, [W.count_fold()])
    marked = eventtime.bounded_watermark(stream, "ts", 1000)
    grouped = W.stream_panes(marked, ["store"], "ts", "1 hour").agg(F.count("*").alias("n"))
    panes = grouped.select("store", *W.pane_bounds(), "n")
    assert same(drain(panes, "complete"), batch, "store", "w_start", "w_end", "n")
    closed = {tuple(r) for r in drain(panes).select("store", "w_start", "w_end", "n").collect()}
    every = {tuple(r) for r in batch.select("store", "w_start", "w_end", "n").collect()}
    assert closed and closed <= every


def test_sliding_and_sessions(static, stream):
    df, _ = static
    marked = eventtime.bounded_watermark(stream, "ts", 1000)
    sliding = W.stream_panes(marked, [], "ts", "5 hours", "3 hours").agg(F.count("*").alias("n"))
    batch = W.aggregate_sliding(df, [], "ms", 5 * HOUR, 3 * HOUR, [W.count_fold()])
    assert same(
        drain(sliding.select(*W.pane_bounds(), "n"), "complete"), batch, "w_start", "w_end", "n"
    )
    for keys in (["user_id"], []):
        batch = W.sessions(df, keys, "ms", 2 * HOUR)
        streamed = W.stream_sessions(marked, keys, "ts", "2 hours").agg(F.count("*").alias("n"))
        out = drain(streamed.select(*keys, *W.pane_bounds("session_window"), "n"), "complete")
        assert same(out, batch, *keys, "w_start", "w_end", "n")


def test_rewindow_in_append_mode(static, stream):
    df, _ = static
    marked = eventtime.bounded_watermark(stream, "ts", 0)
    inner = W.stream_panes(marked, [], "ts", "2 hours", "1 hour").agg(F.count("*").alias("n"))
    outer = W.stream_rewindow(inner, "1 day").agg(F.max("n").alias("n"))
    out = {tuple(r) for r in drain(outer.select(*W.pane_bounds(), "n")).collect()}
    panes = W.aggregate_sliding(df, [], "ms", 2 * HOUR, HOUR, [W.count_fold()])
    batch = W.peak_pane(panes, 24 * HOUR, "n").select("outer_start", "outer_end", "n")
    assert out and out <= {tuple(r) for r in batch.collect()}


def test_rolling_twins(static, stream):
    df, _ = static
    key = ["user_id"]
    assert same(
        drain(P.rolling_count(stream, key, ORDER), "update"),
        rolling.rolling_count(df, key, ORDER), "event_id", "n",
    )
    assert same(
        drain(P.rolling_sum(stream, key, ORDER, "cents"), "update"),
        rolling.rolling_sum(df, key, ORDER, F.col("cents")), "event_id", "total",
    )
    assert same(
        drain(P.rolling_concat(stream, key, ORDER, "event_type"), "update"),
        rolling.rolling_concat(df, key, ORDER, F.col("event_type")), "event_id", "texts",
    )
    listed = rolling.rolling_list(df, key, ORDER, F.col("event_type"))
    assert same(
        drain(P.rolling_list(stream, key, ORDER, "event_type"), "update"),
        listed.withColumn("items", F.array_join("items", ", ")), "event_id", "items",
    )
    counted = rolling.rolling_map_count(df, key, ORDER, "event_type")
    assert same(
        drain(P.rolling_map_count(stream, key, ORDER, "event_type"), "update"),
        counted, "event_id", "counts",
    )


def test_state_machine_twins(static, stream):
    df, _ = static
    key = ["user_id"]
    assert same(
        drain(P.delta_filter(stream, key, ORDER, "cents", 500), "update"),
        stateful.delta_filter(df, key, ORDER, "cents", 500), "event_id",
    )

    def typed(rows):
        start = F.col("ms") - F.pmod("ms", F.lit(6 * HOUR))
        span = (1 + F.pmod("event_id", F.lit(4))) * 6 * HOUR
        return rows.select(
            "event_id", "ms", "user_id", F.col("event_type").alias("category"),
            start.alias("start_ms"), (start + span).alias("end_ms"),
            span.cast("bigint").alias("duration_ms"),
            F.pmod("event_id", F.lit(100)).cast("int").alias("start_second"),
        )

    fields = ["start_ms", "end_ms", "duration_ms", "start_second"]
    assert same(
        drain(P.merge_runs(typed(stream), key, ORDER, ["category", *fields]), "update"),
        stateful.merge_runs(typed(df), key, ORDER, "category", *fields),
        "user_id", "category", *fields,
    )
    assert same(
        drain(P.merge_anchored(typed(stream), key, ORDER, fields), "update"),
        stateful.merge_anchored(typed(df), key, ORDER, *fields), "user_id", *fields,
    )


def test_first_apps_by_event_time_twin(static, spark, tmp_path):
    df, _ = static
    delay = F.pmod(F.col("event_id") * 7919, F.lit(13)) * 300_000
    arriving = df.withColumn("arrival", F.col("ms") + delay)
    write_as_files(arriving, tmp_path / "arriving", order="arrival")
    source = readers.table_stream(spark, str(tmp_path / "arriving"), arriving.schema)
    order, types = ["arrival", "event_id"], ["purchase", "error"]
    fired = triggers.over_threshold(arriving, "store", "user_id", order, F.col("event_type"), *types, 2, 1)
    batch = triggers.first_apps_so_far(fired, arriving, "store", "user_id", order, "event_type", types, event_time=["ms"])
    found = drain(P.app_store(source, "store", "user_id", order, "event_type", types, ["ms"], 3, 2, 1), "update")
    columns = ["event_id", "installs_before", "uninstalls_before", "first_purchase", "first_error"]
    assert batch.count() > 20 and same(found, batch, *columns)


def test_trigger_twins(static, stream, spark, tmp_path):
    df, _ = static
    args = ("store", "user_id", ORDER)
    limits = ("purchase", "error", 3, 2)
    columns = ["event_id", "installs_before", "uninstalls_before"]
    for types in (None, ["purchase", "error"]):
        assert same(
            drain(P.over_threshold(stream, *args, "event_type", *limits, types), "update"),
            triggers.over_threshold(df, *args, F.col("event_type"), *limits, types), *columns,
        )
    marked = eventtime.bounded_watermark(stream, "ts", 1000)
    counted = P.every_nth(W.tumbling(marked, "ms", HOUR), [], ORDER, 2)
    batch = triggers.every_nth(W.tumbling(df, "ms", HOUR), [], ORDER, 2)
    assert same(drain(counted), batch, "event_id", "n_so_far")

    panes = W.aggregate_tumbling(df, [], "ms", HOUR, [W.count_fold()]).withColumn("one", F.lit(1))
    write_as_files(panes, tmp_path / "panes", order="w_start")
    source = readers.table_stream(spark, str(tmp_path / "panes"), panes.schema)
    peaks = ["pane_number", "peak_start", "peak_end", "peak_count"]
    assert same(
        drain(P.dynamic_peak(source, ["one"]), "update"), triggers.dynamic_peak(panes, "n"), *peaks
    )


def split_sides(rows):
    bought = rows.filter("event_type = 'purchase'").select(
        F.col("user_id"), F.col("event_id").alias("l"), F.col("ms").alias("l_ms"), F.col("ts").alias("l_ts"))
    clicked = rows.filter("event_type = 'click'").select(
        F.col("user_id").alias("r_user"), F.col("event_id").alias("r"),
        F.col("ms").alias("r_ms"), F.col("ts").alias("r_ts"))
    return bought, clicked


def test_join_twins(static, stream):
    df, _ = static
    left, right = split_sides(df)
    batch = joins.interval_join(
        left, right.withColumnRenamed("r_user", "user_id"), "user_id", "l_ms", "r_ms",
        -2 * HOUR, HOUR, ["l"], ["r"])
    s_left, s_right = split_sides(stream)
    s_left, s_right = s_left.withWatermark("l_ts", "1 second"), s_right.withWatermark("r_ts", "1 second")
    streamed = joins.interval_join_stream(
        s_left, s_right, "user_id", "r_user", "l_ts", "r_ts", -2 * HOUR, HOUR)
    assert batch.count() > 0
    assert same(drain(streamed), batch, "l", "r")

    batch = joins.window_join(
        left, right.withColumnRenamed("r_user", "user_id"), "user_id", "l_ms", "r_ms",
        6 * HOUR, ["l"], ["r"])
    streamed = joins.window_join_stream(
        s_left, s_right.withColumnRenamed("r_user", "user_id"), "user_id", "l_ts", "r_ts", "6 hours")
    assert same(drain(streamed), batch, "l", "r")


def test_two_input_match(spark, tmp_path):
    orders = spark.createDataFrame([(f"o{i}", i * 1000) for i in range(30)], "id string, order_ms bigint")
    sent = spark.createDataFrame(
        [(f"o{i}", i * 1000 + (i - 15) * 400) for i in range(0, 30, 2)], "order_id string, delivery_ms bigint")
    write_as_files(orders, tmp_path / "o", order="order_ms")
    sent_backwards = sent.withColumn("back", -F.col("delivery_ms"))
    write_as_files(sent_backwards, tmp_path / "d", order="back")
    streamed = P.match_deliveries(
        readers.table_stream(spark, str(tmp_path / "o"), orders.schema),
        readers.table_stream(spark, str(tmp_path / "d"), sent_backwards.schema),
        "id", "order_id", "order_ms", "delivery_ms", 2000)
    batch = joins.match_deliveries(
        orders, sent, "id", "order_id", "order_ms", "delivery_ms", 2000)
    assert same(drain(streamed, "update"), batch, "id", "order_ms", "delivery_ms", "deadline_ms", "status")


def test_late_split_and_replay(spark, tmp_path):
    rows = spark.createDataFrame(
        [(0, 1000), (1, 8000), (2, 500), (3, 9000), (4, 700), (5, 20000)], "arrival bigint, t bigint")
    write_as_files(rows, tmp_path / "in", order="arrival")
    source = readers.table_stream(spark, str(tmp_path / "in"), rows.schema)
    split = LateSplit(str(tmp_path / "out"), ["arrival"], "t", 2000, 1000)
    split.start(source, str(tmp_path / "checkpoint")).awaitTermination()

    def late():
        read = spark.read.parquet(*map(str, (tmp_path / "out" / "late").glob("batch=*")))
        return sorted(r.arrival for r in read.collect())

    marked = eventtime.with_lateness(rows, ["arrival"], "t", 2000, 1000)
    expected = sorted(r.arrival for r in eventtime.split_late(marked)[1].collect())
    assert late() == expected == [2, 4]
    # a replayed batch replaces its own output
    split(rows.filter("arrival >= 2 and arrival < 4"), 1)
    assert late() == expected


def test_stop_and_resume(spark, static, tmp_path):
    df, path = static
    files = sorted(Path(path).glob("*.parquet"))
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    source.mkdir()

    def run():
        counted = P.rolling_count(
            readers.table_stream(spark, str(source), df.schema), ["user_id"], ORDER)
        query = (
            counted.writeStream.foreachBatch(
                lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"))
            .outputMode("update").option("checkpointLocation", str(checkpoint))
            .trigger(availableNow=True).start())
        query.awaitTermination()

    for file in files:
        shutil.copy(file, source / file.name)
        run()
    read = spark.read.parquet(*map(str, out.glob("batch=*")))
    assert same(read, rolling.rolling_count(df, ["user_id"], ORDER), "event_id", "n")


def test_sinks(spark, static, stream, tmp_path):
    df, _ = static
    seen = {}

    def keep(name):
        return lambda rows: seen.__setitem__(name, seen.get(name, 0) + rows.count())

    plan = {
        "long": (lambda b: b.filter("value >= 30"), keep("long")),
        "all": (lambda b: b, keep("all")),
    }
    stream.writeStream.foreachBatch(sinks.to_all(plan)).option(
        "checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination()
    expected = {"long": df.filter("value >= 30").count(), "all": df.count()}
    assert seen == expected
    seen.clear()
    sinks.write_all(df, plan)
    assert seen == expected

    write = sinks.index_writer(str(tmp_path / "index"), "user_data")
    stream.select("user_id").writeStream.foreachBatch(write).option(
        "checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.json(str(tmp_path / "index" / "user_data")).count() == df.count()

    label = f"labelled_{uuid.uuid4().hex}"
    sinks.print_stream(stream, str(tmp_path / "c3"), label, sink="memory").awaitTermination()
    assert spark.table(label).count() == df.count()
    assert sinks.labelled(df, "x").first().label == "x"


def test_a_replayed_batch_is_written_once(spark, tmp_path):
    written, ledger = [], sinks.Ledger(spark, str(tmp_path / "ledger"))
    broken = [True]

    def second(rows, batch_id):
        if broken[0] and batch_id == 1:
            raise RuntimeError("the store is away")
        written.append(("second", batch_id, rows.count()))

    plan = {
        "first": (lambda b: b, lambda rows: written.append(("first", rows.count()))),
        "second": (lambda b: b.filter("id > 2"), second),
        "folder": (lambda b: b, sinks.index_writer(str(tmp_path / "index"), "all", "parquet")),
    }
    write, batch = sinks.to_all(plan, ledger), spark.range(5)
    write(batch, 0)
    with pytest.raises(RuntimeError):
        write(batch, 1)
    broken[0] = False
    for number in (1, 1, 0):  # a new run replays what the last one had not committed
        sinks.to_all(plan, sinks.Ledger(spark, str(tmp_path / "ledger")))(batch, number)
    assert written == [("first", 5), ("second", 0, 2), ("first", 5), ("second", 1, 2)]
    assert spark.read.parquet(str(tmp_path / "index" / "all")).count() == 10


def test_sql_insert(spark, tmp_path):
    users = readers.generated_table(spark, 500)
    users.createOrReplaceTempView("users_in")
    spark.sql("CREATE TABLE user_out (rating INT, subscription BOOLEAN) USING parquet")
    out = sinks.insert_select(spark, "user_out", "users_in", ["rating", "subscription"])
    assert same(out, users, "rating", "subscription")

    write_as_files(users, tmp_path / "users", order="id")
    source = readers.table_stream(spark, str(tmp_path / "users"), users.schema)
    sinks.insert_stream(
        source, "user_out_stream", str(tmp_path / "c"), ["rating", "subscription"]).awaitTermination()
    assert same(spark.table("user_out_stream"), users, "rating", "subscription")


def test_generated_stream(spark):
    name = f"gen_{uuid.uuid4().hex}"
    query = (
        readers.generated_stream(spark, rows_per_batch=500)
        .writeStream.format("memory").queryName(name).start())
    deadline = time.time() + 120
    while spark.table(name).count() < 1000 and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    found = spark.table(name).filter("id < 1000")
    assert same(found, readers.generated_table(spark, 1000), "id", "rating", "subscription")


def test_topic_decode_over_files(spark, tmp_path):
    messages = spark.createDataFrame(
        [(bytearray(f"x,{i},2,3,pv,2017-11-27".encode()), i) for i in range(9)], "value binary, n int")
    write_as_files(messages, tmp_path / "m", order="n")
    source = readers.table_stream(spark, str(tmp_path / "m"), messages.schema)
    out = drain(readers.decode_csv_value(source, schemas.USER_BEHAVIOR))
    assert sorted(r.user_id for r in out.collect()) == list(range(9))
    options = readers.topic_options("host:9092", "user_behavior")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "user_behavior"


def test_csv_stream_to_usage(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Phone,23/11/2019,23:00:00,0:31:00\n")
    (folder / "b.csv").write_text("Phone,24/11/2019,01:00:00,0:10:00\n")
    raw = readers.csv_stream(spark, str(folder), schemas.RAW_USAGE)
    typed = usage.typed_usage(raw)
    total = P.rolling_sum(typed, ["app_name"], ["start_ms"], "duration_ms")
    assert sorted(r.total for r in drain(total, "update").collect()) == [31 * 60_000, 41 * 60_000]

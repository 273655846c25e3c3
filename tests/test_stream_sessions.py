"""Sessions of a stream in two steps against the sessions of the table."""

import time

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import drain, write_as_files
from tidemark.operators import windows as W
from tidemark.operators.chunks import Fold
from tidemark.plans.inputs import HOUR, MINUTE, events
from tidemark.sources import readers, sinks
from tidemark.streaming import sessions as S


def folds():
    return [
        W.count_fold(),
        Fold("cents", "sum", F.col("cents")),
        Fold("least", "min", F.col("cents")),
        Fold("greatest", "max", F.when(F.col("cents") % 2 == 0, F.col("cents"))),
    ]


def stream_of(spark, rows, target, files):
    write_as_files(rows, target, files, "ms")
    schema = spark.read.parquet(str(target)).schema
    return readers.table_stream(spark, str(target), schema).withWatermark("ts", "0 seconds")


@pytest.mark.parametrize("files", [1, 4])
@pytest.mark.parametrize("keys, gap", [([], 5 * MINUTE), (["user_id"], 6 * HOUR), ([], 30 * 24 * HOUR)])
def test_equal_to_sessions_of_the_table(spark, folder, tmp_path, keys, gap, files):
    rows = events(spark, folder).withColumn("ts", F.timestamp_millis("ms"))
    streamed = S.sessions(stream_of(spark, rows, tmp_path / "in", files), keys, "ts", gap, folds())
    out = [tuple(r) for r in drain(streamed).collect()]
    static = [tuple(r) for r in W.sessions(rows, keys, "ms", gap, folds()).select(streamed.columns).collect()]
    end = rows.agg(F.max("ms")).first()[0]
    done = {r for r in static if r[len(keys) + 1] + gap <= end}
    assert len(out) == len(set(out))
    assert done <= set(out) <= set(static)
    assert gap > 24 * HOUR or len(done) > 3


def test_touching_rows_null_times_and_null_keys(spark, tmp_path):
    gap = 1000
    ms = [0, 999, 1999, 3000, 3001, 9000, 10_000, 20_000, None, 90_000]
    rows = spark.createDataFrame([(k, m, 2) for k in ("a", None) for m in ms], "k string, ms long, cents long")
    rows = rows.withColumn("ts", F.timestamp_millis("ms"))
    streamed = S.sessions(stream_of(spark, rows, tmp_path / "in", 1), ["k"], "ts", gap)
    found = sorted(((r.k or "", r.w_start, r.w_end, r.n) for r in drain(streamed).collect()))
    due = [(0, 2999, 3), (3000, 4001, 2), (9000, 11_000, 2), (20_000, 21_000, 1)]
    assert found == sorted((k, *d) for k in ("", "a") for d in due)


def test_ordered_folds_are_refused(spark, folder):
    with pytest.raises(ValueError):
        S.sessions(events(spark, folder), [], "ts", 1000, [Fold("all", "list", F.col("cents"))])


def test_tables_without_rows_give_streams_without_rows(spark, folder, tmp_path):
    whole = readers.table(spark, folder, "events")
    whole.limit(0).write.parquet(str(tmp_path / "events.parquet"))
    streamed = readers.whole_stream(spark, str(tmp_path), "events").withWatermark("ts", "0 seconds")
    assert sinks.drained(S.sessions(streamed, [], "ts", 1000)).count() == 0


def test_micro_batches_at_an_interval(spark, folder, tmp_path):
    streamed = readers.whole_stream(spark, folder, "events").withWatermark("ts", "0 seconds")
    panes = W.stream_panes(streamed, [], "ts", "1 hour").agg(F.count("*").alias("n")).select(*W.pane_bounds(), "n")
    query = sinks.print_stream(panes, str(tmp_path / "log"), "paced_panes", sink="memory", every="200 milliseconds")
    try:
        end = time.monotonic() + 60
        while not spark.table("paced_panes").count() and time.monotonic() < end:
            time.sleep(0.2)
        rows = events(spark, folder)
        last = rows.agg(F.max("ms")).first()[0]
        static = {tuple(r) for r in W.aggregate_tumbling(rows, [], "ms", HOUR, [W.count_fold()]).collect()}
        assert {tuple(r) for r in spark.table("paced_panes").collect()} == {r for r in static if r[1] <= last}
        assert query.isActive  # waits for the next interval
    finally:
        query.stop()

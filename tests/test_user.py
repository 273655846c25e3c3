"""User functions, and the session helpers."""

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions import user
from tidemark.operators import windows as W
from tidemark.plans.inputs import DAY, events


class Mean(user.Accumulator):
    def create(self):
        return (0, 0)

    def add(self, accumulator, rows: pd.DataFrame):
        return accumulator[0] + int(rows["cents"].sum()), accumulator[1] + len(rows)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, accumulator):
        return accumulator[0] / accumulator[1]


def test_accumulator_equals_built_in(spark, folder):
    rows = events(spark, folder).repartition(6)
    panes = W.tumbling(rows, "ms", DAY)
    out = user.accumulate(panes, ["store", "w_start"], ["cents"], Mean(), "double", "mean")
    expected = W.average_tumbling(rows, ["store"], "ms", DAY, F.col("cents"))
    found = {(r.store, r.w_start): r["mean"] for r in out.collect()}
    assert found == {(r.store, r.w_start): r["mean"] for r in expected.collect()}


def test_functions(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "n int, t string")
    assert user.where(df, "n > 1").count() == user.where(df, F.col("n") > 1).count() == 1
    named = user.map_rows(df, double="n * 2", t=F.upper("t"))
    assert sorted(map(tuple, named.collect())) == [(2, "A B"), (4, "C")]
    words = user.flat_map(df, F.split("t", " "), "word")
    assert sorted(r.word for r in words.collect()) == ["a", "b", "c"]
    plus_one = user.map_values(lambda s: s + 1, "int")
    assert sorted(r[0] for r in df.select(plus_one("n")).collect()) == [2, 3]
    twice = user.map_batches(df, lambda f: pd.concat([f, f]), df.schema)
    assert twice.count() == 4


def test_expand_gives_any_number_of_rows(spark):
    df = spark.createDataFrame([(1, "ab", None), (2, "", "x"), (3, None, "y"), (4, "c", "z")], "n int, t string, other string")

    def letters(texts):
        found = [(i, c) for i, t in enumerate(texts.to_pylist()) for c in t or ""]
        return [i for i, _ in found], pa.RecordBatch.from_pydict({"c": pa.array([c for _, c in found], pa.string())})

    out = user.expand(df, ["t"], letters, "c string")
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "ab", None, "a"), (1, "ab", None, "b"), (4, "c", "z", "c")]
    assert user.expand(df.limit(0), ["t"], letters, "c string").count() == 0


def test_shared_folder_is_that_of_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert session.shared_folder(spark) == configured
    cut = session.cut_lineage(spark.range(3))
    assert cut.count() == 3 and "Range" not in cut._jdf.queryExecution().toString()


def test_expand_repeats_no_long_inputs(spark):
    """Rows are expanded in pieces of bounded size, and only what is kept is repeated."""
    df = spark.range(0, 60, 1, 1).select(F.col("id").cast("int").alias("n"), F.repeat(F.lit("ab "), 20_000).alias("t"))

    def places(texts):
        size = texts.nbytes
        rows = [i for i, t in enumerate(texts.to_pylist()) for _ in t.split()[:50]]
        return rows, pa.RecordBatch.from_pydict({"bytes": pa.array([size] * len(rows), pa.int64())})

    out = user.expand(df, ["t"], places, "bytes bigint", keep=["n"])
    assert out.columns == ["n", "bytes"] and out.count() == 3000
    assert out.agg(F.max("bytes")).first()[0] < 1_100_000
    assert sorted(r["count"] for r in out.groupBy("n").count().collect()) == [50] * 60

    whole = user.expand(df, ["t"], places, "bytes bigint")
    assert whole.columns == ["n", "t", "bytes"] and whole.agg(F.sum(F.length("t"))).first()[0] == 3000 * 60_000

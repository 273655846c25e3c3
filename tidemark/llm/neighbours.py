"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the exact graph of nearest neighbours is cut into balanced
partitions: a balanced start by bisection, then nodes move to the partition of
most of their neighbours as far as capacities allow. A small classifier learns
the partition of a vector. Every row is then indexed under its most probable
partition, and every query is routed to its ``probes`` most probable ones, where
all candidates are scored exactly in double precision.

Partitions are cut into cells of bounded rows on both sides, so one partition
may hold any share of the rows; a cell returns its best few per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage


@dataclass(frozen=True)
class Router:
    """A classifier with one hidden layer over unit vectors."""

    first: np.ndarray
    offset: np.ndarray
    second: np.ndarray

    def odds(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.first + self.offset, 0) @ self.second

    def best(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable partitions of each vector."""
        odds = self.odds(unit)
        if n >= odds.shape[1]:
            return np.broadcast_to(np.arange(odds.shape[1]), odds.shape)
        return np.argpartition(-odds, n - 1, axis=1)[:, :n]


def graph(unit: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each sample vector, exactly, a block at a time."""
    found = np.empty((len(unit), k), np.int64)
    for i in range(0, len(unit), 1024):
        near = unit[i : i + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        found[i : i + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return found


def partition(unit: np.ndarray, near: np.ndarray, parts: int, rounds: int, seed: int) -> np.ndarray:
    """Balanced partitions of the graph with few edges between them."""
    n = len(unit)
    rng = np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    groups = [(np.arange(n), parts)]
    while groups:  # bisect along the direction of most spread
        at, share = groups.pop()
        if share == 1:
            continue
        centred = unit[at] - unit[at].mean(axis=0)
        axis = rng.standard_normal(unit.shape[1])
        for _ in range(12):
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) or 1.0
        order = at[np.argsort(centred @ axis, kind="stable")]
        half = share // 2
        cut = len(order) * half // share
        label[order[cut:]] += half
        groups += [(order[:cut], half), (order[cut:], share - half)]
    most = -(-n * 105 // (parts * 100))
    sources = np.repeat(np.arange(n), near.shape[1])
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (sources, label[near.ravel()]), 1)
        np.add.at(votes, (near.ravel(), label[sources]), 1)
        here = votes[np.arange(n), label]
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(n), wish] - here
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[wish[i]] < most:
                size[label[i]] -= 1
                size[wish[i]] += 1
                label[i] = wish[i]
                moved += 1
        if not moved:
            break
    return label


def learn(unit: np.ndarray, label: np.ndarray, parts: int, hidden: int, epochs: int, seed: int) -> Router:
    """Fit the classifier by stochastic gradient steps with momentum."""
    rng = np.random.default_rng(seed)
    d = unit.shape[1]
    w = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d) * 3, np.zeros(hidden), rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden)]
    speed = [np.zeros_like(x) for x in w]
    for epoch in range(epochs):
        rate = 0.1 * (1 - epoch / epochs) + 0.005
        order = rng.permutation(len(unit))
        for i in range(0, len(order), 128):
            at = order[i : i + 128]
            x = unit[at]
            inner = np.maximum(x @ w[0] + w[1], 0)
            odds = inner @ w[2]
            odds = np.exp(odds - odds.max(axis=1, keepdims=True))
            miss = odds / odds.sum(axis=1, keepdims=True)
            miss[np.arange(len(at)), label[at]] -= 1
            miss /= len(at)
            back = (miss @ w[2].T) * (inner > 0)
            for p, slope in enumerate((x.T @ back, back.sum(axis=0), inner.T @ miss)):
                speed[p] = 0.9 * speed[p] - rate * slope
                w[p] = w[p] + speed[p]
    return Router(*w)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector as doubles) of rows that take part.

    Left out: null, empty and zero vectors, those with null or non-finite
    components, and those whose length is not the most common one (the larger of
    equally common ones).
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(good).filter(some)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max(F.struct("n", "d")).alias("top")).first()["top"]
    return rows.filter(F.size("v") == (top["d"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # neither over- nor underflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def fit(rows: DataFrame, parts: int, sample: int, neighbours: int, hidden: int, epochs: int, seed: int) -> Router | None:
    """Learn partitions on about ``sample`` rows, chosen by a hash of the id."""
    total = rows.count()
    place = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000))
    some = rows.filter(place < F.lit(int(1_000_000 * sample / max(total, 1)) + 1)).select("vec_id", "v")
    table = some.limit(2 * sample).toArrow()
    if not len(table):
        return None
    table = table.sort_by("vec_id")
    unit = _unit(_matrix(table.column("v").combine_chunks()))
    unit = np.unique(unit, axis=0)
    parts = max(1, min(parts, len(unit) // 8))
    k = min(neighbours, len(unit) - 1)
    if parts == 1 or k < 1:
        return Router(np.zeros((unit.shape[1], 1)), np.zeros(1), np.zeros((1, 1)))
    label = partition(unit, graph(unit, k), parts, 20, seed)
    return learn(unit, label, parts, hidden, epochs, seed)


_FOUND = "query_id bigint, vec_id bigint, score double"


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
    parts: int = 32, probes: int = 24, sample: int = 8_192, neighbours: int = 16, hidden: int = 128,
    epochs: int = 30, seed: int = 3, cell_rows: int = 50_000, cell_queries: int = 2_000,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row.

    Ids are integers; a row is no neighbour of a row with its own id. Rows that
    repeat an id give one neighbour per different score: copies of a row count
    once, as do different vectors of an id that score alike. Ties go to the
    smaller id. Rows that cannot be compared take no part (see ``usable``); rows
    with a null id neither. An empty table gives an empty result.
    """
    rows = cut_lineage(usable(vectors, vec_id, vector).filter("vec_id is not null").withColumn("vec_id", F.col("vec_id").cast("bigint")))
    router = fit(rows, parts, sample, neighbours, hidden, epochs, seed)
    spark = vectors.sparkSession
    if router is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    schema = T.StructType([*rows.schema.fields, T.StructField("parts", T.ArrayType(T.IntegerType()))])

    def route(n: int):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    best = router.best(_unit(_matrix(batch.column("v"))), n).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(list(best), pa.list_(pa.int32()))], ["vec_id", "v", "parts"]
                    )

        return apply

    indexed = rows.mapInArrow(route(1), schema).select("vec_id", "v", F.explode("parts").alias("part"))
    indexed = cut_lineage(indexed)
    asked = rows.filter(is_query).mapInArrow(route(probes), schema)
    asked = cut_lineage(asked.select("vec_id", "v", F.explode("parts").alias("part")))

    # Cells: as even as a quarter of the mean partition, and never beyond the bounds.
    def cuts(df: DataFrame, bound: int, name: str) -> dict[int, int]:
        counts = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}  # a row per partition
        even = -(-sum(counts.values()) // (4 * len(router.second[0]))) or 1
        size = min(bound, max(even, 32))
        return {p: -(-n // size) for p, n in counts.items()}

    rows_cuts, ask_cuts = cuts(indexed, cell_rows, "rows"), cuts(asked, cell_queries, "asked")

    def times(of: dict[int, int]) -> Column:
        known = [x for p, n in sorted(of.items()) for x in (F.lit(p), F.lit(n))]
        return F.coalesce(F.create_map(*known)[F.col("part")], F.lit(0)) if known else F.lit(0)

    def cells(df: DataFrame, own: dict[int, int], other: dict[int, int], a: str, b: str) -> DataFrame:
        n, m = times(own), times(other)
        return df.filter(m > 0).select(
            "vec_id", "v", "part", F.pmod(F.xxhash64("vec_id", F.lit(1)), n).cast("int").alias(a),
            F.explode(F.sequence(F.lit(0), m - 1)).alias(b),
        )

    keys = ["part", "i", "j"]
    there = cells(indexed, rows_cuts, ask_cuts, "i", "j").groupBy(*keys)
    here = cells(asked, ask_cuts, rows_cuts, "j", "i").groupBy(*keys)
    found = here.cogroup(there).applyInArrow(_best_of_cell(k), _FOUND)
    best = found.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k).alias("best")
    )
    return best.select("query_id", F.posexplode("best").alias("place", "one")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), "one.vec_id", (-F.col("one.far")).alias("score")
    )


def _distinct_best(
    score: np.ndarray, own: np.ndarray, bar: float, unit: np.ndarray, wanted: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates, their scores, and the places of the best ``k`` distinct (score, id).

    The bar counts every row, so it is lowered until ``k`` distinct ones are
    above it or all rows are.
    """
    take = k
    while True:
        at = np.flatnonzero((score >= bar) & ~own)
        exact = (unit[at] * wanted).sum(axis=1)
        order = np.lexsort((ids[at], -exact))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (exact[order][1:] != exact[order][:-1]) | (ids[at][order][1:] != ids[at][order][:-1])
        best = order[fresh][:k]
        if len(best) == k or take >= len(ids):
            return at, exact, best
        take = min(4 * take, len(ids))
        bar = -np.partition(-score, take - 1)[take - 1] - 1e-12


def _best_of_cell(k: int):
    def apply(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(asked) and len(held):
            ids = held.column("vec_id").combine_chunks().to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            unit = _unit(_matrix(held.column("v").combine_chunks()))[order]
            queries = asked.column("vec_id").combine_chunks().to_numpy()
            wanted = _unit(_matrix(asked.column("v").combine_chunks()))
            step = max(1, 4_000_000 // len(ids))
            for i in range(0, len(queries), step):
                score = np.einsum("qd,cd->qc", wanted[i : i + step], unit, optimize=True)
                own = queries[i : i + step, None] == ids[None, :]
                score[own] = -np.inf
                # What may be among the best is scored again row by row: the block
                # product can differ in the last bit for equal vectors.
                n = min(k, len(ids))
                bar = -np.partition(-score, n - 1, axis=1)[:, n - 1] - 1e-12
                for q in range(len(score)):
                    at, exact, best = _distinct_best(score[q], own[q], bar[q], unit, wanted[i + q], ids, k)
                    out[0] += [queries[i + q]] * len(best)
                    out[1] += ids[at[best]].tolist()
                    out[2] += exact[best].tolist()
        return pa.table({
            "query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64()),
        })

    return apply

"""Places for user functions.

A filter, map or join function is a column expression or SQL text wherever it
can be. The functions here are for the rest; they get Arrow batches as pandas
frames and never a whole key.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.operators.walk import groups, to_batch, walk


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.filter(predicate)


def map_rows(df: DataFrame, **columns: Column | str) -> DataFrame:
    """One output row per input row, from named expressions."""
    return df.select(
        *[(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    )


def flat_map(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One output row per element of an array expression."""
    return df.select("*", F.explode(items).alias(name))


# Arrow bytes that an expansion has in hand at once, in rows given and in rows made.
_BYTES_AT_ONCE = 1_000_000


def _pieces(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """First place and number of rows of each piece; a piece may be one large row."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > _BYTES_AT_ONCE:
            yield start, i - start
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes) - start


def expand(
    df: DataFrame, inputs: Sequence[str],
    function: Callable[..., tuple[Sequence[int], pa.RecordBatch]], outputs: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Any number of output rows per row, beside the columns of the row.

    ``function`` gets the input columns of some rows as Arrow arrays, and returns
    for every output row the number of its row among these, and the new columns,
    which ``outputs`` declares. For row expansions that no expression gives; a
    batch is expanded piece by piece, and nothing is shuffled. ``keep`` names the
    columns to repeat beside the new ones (default: all); a long input that is not
    wanted there should not be. (A table function in Arrow cannot be joined
    laterally.)
    """
    names = df.columns if keep is None else list(keep)
    added = T.StructType.fromDDL(outputs)
    schema = T.StructType([*[df.schema[c] for c in names], *added.fields])
    kinds = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in added.fields])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.slice(i, 1).nbytes for i in range(batch.num_rows)]
            for first, n in _pieces(sizes):
                piece = batch.slice(first, n)
                rows, found = function(*[piece.column(c) for c in inputs])
                kept = piece.select(names)
                wide = {i: kept.slice(i, 1).nbytes for i in set(rows)}
                for start, count in _pieces([wide[i] for i in rows]):
                    beside = kept.take(pa.array(rows[start : start + count], pa.int64()))
                    new = [found.column(f.name).slice(start, count).cast(f.type) for f in kinds]
                    yield pa.RecordBatch.from_arrays([*beside.columns, *new], [*names, *kinds.names])

    return df.mapInArrow(apply, schema)


def map_values(function: Callable[[pd.Series], pd.Series], kind: str | T.DataType):
    """A vectorised column function."""
    return F.pandas_udf(function, kind)


def map_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType
) -> DataFrame:
    """Any number of output rows per batch of input rows."""

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(apply, schema)


class Accumulator:
    """A user-defined aggregate with a mergeable accumulator.

    ``add`` gets the rows of one key within a batch; ``merge`` must be
    associative and commutative.
    """

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, accumulator: Any, rows: pd.DataFrame) -> Any:
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def result(self, accumulator: Any) -> Any:
        raise NotImplementedError


# Keys a task keeps before it hands its partial results on.
_KEYS_IN_MEMORY = 100_000


# Tasks whose partial results of a key are merged by one step of the first level.
_FAN_IN = 1024


def accumulate(
    df: DataFrame, keys: Sequence[str], inputs: Sequence[str], aggregate: Accumulator,
    kind: str, name: str = "result",
) -> DataFrame:
    """Aggregate per key: first within each task, then over partial results, in two levels.

    ``keys`` are key columns or pane bounds; null is a key like any other. Without
    keys the whole table is one group, and an empty table has none. A heavy key's
    partial results, one per task, are merged by groups of tasks first, and only
    one of each of these meets the others. Merging walks sorted rows, so a step
    holds two accumulators, however many there are.
    """
    rows = df.select(*keys, *inputs)
    key_fields = [rows.schema[k] for k in keys]
    partial = T.StructType([
        *key_fields, T.StructField("__tasks", T.IntegerType()), T.StructField("__partial", T.BinaryType())
    ])
    key_list = list(keys)

    # Keys stay in Arrow: as pandas numbers, large ones next to a null lose digits.
    def flush(held: dict, kinds: list) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
        tasks = pa.array([TaskContext.get().partitionId() // _FAN_IN] * len(held), pa.int32())
        partials = pa.array([pickle.dumps(a) for a in held.values()], pa.binary())
        return pa.RecordBatch.from_arrays([*columns, tasks, partials], [*key_list, "__tasks", "__partial"])

    def within_task(batches):
        held: dict = {}
        kinds: list = []
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in key_list]
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(groups(batch, key_list)):
                places.setdefault(key, []).append(i)
            for key, at in places.items():
                started = held[key] if key in held else aggregate.create()
                held[key] = aggregate.add(started, batch.take(pa.array(at)).to_pandas())
            if len(held) > _KEYS_IN_MEMORY:
                yield flush(held, kinds)
                held.clear()
        if held:
            yield flush(held, kinds)

    def merged(by: list[str], finish: Callable[[Any], Any], last: str, of: pa.DataType):
        def step(batches):
            group, total, kinds = None, None, []
            for batch in batches:
                kinds = [batch.schema.field(k).type for k in by]
                done = []
                for g, found in zip(groups(batch, by), batch.column("__partial").to_pylist()):
                    accumulator = pickle.loads(found)
                    if g == group:
                        total = aggregate.merge(total, accumulator)
                    else:
                        if group is not None:
                            done.append((*group, finish(total)))
                        group, total = g, accumulator
                yield to_batch(done, schema_of(kinds))
            if group is not None:
                yield to_batch([(*group, finish(total))], schema_of(kinds))

        def schema_of(kinds):
            return pa.schema([*zip(by, kinds), (last, of)])

        return step

    result = T.StructType([*key_fields, *T.StructType.fromDDL(f"`{name}` {kind}").fields])
    by_tasks = [*key_list, "__tasks"]
    partials = rows.mapInArrow(within_task, partial)
    few = walk(partials, by_tasks, [], merged(by_tasks, pickle.dumps, "__partial", pa.binary()), partial)
    finish = merged(key_list, aggregate.result, name, to_arrow_type(result[name].dataType))
    return walk(few, key_list, [], finish, result)

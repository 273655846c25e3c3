"""Rolling per-key aggregates: one output row per input row.

``order`` names the columns that give the arrival order and must be unique
within a key. Heavy keys are split, see :mod:`tidemark.operators.chunks`.
Streaming twins are in :mod:`tidemark.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.chunks import (
    CHUNK,
    LAST_CHUNK,
    ROWS_PER_CHUNK,
    Fold,
    narrow,
    position,
    running,
    same_key,
    tag_chunks,
)
from tidemark.operators.walk import groups, openings, to_batch, walk


def rolling_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
    name: str = "total", **split,
) -> DataFrame:
    return running(df, keys, order, [Fold(name, "sum", value)], **split)


def rolling_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n", **split
) -> DataFrame:
    return running(df, keys, order, [Fold(name, "count", F.lit(1))], **split)


def rolling_concat(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], text: Column,
    separator: str = "", name: str = "texts", **split,
) -> DataFrame:
    """All texts of the key so far as one string.

    The output is quadratic in the rows of a key by definition.
    """
    listed = running(df, keys, order, [Fold(name, "list", text)], **split)
    return listed.withColumn(name, F.array_join(name, separator))


def rolling_list(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
    name: str = "items", **split,
) -> DataFrame:
    return running(df, keys, order, [Fold(name, "list", value)], **split)


def rolling_reduce(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
    combine: Callable[[np.ndarray, np.ndarray], np.ndarray], name: str = "reduced",
    rows_per_chunk: int = ROWS_PER_CHUNK, costly: bool = False,
) -> DataFrame:
    """Running reduce by any associative function.

    ``combine`` gets two arrays, the earlier and the later values, and returns
    their combinations; ``of_values`` makes one of a function of two values. Rows
    of a batch are combined in a number of steps that is the logarithm of its
    longest group. Counts, sums, minima and maxima are built-in folds of
    ``running``. Chunks of a heavy key are reduced first, and go on from what the
    chunks before them came to. Null values are passed over.
    """
    tagged, split = tag_chunks(df, keys, order, rows_per_chunk, costly)
    kind = df.schema[value].dataType
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    columns = df.columns
    if not split:
        rows = tagged.select(*columns, F.lit(None).cast(kind).alias("__before"))
        return walk(rows, keys, order, _reducing(keys, value, combine, columns, name), schema)

    key_names = [f"__key_{i}" for i in range(len(keys))]
    heavy = tagged.filter(F.col(LAST_CHUNK) > 0).select(
        *[F.col(k).alias(n) for k, n in zip(keys, key_names)],
        F.col(CHUNK).alias("__at"),
        *[F.col(c).alias(f"__order_{i}") for i, c in enumerate(order)],
        F.col(value).alias("__value"),
    )
    carried = T.StructType(
        [*[heavy.schema[n] for n in key_names], heavy.schema["__at"], T.StructField("__value", kind)]
    )
    orders = [f"__order_{i}" for i in range(len(order))]
    totals = walk(heavy, [*key_names, "__at"], orders, _totals([*key_names, "__at"], combine), carried)
    # One row per chunk of a split key; texts may hold all that came before.
    before = narrow(
        walk(totals, key_names, ["__at"], _befores(key_names, combine), carried),
        split, wide=not isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType)),
    )
    pairs = [*zip(keys, key_names), (CHUNK, "__at")]
    rows = tagged.join(before, same_key(tagged, before, pairs), "left").select(
        *[tagged[c] for c in columns], CHUNK, F.col("__value").alias("__before")
    )
    by = [*keys, CHUNK]
    return walk(rows, by, order, _reducing(by, value, combine, columns, name), schema)


def of_values(combine: Callable[[Any, Any], Any]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of two values as one of two arrays."""
    return lambda a, b: np.frompyfunc(combine, 2, 1)(a, b)


def prefix_scan(values: np.ndarray, opening: np.ndarray, combine: Callable) -> np.ndarray:
    """Combination of all values of a segment up to each; segments begin at ``opening``.

    Every step combines each value with the one 1, 2, 4, ... places before it.
    """
    found, place = values.copy(), np.arange(len(values))
    place -= np.repeat(opening, np.diff(np.append(opening, len(values))))
    far = 1
    while far <= place.max(initial=0):
        at = np.flatnonzero(place >= far)
        found[at] = combine(found[at - far], found[at])
        far *= 2
    return found


def _scanned(batches, by: Sequence[str], value: str, combine: Callable, before: str | None):
    """(batch, where its groups begin, is the first one new, reduction so far of every row)."""
    earlier, total = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        opening = openings(batch, by, earlier)
        kind = batch.schema.field(value).type
        nothing = pa.nulls(len(opening), kind)
        befores = nothing if before is None else batch.column(before).take(pa.array(opening, pa.int64()))
        new = bool(len(opening)) and opening[0] == 0
        if not new:  # the first rows go on with the group of the last batch
            opening = np.append(0, opening)
            befores = pa.concat_arrays([pa.array([total], kind), befores])
        column = batch.column(value)
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        place = np.cumsum(valid)
        segment = np.repeat(np.arange(len(opening)), np.diff(np.append(opening, batch.num_rows)))
        first = (place - valid)[opening]  # values before each segment
        values = column.drop_null().to_numpy(zero_copy_only=False)
        of_value = segment[valid]
        if len(values):
            used = np.flatnonzero(np.append(True, np.diff(of_value) > 0))
            values = prefix_scan(values, used, combine)
            has = befores.is_valid().to_numpy(zero_copy_only=False)
            goes_on = np.flatnonzero(has[of_value])
            if len(goes_on):
                start = befores.take(pa.array(of_value[goes_on])).to_numpy(zero_copy_only=False)
                values[goes_on] = combine(start, values[goes_on])
        pool = pa.concat_arrays([pa.array(values, kind), befores])
        seen = place > first[segment]
        reduced = pool.take(pa.array(np.where(seen, place - 1, len(values) + segment)))
        yield batch, opening, new, reduced
        earlier, total = batch.slice(batch.num_rows - 1), reduced[-1].as_py()


def _reducing(by: Sequence[str], value: str, combine: Callable, columns: Sequence[str], name: str):
    """Every row with the reduction of its group so far, from ``__before`` on."""

    def step(batches):
        for batch, _, _, reduced in _scanned(batches, by, value, combine, "__before"):
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], reduced], names=[*columns, name]
            )

    return step


def _totals(by: Sequence[str], combine: Callable):
    """One row per group with its reduction."""

    def step(batches):
        held = None  # the last row of a group that may go on
        for batch, opening, new, reduced in _scanned(batches, by, "__value", combine, None):
            rows = pa.RecordBatch.from_arrays([*[batch.column(c) for c in by], reduced], names=[*by, "__value"])
            if new and held is not None:
                yield held
            ends = np.append(opening[1:], batch.num_rows) - 1
            yield rows.take(pa.array(ends[:-1], pa.int64()))
            held = rows.slice(batch.num_rows - 1)
        if held is not None:
            yield held

    return step


def _befores(by: Sequence[str], combine: Callable):
    """Every chunk with the reduction of the chunks before it; a row per chunk."""

    def step(batches):
        group, total = None, None
        for batch in batches:
            kind = batch.schema.field("__value").type
            done = []
            rows = zip(groups(batch, by), batch.column("__at").to_pylist(), batch.column("__value").to_pylist())
            for g, at, v in rows:
                if g != group:
                    group, total = g, None
                done.append((*g, at, total))
                if total is None or v is None:
                    total = v if total is None else total
                else:
                    one, two = (pa.array([x], kind).to_numpy(zero_copy_only=False) for x in (total, v))
                    total = pa.array(combine(one, two), kind)[0].as_py()
            yield to_batch(done, pa.schema([batch.schema.field(c) for c in [*by, "__at", "__value"]]))

    return step


def rolling_map_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sub_key: str,
    name: str = "counts", rows_per_chunk: int = ROWS_PER_CHUNK, costly: bool = False,
) -> DataFrame:
    """Count per sub-key so far, all of them on every row, in sub-key order.

    A null sub-key is not counted. Each chunk is one walk with a dictionary. The
    walk of a later chunk of a heavy key begins with a row of its own, the counts
    of all chunks before it, which is no larger than an output row.
    """
    tagged, split = tag_chunks(df, keys, order, rows_per_chunk, costly)
    columns = df.columns
    counts = T.MapType(df.schema[sub_key].dataType, T.LongType())
    schema = T.StructType([*df.schema.fields, T.StructField(name, counts)])
    if not split:
        rows = tagged.select(*columns, F.lit(None).cast(counts).alias("__before"), F.lit(False).alias("__carry"))
        return walk(rows, keys, order, _counting(keys, sub_key, columns, name), schema)

    by = [*keys, CHUNK]
    heavy = tagged.filter(F.col(LAST_CHUNK) > 0).filter(F.col(sub_key).isNotNull())
    each = heavy.groupBy(*by, F.col(sub_key).alias("__sub")).agg(F.count(F.lit(1)).alias("__n"))
    entries = F.collect_list(F.struct(F.col("__sub").alias("key"), F.col("__n").alias("value")))
    totals = each.groupBy(*by).agg(F.map_from_entries(entries).alias("__total"))
    # A chunk without counted rows has a total as well: it needs what came before it.
    chunks = tagged.filter(F.col(LAST_CHUNK) > 0).select(*by).distinct()
    totals = chunks.join(totals, same_key(chunks, totals, [(c, c) for c in by]), "left").select(
        *[chunks[c] for c in by], "__total"
    )
    carried = T.StructType([*[totals.schema[c] for c in by], T.StructField("__before", counts)])
    before = walk(totals, keys, [CHUNK], _counts_before(keys), carried)
    carry = before.select(
        *[F.col(c) if c in by else F.lit(None).cast(tagged.schema[c].dataType).alias(c) for c in [*columns, CHUNK]],
        "__before", F.lit(True).alias("__carry"),
    )
    rows = tagged.select(*columns, CHUNK, F.lit(None).cast(counts).alias("__before"), F.lit(False).alias("__carry"))
    both = rows.unionByName(carry).withColumn("__then", ~F.col("__carry"))
    return walk(both, by, ["__then", *order], _counting(by, sub_key, columns, name), schema)


def _counting(by: Sequence[str], sub_key: str, columns: Sequence[str], name: str):
    """Every row with the sorted counts of its group so far; rows that carry counts set them."""

    def step(batches):
        group, seen = None, {}
        for batch in batches:
            kind = pa.map_(batch.schema.field(sub_key).type, pa.int64())
            kept, maps = [], []
            rows = zip(
                groups(batch, by), batch.column(sub_key).to_pylist(),
                batch.column("__carry").to_pylist(), batch.column("__before").to_pylist(),
            )
            for i, (g, sub, carries, before) in enumerate(rows):
                if g != group:
                    group, seen = g, {}
                if carries:
                    seen = dict(before)
                    continue
                if sub is not None:
                    seen[sub] = seen.get(sub, 0) + 1
                kept.append(i)
                maps.append(sorted(seen.items()))
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*[own.column(c) for c in columns], pa.array(maps, kind)], names=[*columns, name]
            )

    return step


def _counts_before(by: Sequence[str]):
    """Every chunk with the counts of the chunks before it."""

    def step(batches):
        group, seen = None, {}
        for batch in batches:
            before = []
            for g, total in zip(groups(batch, by), batch.column("__total").to_pylist()):
                if g != group:
                    group, seen = g, {}
                before.append(list(seen.items()))
                for sub, n in total or ():
                    seen[sub] = seen.get(sub, 0) + n
            kind = batch.schema.field("__total").type
            columns = [batch.column(c) for c in [*by, CHUNK]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, kind)], names=[*by, CHUNK, "__before"])

    return step


def rolling_firsts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], entries: dict[str, Column], n: int,
    rows_per_chunk: int = ROWS_PER_CHUNK, costly: bool = False,
) -> DataFrame:
    """The ``n`` smallest entries of the key so far, as a sorted array per name.

    ``entries`` are comparable values, null where a row has none. Rows come in
    ``order``, which may be another one than that of the entries. The k-th
    smallest is a running minimum, and what it pushes out goes on to the next:
    ``n`` folds over one sort. Of a chunk of a heavy key only its last array is
    handed on.
    """
    tagged, split = tag_chunks(df, keys, order, rows_per_chunk, costly)
    by = [*keys, *([CHUNK] if split else [])]
    columns = df.columns
    local = _firsts(tagged, by, order, entries, n)
    if not split:
        return local.select(*columns, *entries)

    # One row per chunk of a heavy key, then a row per entry, in the order of chunks.
    totals = local.filter(F.col(LAST_CHUNK) > 0).groupBy(*by).agg(
        *[F.max_by(name, position(order)).alias(name) for name in entries]
    )
    laid = totals.withColumn("__place", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    again = {name: F.get(name, F.col("__place")) for name in entries}
    so_far = _firsts(
        laid.select(*by, "__place", *[x.alias(f"__entry_{i}") for i, x in enumerate(again.values())]),
        keys, [CHUNK, "__place"], {name: F.col(f"__entry_{i}") for i, name in enumerate(entries)}, n,
    ).filter(F.col("__place") == n - 1)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK)
    carry = so_far.select(
        *[F.col(k).alias(f"__carry_{i}") for i, k in enumerate(keys)],
        F.col(CHUNK).alias("__carry_chunk"),
        *[F.lag(name).over(earlier).alias(f"__{name}") for name in entries],
    )
    carry = narrow(carry, split, wide=True)
    pairs = [*[(k, f"__carry_{i}") for i, k in enumerate(keys)], (CHUNK, "__carry_chunk")]
    joined = local.join(carry, same_key(local, carry, pairs), "left")
    merged = [
        F.when(carry[f"__{name}"].isNull(), local[name])
        .otherwise(F.slice(F.array_sort(F.concat(carry[f"__{name}"], local[name])), 1, n)).alias(name)
        for name in entries
    ]
    return joined.select(*[local[c] for c in columns], *merged)


def _firsts(df: DataFrame, by: Sequence[str], order: Sequence[str], entries: dict[str, Column], n: int) -> DataFrame:
    ordered = Window.partitionBy(*by).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    found = df.withColumns({f"__in_{i}": x for i, x in enumerate(entries.values())})
    every = range(len(entries))
    for k in range(n):
        found = found.withColumns({f"__old_{i}": F.min(f"__in_{i}").over(before) for i in every})
        found = found.withColumns({f"__kept_{i}_{k}": F.least(f"__old_{i}", f"__in_{i}") for i in every})
        # What does not stay goes on; nothing does while there is room, or if nothing came.
        room = [F.col(f"__old_{i}").isNull() | F.col(f"__in_{i}").isNull() for i in every]
        found = found.withColumns(
            {f"__in_{i}": F.when(~room[i], F.greatest(f"__old_{i}", f"__in_{i}")) for i in every}
        )
    arrays = [F.array_compact(F.array(*[f"__kept_{i}_{k}" for k in range(n)])) for i in every]
    return found.select(*df.columns, *[a.alias(name) for a, name in zip(arrays, entries)])


def format_map(counts: Column) -> Column:
    """A count map as ``key=count, ...`` text in the order of its entries."""
    return F.array_join(
        F.transform(
            F.map_entries(counts),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
        ),
        ", ",
    )

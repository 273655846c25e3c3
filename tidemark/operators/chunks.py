"""Ordered per-key computations that survive a heavy key.

A window partitioned by key puts all rows of that key into one task. When one
key may hold a third of the table that task never ends, so rows of heavy keys
are cut into *chunks*: consecutive ranges of the key's order. Work is done per
(key, chunk), and what a chunk needs to know about earlier chunks (its carry)
comes from one small aggregate row per chunk.

* The cut points come from a hash sample of the rows, so every chunk has about
  ``rows_per_chunk`` rows whatever the distribution of keys and times. The
  sample only places the cuts; results always use all rows.
* There are about ``rows / rows_per_chunk`` cut points, in heavy keys only.
  They are counted before they are broadcast; the carries are one row per cut
  point and heavy key.
* Tables of all sizes take the same way: where nothing is cut, all rows are in
  chunk 0, and there is no carry to join.
* The wide input is shuffled once, by (key, chunk). Finding cuts and carries
  costs one more narrow read each, with map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

ROWS_PER_CHUNK = 4_000_000
SAMPLES_PER_CHUNK = 32
MAX_BOUNDS = 250_000  # cut points of a broadcast: twice this number at most

CHUNK = "__chunk"
LAST_CHUNK = "__last_chunk"


def position(order: Sequence[str]) -> Column:
    """The order columns as one comparable value."""
    return F.struct(*[F.col(c) for c in order])


def same_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of ``left[a]`` and ``right[b]`` for every pair."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def tag_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    costly: bool = False,
) -> tuple[DataFrame, int]:
    """Add ``__chunk`` (0, 1, ...) and ``__last_chunk`` to every row.

    ``costly`` says that ``df`` is more than a scan; it is then computed once,
    into the shared folder, before it is read several times.
    Returns the tagged rows and the number of cuts in all keys.
    """
    if costly:
        df = cut_lineage(df)
    every = max(1, rows_per_chunk // SAMPLES_PER_CHUNK)
    samples = (
        df.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0)
        .select(*keys, position(order).alias("__chunk_at"))
        .distinct()
        .withColumn(
            "__chunk_rank",
            F.row_number().over(Window.partitionBy(*keys).orderBy("__chunk_at")),
        )
    )
    bounds = (
        samples.filter(F.col("__chunk_rank") % SAMPLES_PER_CHUNK == 0)
        .groupBy(*[F.col(k).alias(f"__split_{i}") for i, k in enumerate(keys)])
        .agg(F.array_sort(F.collect_set("__chunk_at")).alias("__chunk_bounds"))
    )
    bounds = cut_lineage(bounds)  # read below by the rows and by the carries
    size = F.size("__chunk_bounds")
    total, most = bounds.agg(
        F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))
    ).first()
    if total == 0:  # no key is heavy
        return df.withColumns({CHUNK: F.lit(0), LAST_CHUNK: F.lit(0)}), 0
    if not keys:
        found = df.withColumn("__chunk_bounds", bounds.scalar())
    else:
        on = same_key(df, bounds, [(k, f"__split_{i}") for i, k in enumerate(keys)])
        small = total <= 2 * MAX_BOUNDS
        found = df.join(F.broadcast(bounds) if small else bounds, on, "left")
    return _with_chunk(found, df.columns, order, most.bit_length()), total


def _with_chunk(df: DataFrame, columns: Sequence[str], order: Sequence[str], halves: int) -> DataFrame:
    """Number the row's chunk: how many of the sorted bounds are <= its position.

    A binary search, one projection per halving step of the longest array. All steps are compiled
    into the stage that reads the rows, so the array of bounds is only pointed
    at there, and never copied into a row.
    """
    found = df.withColumns({"__chunk_at": position(order), "__chunk_passed": F.lit(0)})
    for i in reversed(range(halves)):
        step = 1 << i
        bound = F.get("__chunk_bounds", F.col("__chunk_passed") + (step - 1))
        found = found.withColumn(
            "__chunk_passed",
            F.col("__chunk_passed") + F.when(bound <= F.col("__chunk_at"), step).otherwise(0),
        )
    return found.select(
        *columns,
        F.col("__chunk_passed").alias(CHUNK),
        # The size of null is -1 where ANSI mode is off.
        F.when(F.col("__chunk_bounds").isNull(), 0).otherwise(F.size("__chunk_bounds")).alias(LAST_CHUNK),
    )


@dataclass(frozen=True)
class Fold:
    """A named associative fold of ``value``.

    Kinds: ``count`` (non-null values), ``sum``, ``min``, ``max``, ``last``
    (last non-null value) and ``list`` (all values in order).
    """

    name: str
    kind: str
    value: Column

    def over(self, window) -> Column:
        if self.kind == "count":
            return F.count(self.value).over(window)
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        if self.kind == "list":
            return F.collect_list(self.value).over(window)
        return _PLAIN[self.kind](self.value).over(window)

    def total(self, at: Column) -> Column:
        if self.kind == "count":
            return F.count(self.value)
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), at))
        if self.kind == "list":
            pair = F.struct(at.alias("at"), self.value.alias("v"))
            pairs = F.array_sort(F.collect_list(F.when(self.value.isNotNull(), pair)))
            return F.transform(pairs, lambda p: p["v"])
        return _PLAIN[self.kind](self.value)

    def before(self, total: Column, window) -> Column:
        """Fold of the totals of all earlier chunks."""
        if self.kind == "count":
            return F.coalesce(F.sum(total).over(window), F.lit(0))
        if self.kind == "last":
            return F.last(total, ignorenulls=True).over(window)
        if self.kind == "list":
            return F.flatten(F.collect_list(total).over(window))
        return _PLAIN[self.kind](total).over(window)

    def join(self, carry: Column, local: Column) -> Column:
        if self.kind == "count":
            return F.coalesce(carry, F.lit(0)) + local
        if self.kind == "sum":
            return F.coalesce(carry + local, carry, local)
        if self.kind == "last":
            return F.coalesce(local, carry)
        if self.kind == "list":
            return F.when(carry.isNull(), local).otherwise(F.concat(carry, local))
        return F.least(carry, local) if self.kind == "min" else F.greatest(carry, local)

    def merged(self, part: Column) -> Column:
        """Aggregate that combines partial totals of one group."""
        if self.kind in ("count", "sum"):
            return F.sum(part)
        if self.kind in ("min", "max"):
            return _PLAIN[self.kind](part)
        raise ValueError(f"{self.kind} cannot be merged without an order")


_PLAIN = {"sum": F.sum, "min": F.min, "max": F.max}


def narrow(carry: DataFrame, cuts: int, wide: bool = False) -> DataFrame:
    """Broadcast rows per chunk if they are few and of bounded width."""
    return F.broadcast(carry) if cuts <= 2 * MAX_BOUNDS and not wide else carry


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Sequence[Fold],
    *,
    exclusive: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    costly: bool = False,
) -> DataFrame:
    """One output row per input row, with each fold over the key's rows so far.

    ``order`` must be unique within a key. ``exclusive`` leaves the row itself
    out. ``keys`` may be empty: the whole table is then one key.
    """
    tagged, split = tag_chunks(df, keys, order, rows_per_chunk, costly)
    last = -1 if exclusive else Window.currentRow
    ordered = Window.partitionBy(*keys, *([CHUNK] if split else [])).orderBy(*order)
    frame = ordered.rowsBetween(Window.unboundedPreceding, last)
    columns = [c for c in tagged.columns if c not in (CHUNK, LAST_CHUNK)]
    local = tagged.select("*", *[f.over(frame).alias(f.name) for f in folds])
    if not split:
        return local.select(*columns, *[f.name for f in folds])

    totals = (
        tagged.filter(F.col(LAST_CHUNK) > 0)
        .groupBy(*keys, CHUNK)
        .agg(*[f.total(position(order)).alias(f.name) for f in folds])
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *[F.col(k).alias(f"__carry_{i}") for i, k in enumerate(keys)],
        F.col(CHUNK).alias("__carry_chunk"),
        *[f.before(F.col(f.name), earlier).alias(f"__{f.name}") for f in folds],
    )
    # One row per chunk of a split key.
    carry = narrow(carry, split, wide=any(f.kind == "list" for f in folds))
    pairs = [(k, f"__carry_{i}") for i, k in enumerate(keys)]
    joined = local.join(
        carry, same_key(local, carry, [*pairs, (CHUNK, "__carry_chunk")]), "left"
    )
    return joined.select(
        *[local[c] for c in columns],
        *[f.join(carry[f"__{f.name}"], local[f.name]).alias(f.name) for f in folds],
    )


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    enter: Column,
    leave: Column,
    breaks: Callable[[Column, Column], Column],
    folds: Sequence[Fold],
    first_enter: str,
    last_leave: str,
    labels: Sequence[str] = (),
    keep_open: bool = True,
    tagged: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    costly: bool = False,
) -> DataFrame:
    """Collapse consecutive rows of a key into one row per island.

    A new island starts where ``breaks(leave of the previous row, enter of this
    row)`` holds. ``labels`` are columns that have one value within an island and
    are passed on. ``first_enter`` and ``last_leave`` name the labels or folds
    that equal the enter of the first and the leave of the last row of an
    island. ``keep_open=False`` drops the last island of each key, which no
    later row has closed.

    Only the first and last island of a chunk can go on in a neighbour, so only
    those are merged across chunks, two rows per chunk of a heavy key.
    ``tagged`` says that ``df`` has its chunks already, and if there are any.
    """
    if tagged is None:
        df, split = tag_chunks(df, keys, order, rows_per_chunk, costly)
    else:
        split = tagged
    part = [*keys, *([CHUNK, LAST_CHUNK] if split else [])]
    ordered = Window.partitionBy(*part).orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumns({"__enter": enter, "__leave": leave})
    rows = rows.withColumns(
        {
            "__starts": F.lag(F.lit(1)).over(ordered).isNull()
            | breaks(F.lag("__leave").over(ordered), F.col("__enter")),
            "__tail": F.lead(F.lit(1)).over(ordered).isNull(),
        }
    ).withColumn("__island", F.count(F.when(F.col("__starts"), 1)).over(so_far))
    local = rows.groupBy(*part, "__island", *labels).agg(
        *[f.total(position(order)).alias(f.name) for f in folds],
        F.max("__tail").alias("__tail"),
    )
    names = [*labels, *[f.name for f in folds]]
    if not split:
        if not keep_open:
            local = local.filter(~F.col("__tail"))
        return local.select(*keys, *names)

    heavy = F.col(LAST_CHUNK) > 0
    at_edge = (F.col("__island") == 1) | F.col("__tail")
    inner = local.filter(~(heavy & at_edge))
    if not keep_open:
        inner = inner.filter(heavy | ~F.col("__tail"))

    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK, "__island")
    edges = (
        local.filter(heavy)
        .filter(at_edge)
        .withColumn(
            "__starts",
            F.lag(F.lit(1)).over(by_chunk).isNull()
            | (F.lag(CHUNK).over(by_chunk) == F.col(CHUNK))
            | breaks(F.lag(last_leave).over(by_chunk), F.col(first_enter)),
        )
        .withColumn(
            "__group",
            F.count(F.when(F.col("__starts"), 1)).over(
                by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .groupBy(*keys, "__group", *labels)
        .agg(
            *[f.merged(F.col(f.name)).alias(f.name) for f in folds],
            F.max(F.col("__tail") & (F.col(CHUNK) == F.col(LAST_CHUNK))).alias("__open"),
        )
    )
    if not keep_open:
        edges = edges.filter(~F.col("__open"))
    return inner.select(*keys, *names).unionByName(edges.select(*keys, *names))

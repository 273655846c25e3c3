"""Event-time windows: assigners and the aggregates computed per pane.

Panes are ``[start, end)`` and aligned to the epoch in UTC. Static tables carry
event time as epoch milliseconds; the functions named ``*_stream`` take a
timestamp column with a watermark and use the built-in window functions.

Every aggregate here is a built-in one with a map-side part, so neither a
global window nor a heavy key puts its rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.chunks import (
    CHUNK,
    LAST_CHUNK,
    ROWS_PER_CHUNK,
    Fold,
    islands,
    running,
    same_key,
    tag_chunks,
)

W_START = "w_start"
W_END = "w_end"


# -- assigners ---------------------------------------------------------------


def pane_start(ts_ms: Column, size: int) -> Column:
    return ts_ms - F.pmod(ts_ms, F.lit(size))


def bucket(value: Column, width: int) -> Column:
    """Number of the bucket of this width; rounds down, below zero too."""
    return F.call_function("div", pane_start(value, width), F.lit(width).cast("bigint"))


def tumbling(df: DataFrame, ts_ms: str, size: int) -> DataFrame:
    """Add the bounds of the row's pane. Rows without a time are in no pane."""
    start = pane_start(F.col(ts_ms), size)
    return _timed(df, ts_ms).withColumns({W_START: start, W_END: start + size})


def _timed(df: DataFrame, ts_ms: str) -> DataFrame:
    return df.filter(F.col(ts_ms).isNotNull())


def _without_order(folds: Sequence[Fold]) -> None:
    """Panes are merged from partial aggregates, which have no order."""
    for f in folds:
        if f.kind in ("last", "list"):
            raise ValueError(f"{f.name}: use extreme_tumbling or collect_panes for {f.kind!r} of a pane")


def _starts(first_covered: Column, last_covered: Column, size: int, slide: int) -> Column:
    """Starts of the sliding panes that hold [first_covered, last_covered]."""
    last = pane_start(first_covered, slide)
    first = last - bucket(last - (last_covered - size + 1), slide) * slide
    return F.when(
        last + size > last_covered, F.sequence(first, last, F.lit(slide).cast("bigint"))
    )


def sliding(df: DataFrame, ts_ms: str, size: int, slide: int) -> DataFrame:
    """One copy of the row for each pane it lies in.

    ``slide`` need not divide ``size``. Filter first: a row has about
    ``size / slide`` copies.
    """
    starts = _starts(F.col(ts_ms), F.col(ts_ms), size, slide)
    return _timed(df, ts_ms).withColumn(W_START, F.explode(starts)).withColumn(
        W_END, F.col(W_START) + size
    )


# -- aggregates over tumbling and sliding panes --------------------------------


def aggregate_tumbling(
    df: DataFrame, keys: Sequence[str], ts_ms: str, size: int, folds: Sequence[Fold]
) -> DataFrame:
    _without_order(folds)
    return _in_panes(
        _timed(df, ts_ms).groupBy(*keys, pane_start(F.col(ts_ms), size).alias(W_START)).agg(
            *[f.total(F.lit(None)).alias(f.name) for f in folds]
        ),
        keys,
        size,
        folds,
    )


def aggregate_sliding(
    df: DataFrame, keys: Sequence[str], ts_ms: str, size: int, slide: int,
    folds: Sequence[Fold],
) -> DataFrame:
    """Sliding panes assembled from slices that all of their panes share.

    A slice is as wide as the greatest common divisor of size and slide. Rows
    are first aggregated per slice and only slices are copied to their panes,
    so the copies no longer grow with the rows.
    """
    _without_order(folds)
    step = gcd(size, slide)
    slices = _timed(df, ts_ms).groupBy(*keys, pane_start(F.col(ts_ms), step).alias("__slice")).agg(
        *[f.total(F.lit(None)).alias(f.name) for f in folds]
    )
    starts = _starts(F.col("__slice"), F.col("__slice") + step - 1, size, slide)
    panes = (
        slices.withColumn(W_START, F.explode(starts))
        .groupBy(*keys, W_START)
        .agg(*[f.merged(F.col(f.name)).alias(f.name) for f in folds])
    )
    return _in_panes(panes, keys, size, folds)


def _in_panes(df: DataFrame, keys: Sequence[str], size: int, folds: Sequence[Fold]) -> DataFrame:
    return df.select(
        *keys, W_START, (F.col(W_START) + size).alias(W_END), *[f.name for f in folds]
    )


def count_fold(name: str = "n") -> Fold:
    return Fold(name, "count", F.lit(1))


def min_max_folds(value: Column, low: str = "low", high: str = "high") -> list[Fold]:
    return [Fold(low, "min", value), Fold(high, "max", value)]


def average_tumbling(
    df: DataFrame, keys: Sequence[str], ts_ms: str, size: int, value: Column,
    name: str = "mean",
) -> DataFrame:
    """Mean per key and pane from a (sum, count) pair."""
    folds = [Fold("__sum", "sum", value), Fold("__n", "count", value)]
    return aggregate_tumbling(df, keys, ts_ms, size, folds).select(
        *keys, W_START, W_END, (F.col("__sum") / F.col("__n")).alias(name)
    )


def extreme_tumbling(
    df: DataFrame, keys: Sequence[str], ts_ms: str, size: int, value: Column,
    order: Sequence[str], record: Sequence[str], largest: bool,
) -> DataFrame:
    """The record with the smallest or largest value per pane; ties: the earlier.

    ``value`` and the ``order`` columns must be numeric.
    """
    position = [-F.col(c) if largest else F.col(c) for c in order]
    ranked = F.struct(value.alias("v"), *[p.alias(f"o{i}") for i, p in enumerate(position)])
    pick = F.max_by if largest else F.min_by
    picked = pick(F.struct(*record), ranked)
    panes = _timed(df, ts_ms).groupBy(*keys, pane_start(F.col(ts_ms), size).alias(W_START)).agg(
        picked.alias("__record")
    )
    return panes.select(
        *keys, W_START, (F.col(W_START) + size).alias(W_END),
        *[F.col(f"__record.{c}").alias(c) for c in record],
    )


def peak_pane(
    panes: DataFrame, size: int, count: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Panes re-windowed; the fullest pane of each outer pane, ties: the earlier.

    A pane's own event time is its last millisecond.
    """
    outer = panes.withColumn("__t", F.col(W_END) - 1)
    found = outer.groupBy(*keys, pane_start(F.col("__t"), size).alias("outer_start")).agg(
        F.max_by(
            F.struct(W_START, W_END, count),
            F.struct(F.col(count), -F.col(W_START)),
        ).alias("__peak")
    )
    return found.select(
        *keys, "outer_start", (F.col("outer_start") + size).alias("outer_end"),
        *[F.col(f"__peak.{c}").alias(c) for c in (W_START, W_END, count)],
    )


def collect_panes(
    panes: DataFrame, keys: Sequence[str], order: Sequence[str], item: Column,
    part_size: int = 10_000, separator: str = ", ", **split,
) -> DataFrame:
    """The elements of each pane, in order, as text.

    A pane without a size bound is delivered in numbered parts of at most
    ``part_size`` elements; ``n_upto`` is the size of the pane up to and
    including the part, so the last part has the size of the pane.
    """
    pane = [*keys, W_START, W_END]
    numbered = running(
        panes.withColumn("__item", item), pane, order, [count_fold("__at")], **split
    )
    return (
        numbered.withColumn("part", bucket(F.col("__at") - 1, part_size))
        .groupBy(*pane, "part")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.max("__at").alias("n_upto"),
            F.array_sort(F.collect_list(F.struct("__at", "__item"))).alias("__items"),
        )
        .withColumn("items", F.array_join(F.col("__items.__item"), separator))
        .drop("__items")
    )


def first_of_each(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, item: Column,
    name: str = "items", separator: str = ", ",
) -> DataFrame:
    """The first ``n`` items of every group as text.

    The rank filter is applied on the map side as well, so at most ``n`` rows
    per group and task are shuffled.
    """
    ranked = df.select(
        *keys,
        item.alias("__item"),
        F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("__rank"),
    ).filter(F.col("__rank") <= n)
    picked = F.array_sort(F.collect_list(F.struct("__rank", "__item")))
    return ranked.groupBy(*keys).agg(
        F.array_join(picked["__item"], separator).alias(name)
    )


# -- sessions ------------------------------------------------------------------


def sessions(
    df: DataFrame, keys: Sequence[str], ts_ms: str, gap: int,
    folds: Sequence[Fold] | None = None, rows_per_chunk: int = ROWS_PER_CHUNK,
    costly: bool = False,
) -> DataFrame:
    """Session panes ``[first, last + gap)``; touching sessions are one.

    Rows in the same ``gap`` of time are in one session anyway, so rows are
    first aggregated (with a map-side part) to one per key and such bucket.
    Sessions are islands of these buckets. Rows without a time are in no session.
    """
    folds = list(folds if folds is not None else [count_fold()])
    _without_order(folds)
    ts = F.col(ts_ms)
    tagged, split = tag_chunks(
        _timed(df, ts_ms).withColumn("__bucket", bucket(ts, gap)), keys, ["__bucket"],
        rows_per_chunk, costly,
    )
    buckets = tagged.groupBy(*keys, CHUNK, LAST_CHUNK, "__bucket").agg(
        F.min(ts).alias("__first"),
        F.max(ts).alias("__last"),
        *[f.total(F.lit(None)).alias(f.name) for f in folds],
    )
    found = islands(
        buckets,
        keys,
        ["__bucket"],
        enter=F.col("__first"),
        leave=F.col("__last"),
        breaks=lambda last, first: first - last > gap,
        folds=[
            Fold(W_START, "min", F.col("__first")),
            Fold("__last", "max", F.col("__last")),
            *[Fold(f.name, "sum" if f.kind == "count" else f.kind, F.col(f.name)) for f in folds],
        ],
        first_enter=W_START,
        last_leave="__last",
        tagged=split,
    )
    return found.select(
        *keys, W_START, (F.col("__last") + gap).alias(W_END), *[f.name for f in folds]
    )


def in_sessions(
    df: DataFrame, keys: Sequence[str], ts_ms: str, gap: int, **split
) -> DataFrame:
    """Add the bounds of the row's session; ``collect_panes`` then lists its elements.

    All rows of a key in the same ``gap`` of time are in one session, so rows
    find theirs by an equi-join on that bucket. A session is copied to the
    buckets it spans, of which at least every second one has rows. Rows without
    a time are in no session.
    """
    found = sessions(df, keys, ts_ms, gap, [], **split)
    spanned = F.sequence(bucket(F.col(W_START), gap), bucket(F.col(W_END) - gap, gap))
    spans = found.select(
        *[F.col(k).alias(f"__session_{i}") for i, k in enumerate(keys)],
        W_START, W_END, F.explode(spanned).alias("__session_bucket"),
    )
    rows = _timed(df, ts_ms).withColumn("__bucket", bucket(F.col(ts_ms), gap))
    pairs = [(k, f"__session_{i}") for i, k in enumerate(keys)]
    joined = rows.join(spans, same_key(rows, spans, [*pairs, ("__bucket", "__session_bucket")]))
    return joined.select(*[rows[c] for c in df.columns], W_START, W_END)


# -- on streams ----------------------------------------------------------------


def stream_panes(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str | None = None
):
    """Grouping of a watermarked stream (or table) by key and pane."""
    return df.groupBy(*keys, F.window(ts, size, slide) if slide else F.window(ts, size))


def stream_sessions(df: DataFrame, keys: Sequence[str], ts: str, gap: str):
    """Grouping by key and session.

    A global session on a stream still needs a grouping key, and one that is
    not a constant.
    """
    if not keys:
        return df.withColumn("__all", F.pmod(F.hash(ts), F.lit(1))).groupBy(
            "__all", F.session_window(ts, gap)
        )
    return df.groupBy(*keys, F.session_window(ts, gap))


def stream_rewindow(panes: DataFrame, size: str, window: str = "window"):
    """Grouping of window results by a further window."""
    return panes.groupBy(F.window(F.col(window), size))


def pane_bounds(window: str = "window") -> list[Column]:
    """Bounds of a built-in window as epoch milliseconds."""
    return [
        F.unix_millis(F.col(f"{window}.start")).alias(W_START),
        F.unix_millis(F.col(f"{window}.end")).alias(W_END),
    ]

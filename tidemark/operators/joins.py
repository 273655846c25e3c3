"""Joins of two event tables: by time interval, by pane and one to one."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.chunks import (
    MAX_BOUNDS,
    ROWS_PER_CHUNK,
    SAMPLES_PER_CHUNK,
    Fold,
    running,
    same_key,
)
from tidemark.operators.windows import bucket, pane_start
from tidemark.session import cut_lineage


PAIRS_PER_CELL = 100_000_000


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _group_sizes(df: DataFrame, on: Sequence[str], row_id: Sequence[str], every: int, name: str) -> DataFrame:
    """Rows of each join group, estimated from a hash sample of one row in ``every``."""
    return (
        df.filter(F.pmod(F.xxhash64(*row_id), F.lit(every)) == 0)
        .groupBy(*on)
        .agg((F.count(F.lit(1)) * every).alias(name))
    )


def _grid(left: DataFrame, right: DataFrame, on: Sequence[str], every: int, pairs_per_cell: int) -> DataFrame:
    """Parts on either side of groups with more pairs than a cell may have.

    A side is cut only as far as it is long: the shorter one into parts of the
    square root of the budget, the longer one so that a cell keeps the budget.
    A group that is in the sample of one side only counts as ``every`` rows on
    the other.
    """
    side = isqrt(pairs_per_cell) or 1
    sizes = left.join(right, list(on), "full").select(
        *on, F.coalesce("__l", F.lit(every)).alias("l"), F.coalesce("__r", F.lit(every)).alias("r")
    )
    short, long = F.least("l", "r"), F.greatest("l", "r")
    few = F.ceil(short / side)
    many = F.ceil(long * (short / few) / pairs_per_cell)
    return sizes.filter((F.col("l").cast("double") * F.col("r")) > pairs_per_cell).select(
        *on,
        F.when(F.col("l") >= F.col("r"), many).otherwise(few).alias("__l"),
        F.when(F.col("l") >= F.col("r"), few).otherwise(many).alias("__r"),
    )


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str],
    left_id: Sequence[str], right_id: Sequence[str],
    condition: Column | None = None, pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Inner equi-join that cuts heavy join groups into a grid of cells.

    Both sides have the ``on`` columns; all other column names must differ.
    Rows of a heavy group get a part on their own side and a copy for each part
    of the other side, so every pair of rows meets in exactly one cell, and a
    cell has about ``pairs_per_cell`` pairs at most. The sample decides only how
    a group is cut, never which rows are joined.
    """
    left, right = (df.dropna(subset=list(on)) for df in (left, right))
    every = max(1, isqrt(pairs_per_cell) // SAMPLES_PER_CHUNK)
    parts = cut_lineage(  # read by both sides
        _grid(
            _group_sizes(left, on, left_id, every, "__l"), _group_sizes(right, on, right_id, every, "__r"),
            on, every, pairs_per_cell,
        )
    )
    cells: list[str] = []
    if heavy := parts.count():
        if heavy <= 2 * MAX_BOUNDS:
            parts = F.broadcast(parts)
        left = _cells(left, parts, on, left_id, own="__l", other="__r")
        right = _cells(right, parts, on, right_id, own="__r", other="__l")
        cells = ["__l", "__r"]
    joined = left.join(right, [*on, *cells], "inner").drop(*cells)
    return joined if condition is None else joined.filter(condition)


def _cells(df: DataFrame, parts: DataFrame, on: Sequence[str], row_id: Sequence[str], own: str, other: str) -> DataFrame:
    sizes = parts.select(
        *[F.col(c).alias(f"__on_{i}") for i, c in enumerate(on)],
        F.coalesce(own, F.lit(1)).alias("__own"),
        F.coalesce(other, F.lit(1)).alias("__other"),
    )
    marked = df.join(
        sizes,
        same_key(df, sizes, [(c, f"__on_{i}") for i, c in enumerate(on)]),
        "left",
    )
    return marked.select(
        *[df[c] for c in df.columns],
        F.pmod(F.xxhash64(*row_id), F.coalesce("__own", F.lit(1))).alias(own),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("__other", F.lit(1)) - 1)).alias(other),
    )


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
    lower: int, upper: int, left_id: Sequence[str], right_id: Sequence[str], **salt,
) -> DataFrame:
    """Pairs of equal key with ``right_ts`` in ``[left_ts + lower, left_ts + upper]``.

    Time buckets as wide as the interval are part of the join key, so that a
    key is spread over its time range; a left row is copied to the two (at most
    three) buckets its interval touches and a right row is in one. ``joined_ts``
    is the later of both times.
    """
    width = max(upper - lower, 1)
    first = bucket(F.col(left_ts) + lower, width)
    last = bucket(F.col(left_ts) + upper, width)
    spread = left.withColumn("__bucket", F.explode(F.sequence(first, last)))
    bucketed = right.withColumn("__bucket", bucket(F.col(right_ts), width))
    within = F.col(right_ts).between(F.col(left_ts) + lower, F.col(left_ts) + upper)
    return (
        salted_join(
            spread, bucketed, [key, "__bucket"], left_id, right_id, within, **salt
        )
        .drop("__bucket")
        .withColumn("joined_ts", F.greatest(left_ts, right_ts))
    )


def window_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: int,
    left_id: Sequence[str], right_id: Sequence[str], **salt,
) -> DataFrame:
    """All pairs of equal key within the same tumbling pane."""
    in_left = left.withColumn("w_start", pane_start(F.col(left_ts), size))
    in_right = right.withColumn("w_start", pane_start(F.col(right_ts), size))
    return salted_join(
        in_left, in_right, [key, "w_start"], left_id, right_id, **salt
    ).withColumn("w_end", F.col("w_start") + size)


def window_pairs(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: int,
    left_id: str, right_id: str, **split,
) -> DataFrame:
    """(key, w_start, pairs, apart_ms): the pairs of a window join, without making them.

    ``apart_ms`` is the sum of the time between the two rows of all pairs. In
    order of time, a row is apart from the earlier rows of the other side by
    their number times its own time less the sum of theirs, so two running folds
    per side replace the pairs. Ids have one type and are unique within a side.
    """
    def side(df: DataFrame, ts: str, row_id: str, is_left: bool) -> DataFrame:
        start = pane_start(F.col(ts), size)
        return df.select(
            key, start.alias("w_start"), (F.col(ts) - start).alias("__at"),
            F.lit(is_left).alias("__left"), F.col(row_id).alias("__id"),
        ).dropna(subset=[key, "w_start"])

    both = side(left, left_ts, left_id, True).unionByName(side(right, right_ts, right_id, False))
    folds = [
        Fold(f"__{kind}_{name}", kind, F.when(F.col("__left") == is_left, F.col("__at")))
        for name, is_left in (("left", True), ("right", False))
        for kind in ("count", "sum")
    ]
    seen = running(both, [key, "w_start"], ["__at", "__left", "__id"], folds, exclusive=True, **split)

    def apart(name: str) -> Column:
        return F.col(f"__count_{name}") * F.col("__at") - F.coalesce(f"__sum_{name}", F.lit(0))

    return seen.groupBy(key, "w_start").agg(
        (F.count(F.when(F.col("__left"), 1)) * F.count(F.when(~F.col("__left"), 1))).alias("pairs"),
        F.sum(F.when(F.col("__left"), apart("right")).otherwise(apart("left"))).alias("apart_ms"),
    ).filter("pairs > 0")


def interval_join_stream(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    left_ts: str, right_ts: str, lower_ms: int, upper_ms: int,
) -> DataFrame:
    """The interval join of two watermarked streams; state is bounded by both."""
    low = F.expr(f"{left_ts} + INTERVAL '{lower_ms / 1000}' SECOND")
    high = F.expr(f"{left_ts} + INTERVAL '{upper_ms / 1000}' SECOND")
    condition = (F.col(left_key) == F.col(right_key)) & F.col(right_ts).between(low, high)
    return left.join(right, condition).withColumn(
        "joined_ts", F.greatest(left_ts, right_ts)
    )


def window_join_stream(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: str
) -> DataFrame:
    """The window join of two watermarked streams.

    Only the pane goes on as event time; both times are plain columns after it.
    """

    def in_panes(df: DataFrame, ts: str) -> DataFrame:
        plain = F.timestamp_micros(F.unix_micros(ts))
        return df.withColumn("window", F.window(ts, size)).withColumn(ts, plain)

    return in_panes(left, left_ts).join(in_panes(right, right_ts), [key, "window"])


ON_TIME = "on_time"
LATE = "late"


def delivery_status(order_ms: Column, delivery_ms: Column, limit_ms: int) -> Column:
    """On time means strictly before the deadline; there is no lower bound."""
    return F.when(delivery_ms < order_ms + limit_ms, ON_TIME).otherwise(LATE)


def match_deliveries(
    orders: DataFrame, deliveries: DataFrame, order_id: str, delivery_order_id: str,
    order_ms: str, delivery_ms: str, limit_ms: int, number: str = "class_number",
    expire_ms: int | None = None, rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """One-to-one match of orders and deliveries, classified and numbered.

    Orders and deliveries of an id come in the order of their times (orders first
    where these are equal). Each is kept until one of the other side comes, which
    uses it up; a later one of its own side takes its place. What has been kept
    for ``expire_ms`` is forgotten. Null ids match nothing.

    So a row is matched with the row before it, if that is of the other side and
    was not matched itself: in a run of rows that could be, it is every second.
    The running number of a class follows delivery time and order id. There are
    only two classes, so numbering is chunked, as the ids are.
    """
    nothing = [F.lit(None).cast(x.select(F.struct(*x.columns)).schema[0].dataType) for x in (orders, deliveries)]
    sides = []
    for side, (df, key, at) in enumerate(((orders, order_id, order_ms), (deliveries, delivery_order_id, delivery_ms))):
        whole = F.struct(*df.columns)
        own = [whole if i == side else none for i, none in enumerate(nothing)]
        sides.append(df.filter(F.col(key).isNotNull()).select(
            F.col(key).alias("__id"), F.col(at).alias("__t"), F.lit(side).alias("__side"),
            F.xxhash64(*df.columns).alias("__tie"), own[0].alias("__o"), own[1].alias("__d"),
        ))
    order = ["__t", "__side", "__tie"]
    before = F.struct("__t", "__side", "__o", "__d")
    seen = running(
        sides[0].unionByName(sides[1]), ["__id"], order,
        [Fold("__before", "last", before), Fold("__n", "count", F.lit(1))],
        exclusive=True, rows_per_chunk=rows_per_chunk, costly=True,
    )
    fits = F.col("__side") != F.col("__before.__side")
    if expire_ms is not None:
        fits = fits & (F.col("__t") - F.col("__before.__t") < expire_ms)
    ready = seen.withColumn("__fits", F.coalesce(fits, F.lit(False)))
    paired = running(
        ready, ["__id"], order, [Fold("__run", "last", F.when(~F.col("__fits"), F.col("__n")))],
        rows_per_chunk=rows_per_chunk, costly=True,
    ).filter(F.col("__fits") & ((F.col("__n") - F.col("__run")) % 2 == 1))
    matched = paired.select(
        F.coalesce("__o", "__before.__o").alias("o"), F.coalesce("__d", "__before.__d").alias("d")
    ).select("o.*", "d.*").withColumns(
        {
            "deadline_ms": F.col(order_ms) + limit_ms,
            "status": delivery_status(F.col(order_ms), F.col(delivery_ms), limit_ms),
        }
    )
    return running(
        matched,
        ["status"],
        [delivery_ms, order_id],
        [Fold(number, "count", F.lit(1))],
        rows_per_chunk=rows_per_chunk,
        costly=True,
    )

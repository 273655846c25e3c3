"""Outputs fired by counts and thresholds instead of by the end of a pane.

A trigger is a condition on what has been seen so far, so each one is a running
fold and a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.chunks import (
    CHUNK,
    LAST_CHUNK,
    ROWS_PER_CHUNK,
    Fold,
    running,
    same_key,
    tag_chunks,
)
from tidemark.operators.rolling import rolling_firsts
from tidemark.operators.windows import W_END, W_START, count_fold


def every_nth(
    panes: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
    item: Column | None = None, **split,
) -> DataFrame:
    """Fire on every n-th element of a pane; a remainder never fires.

    ``n_so_far`` is the number of elements the firing sees. With ``item`` they
    are listed too, which is quadratic in the pane by definition.
    """
    pane = [*keys, W_START, W_END]
    folds = [count_fold("n_so_far")]
    if item is not None:
        folds.append(Fold("items", "list", item))
    return running(panes, pane, order, folds, **split).filter(
        F.col("n_so_far") % n == 0
    )


def over_threshold(
    df: DataFrame, store: str, app: str, order: Sequence[str], event_type: Column,
    install: str = "install", uninstall: str = "uninstall",
    installs: int = 100, uninstalls: int = 50,
    fire_types: Sequence[str] | None = None, edge_only: bool = False, **split,
) -> DataFrame:
    """Rows on which an app is already over a threshold of installs or uninstalls.

    Counts are those before the row, and nothing is purged, so every later row
    of the app fires whatever its type. ``fire_types`` limits the types that
    fire; ``edge_only`` keeps only the first firing of each app.
    """
    is_install = event_type == install
    is_uninstall = event_type == uninstall
    counted = running(
        df,
        [store, app],
        order,
        [
            Fold("installs_before", "count", F.when(is_install, 1)),
            Fold("uninstalls_before", "count", F.when(is_uninstall, 1)),
        ],
        exclusive=True,
        **split,
    )
    before_i, before_u = F.col("installs_before"), F.col("uninstalls_before")
    over = (before_i >= installs) | (before_u >= uninstalls)
    if fire_types is not None:
        over = over & event_type.isin(*fire_types)
    fired = counted.filter(over)
    if edge_only:
        columns = fired.columns
        first = F.min_by(F.struct(*columns), F.struct(*order)).alias("__first")
        fired = fired.groupBy(store, app).agg(first).select(
            *[F.col(f"__first.{c}").alias(c) for c in columns]
        )
    return fired


def first_apps_so_far(
    fired: DataFrame, df: DataFrame, store: str, app: str, order: Sequence[str],
    event_type: str, types: Sequence[str], n: int = 3,
    event_time: Sequence[str] | None = None, **split,
) -> DataFrame:
    """For each firing: the first ``n`` apps per event type the store had by then.

    ``order`` is the order of arrival. The first are those first by
    ``event_time``, ties by arrival, among all that have arrived; without it,
    arrival order is taken as event-time order. Then at most ``n`` rows per store
    and type are joined, and those after the firing left out. Otherwise firings
    are rows of the store's sequence, and see what the rows before them left.
    """
    if event_time is not None:
        return _first_by_time(fired, df, store, app, order, event_type, types, n, event_time, **split)
    firsts = df.filter(F.col(event_type).isin(*types)).withColumn(
        "__entry", F.struct(F.struct(*order).alias("at"), F.col(app).alias("app"))
    )
    ranked = _first_entries(firsts, [store, event_type], order, n)
    per_store = ranked.groupBy(F.col(store).alias("__store")).agg(
        *[
            F.array_sort(
                F.collect_list(F.when(F.col(event_type) == t, F.col("__entry")))
            ).alias(f"__first_{i}")
            for i, t in enumerate(types)
        ]
    )
    now = F.struct(*order)
    joined = fired.join(
        per_store, fired[store].eqNullSafe(per_store["__store"]), "left"
    )
    return joined.select(
        *[fired[c] for c in fired.columns],
        *[
            F.array_join(
                F.transform(
                    F.filter(f"__first_{i}", lambda e: e["at"] <= now), lambda e: e["app"]
                ),
                ", ",
            ).alias(f"first_{t}")
            for i, t in enumerate(types)
        ],
    )


def _first_by_time(
    fired: DataFrame, df: DataFrame, store: str, app: str, order: Sequence[str],
    event_type: str, types: Sequence[str], n: int, event_time: Sequence[str], **split,
) -> DataFrame:
    at = [F.col(c).alias(f"__at_{i}") for i, c in enumerate(order)]
    places = [f"__at_{i}" for i in range(len(order))]
    firing = fired.select(
        F.col(store).alias("__store"), *at, F.lit(1).alias("__fires"), F.struct(*fired.columns).alias("__row")
    )
    row = firing.schema["__row"].dataType
    entry = F.struct(
        *[F.col(c).alias(f"t{i}") for i, c in enumerate([*event_time, *order])], F.col(app).alias("app")
    )
    seen = df.filter(F.col(event_type).isin(*types)).select(
        F.col(store).alias("__store"), *at, F.lit(0).alias("__fires"), F.lit(None).cast(row).alias("__row"),
        *[F.when(F.col(event_type) == t, entry).alias(f"__entry_{i}") for i, t in enumerate(types)],
    )
    # The firing row has arrived as well, so it comes after its own entry.
    both = seen.unionByName(firing, allowMissingColumns=True)
    entries = {f"__first_{i}": F.col(f"__entry_{i}") for i in range(len(types))}
    found = rolling_firsts(both, ["__store"], [*places, "__fires"], entries, n, **{"costly": True, **split})
    return found.filter("__fires = 1").select(
        "__row.*",
        *[F.array_join(F.col(f"__first_{i}.app"), ", ").alias(f"first_{t}") for i, t in enumerate(types)],
    )


def _first_entries(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.select(*keys, "__entry", rank.alias("__rank"), *[c for c in order if c not in keys])
        .filter(F.col("__rank") <= n)
        .select(*keys, "__entry")
    )


def dynamic_peak(
    panes: DataFrame, count: str, keys: Sequence[str] = (), **split
) -> DataFrame:
    """Fire when at least as many panes were seen as this pane counts.

    Each firing gives the fullest pane so far, ties: the earlier.
    """
    best = F.struct(
        F.col(count).alias("n"), (-F.col(W_START)).alias("neg"), F.col(W_END).alias("end")
    )
    seen = running(
        panes, keys, [W_START], [count_fold("__seen"), Fold("__best", "max", best)], **split
    )
    return seen.filter(F.col("__seen") >= F.col(count)).select(
        *keys,
        F.col("__seen").alias("pane_number"),
        (-F.col("__best.neg")).alias("peak_start"),
        F.col("__best.end").alias("peak_end"),
        F.col("__best.n").alias("peak_count"),
    )


def last_n_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
    name: str = "retained", **split,
) -> DataFrame:
    """Elements an always-firing pane sees that keeps ``n`` after each firing."""
    counted = running(df, keys, order, [count_fold(name)], **split)
    return counted.withColumn(name, F.least(F.col(name), F.lit(n + 1)))


def last_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
    aggregates: dict[str, Column], rows_per_chunk: int = ROWS_PER_CHUNK, costly: bool = False,
) -> DataFrame:
    """Aggregates over what an always-firing pane sees that keeps ``n`` after each firing.

    Those are the row and the ``n`` before it; ``aggregates`` are any aggregate
    expressions, lists included. ``order`` must be unique within a key. The last
    ``n`` rows of a chunk of a heavy key are copied to the next chunk (and on, as
    far as short chunks need them), where they are seen but do not fire.
    """
    tagged, split = tag_chunks(df, keys, order, rows_per_chunk, costly)
    columns = df.columns
    by = [*keys, *([CHUNK] if split else [])]
    frame = Window.partitionBy(*by).orderBy(*order).rowsBetween(-n, Window.currentRow)
    results = [x.over(frame).alias(name) for name, x in aggregates.items()]
    if not split:
        return tagged.select(*columns, *results)

    heavy = tagged.filter(F.col(LAST_CHUNK) > 0)
    in_order = Window.partitionBy(*keys).orderBy(CHUNK)
    following = in_order.rowsBetween(1, n)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk: the rows before it, and the same of the chunks it may reach into.
    starts = heavy.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__size")).withColumn(
        "__start", F.coalesce(F.sum("__size").over(earlier), F.lit(0))
    ).select(
        *[F.col(k).alias(f"__of_{i}") for i, k in enumerate(keys)], F.col(CHUNK).alias("__of_chunk"),
        "__size", "__start",
        F.collect_list(F.struct(F.col(CHUNK).alias("chunk"), F.col("__start").alias("start"))).over(following).alias("__next"),
    )
    from_end = F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*[F.desc(c) for c in order]))
    # The rank limit holds on the map side as well.
    tails = heavy.withColumn("__from_end", from_end).filter(F.col("__from_end") <= n)
    pairs = [*[(k, f"__of_{i}") for i, k in enumerate(keys)], (CHUNK, "__of_chunk")]
    tails = tails.join(starts, same_key(tails, starts, pairs))
    place = F.col("__start") + F.col("__size") - F.col("__from_end") + 1
    reached = F.explode(F.filter("__next", lambda x: x["start"] < place + n))
    halo = tails.select(*columns, reached.alias("__to")).select(
        *columns, F.col("__to.chunk").alias(CHUNK), F.lit(True).alias("__seen")
    )
    both = tagged.select(*columns, CHUNK, F.lit(False).alias("__seen")).unionByName(halo)
    return both.select(*columns, "__seen", *results).filter(~F.col("__seen")).drop("__seen")

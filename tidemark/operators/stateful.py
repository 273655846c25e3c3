"""Keyed state machines on static tables.

What has an algebraic form is a window (runs, chains of adjacent intervals).
The delta filter and the anchored merge depend on what was emitted before; for
them the rows of a key are taken in order, batch by batch, without ever
holding a whole key in memory. The delta filter jumps from kept row to kept row,
on arrays. Heavy keys do not wait for one walker either:

* delta filter: the effect of a chunk on the state is a small step function of
  the state it starts from. Chunks compute theirs independently, one row per
  step; composing them gives every chunk its starting state.
* anchored merge: a chunk is a table of how an anchor that enters it leaves it,
  found by one walk backwards. Only these entries are linked from chunk to chunk
  and followed by doubling, in rounds that grow with the logarithm of the chunks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

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
    islands,
    running,
    narrow,
    same_key,
    tag_chunks,
)
from tidemark.operators.walk import groups, openings, to_batch, walk
from tidemark.session import cut_lineage


# An anchored chunk's table is in the memory of one Python worker.
ANCHORED_ROWS_PER_CHUNK = 500_000


# -- delta filter ---------------------------------------------------------------


def delta_filter(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
    limit: int = 5, initial: int = 0, rows_per_chunk: int = ROWS_PER_CHUNK,
    costly: bool = False,
) -> DataFrame:
    """Keep a row if its value is 0 or differs by more than ``limit`` from the
    last kept one (``initial`` at first).

    ``value`` is an integer column; scale decimals before.
    """
    columns = df.columns
    rows, split = tag_chunks(
        df.filter(F.col(value).isNotNull()), keys, order, rows_per_chunk, costly
    )
    by = list(keys)
    if split:
        by.append(CHUNK)
        starts = narrow(_entering_states(rows, keys, order, value, limit, initial), split)
        rows = rows.join(
            starts,
            same_key(
                rows, starts,
                [(k, f"__key_{i}") for i, k in enumerate(keys)] + [(CHUNK, "__at_chunk")],
            ),
            "left",
        )
        enter = F.coalesce("__enter", F.lit(initial))
    else:
        enter = F.lit(initial)
    rows = rows.withColumn("__start", enter.cast("bigint"))
    rows = rows.select(*columns, *([CHUNK] if split else []), "__start")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(value).cast(pa.int64()).to_numpy()
            opening = openings(batch, by, before)
            states = batch.column("__start").take(pa.array(opening, pa.int64())).to_numpy()
            if not len(opening) or opening[0]:  # the first rows go on with the group of the last batch
                opening, states = np.append(0, opening), np.append(last, states)
            kept = Jumps(values, opening, limit).kept(states)
            yield batch.filter(pa.array(kept)).select(columns)
            places = np.flatnonzero(kept[opening[-1] :])
            last = int(values[opening[-1] + places[-1]]) if len(places) else int(states[-1])
            before = batch.slice(batch.num_rows - 1)

    return walk(rows, by, order, keep, df.schema)


class Jumps:
    """For every row of a batch, the next row that would be kept if it was.

    That is the first later row of its segment with value 0 or outside the band
    around its own value. It is found for all rows together, by descending a
    table of the largest and smallest values of 1, 2, 4, ... rows.
    """

    def __init__(self, values: np.ndarray, opening: np.ndarray, limit: int):
        self.values, self.opening, self.limit = values, opening, limit
        self.stops = np.append(opening[1:], len(values))
        segment = np.repeat(np.arange(len(opening)), self.stops - opening)
        highest, lowest = np.where(values == 0, _MOST, values), np.where(values == 0, _LEAST, values)
        self.spans = [(highest, lowest)]
        while 2 ** len(self.spans) <= len(values):
            half = 2 ** (len(self.spans) - 1)
            (high, low), n = self.spans[-1], len(values) - 2 ** len(self.spans) + 1
            self.spans.append((np.maximum(high[:n], high[half : half + n]), np.minimum(low[:n], low[half : half + n])))
        # One place after the last row stands for none.
        self.next = np.append(self.leaving(np.arange(1, len(values) + 1), values, self.stops[segment]), len(values))

    def leaving(self, at: np.ndarray, states: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The first row from ``at`` on, before ``stops``, that is 0 or outside the band around a state; or no row."""
        upper = np.where(states > _MOST - 1 - self.limit, _MOST - 1, states + self.limit)
        lower = np.where(states < _LEAST + 1 + self.limit, _LEAST + 1, states - self.limit)
        at = at.copy()
        for k in reversed(range(len(self.spans))):
            high, low = self.spans[k]
            fits = np.flatnonzero(at + 2**k <= stops)
            here = at[fits]
            inside = (high[here] <= upper[fits]) & (low[here] >= lower[fits])
            at[fits[inside]] += 2**k
        return np.where(at < stops, at, len(self.values))

    def _powers(self) -> list[np.ndarray]:
        """The row after 1, 2, 4, ... kept rows, the largest number first."""
        jumps = [self.next]
        while 2 ** len(jumps) <= len(self.values):
            jumps.append(jumps[-1][jumps[-1]])
        return jumps[::-1]

    def kept(self, states: np.ndarray) -> np.ndarray:
        """Which rows are kept, if the segments begin in these states."""
        reached = np.zeros(len(self.values) + 1, bool)
        reached[self.leaving(self.opening, states, self.stops)] = True
        for jump in self._powers():
            reached[jump[reached]] = True
        return reached[:-1]

    def last(self) -> np.ndarray:
        """For every row, the last one of its segment that is kept if it is kept itself."""
        n = len(self.values)
        at = np.arange(n)
        for jump in self._powers():
            onward = jump[at]
            at = np.where(onward < n, onward, at)
        return at


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1  # all states: any bigint


class StateSteps:
    """The last kept value after some rows, as a function of the one before.

    ``same`` is the range of states in which no row is kept, so that the state
    passes through; ``fixed`` maps each other outcome to its ranges of states.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.same: tuple[int, int] | None = (_LEAST, _MOST)
        self.fixed: dict[int, list[tuple[int, int]]] = {}

    def add(self, values: np.ndarray) -> None:
        """Go on with more rows."""
        n = len(values)
        jumps = Jumps(values, np.zeros(1, np.int64), self.limit)
        outcome = values[jumps.last()]
        moved: dict[int, list[tuple[int, int]]] = {}
        if self.fixed:
            states = np.array(list(self.fixed), np.int64)
            first = jumps.leaving(np.zeros(len(states), np.int64), states, np.full(len(states), n))
            after = np.where(first < n, outcome[np.minimum(first, n - 1)], states)
            for state, ranges in zip(after.tolist(), self.fixed.values()):
                moved.setdefault(state, []).extend(ranges)
        if self.same:
            zeros = np.flatnonzero(values == 0)
            end = int(zeros[0]) if len(zeros) else n
            # What still passes after each row; only a new largest or smallest value changes it.
            lows = np.maximum(np.maximum.accumulate(values[:end]), _LEAST + self.limit) - self.limit
            highs = np.minimum(np.minimum.accumulate(values[:end]), _MOST - self.limit) + self.limit
            lows = np.maximum(np.append(self.same[0], lows), self.same[0])
            highs = np.minimum(np.append(self.same[1], highs), self.same[1])
            for j in np.flatnonzero((lows[1:] > lows[:-1]) | (highs[1:] < highs[:-1])).tolist():
                low, high, next_low, next_high = (int(x) for x in (lows[j], highs[j], lows[j + 1], highs[j + 1]))
                for a, b in ((low, min(high, next_low - 1)), (max(low, next_high + 1), high)):
                    if a <= b and low <= high:
                        moved.setdefault(int(outcome[j]), []).append((a, b))
            low, high = int(lows[-1]), int(highs[-1])
            if end < n and low <= high:
                moved.setdefault(int(outcome[end]), []).append((low, high))
            self.same = (low, high) if end == n and low <= high else None
        self.fixed = {state: _joined(ranges) for state, ranges in moved.items()}

    def steps(self) -> Iterator[tuple[int, int, int | None]]:
        if self.same:
            yield (*self.same, None)
        for outcome, ranges in self.fixed.items():
            for low, high in ranges:
                yield low, high, outcome


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _entering_states(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
    limit: int, initial: int,
) -> DataFrame:
    """The state each chunk of a split key starts from, one row per chunk."""
    named = [F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]
    heavy = rows.filter(F.col(LAST_CHUNK) > 0).select(
        *named,
        F.col(CHUNK).alias("__at_chunk"),
        *[F.col(c).alias(f"__order_{i}") for i, c in enumerate(order)],
        F.col(value).cast("bigint").alias("__value"),
    )
    by = [f"__key_{i}" for i in range(len(keys))]
    key_fields = [heavy.schema[k] for k in by]
    chunk_field = heavy.schema["__at_chunk"]
    step_schema = T.StructType(
        [*key_fields, chunk_field]
        + [T.StructField(n, T.LongType()) for n in ("__low", "__high", "__outcome")]
    )
    start_schema = T.StructType([*key_fields, chunk_field, T.StructField("__enter", T.LongType())])
    of_chunk = [*by, "__at_chunk"]

    def summarise(batches):
        group, steps, before, schema = None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = pa.schema(
                [batch.schema.field(c) for c in of_chunk]
                + [pa.field(n, pa.int64()) for n in ("__low", "__high", "__outcome")]
            )
            values = batch.column("__value").to_numpy()
            opening = openings(batch, of_chunk, before)
            if not len(opening) or opening[0]:  # the first rows go on with the group of the last batch
                steps.add(values[: opening[0] if len(opening) else None])
            for a, b in zip(opening, [*opening[1:], batch.num_rows]):
                if steps is not None:
                    yield to_batch([(*group, *s) for s in steps.steps()], schema)
                group = tuple(batch.column(c)[int(a)].as_py() for c in of_chunk)
                steps = StateSteps(limit)
                steps.add(values[a:b])
            before = batch.slice(batch.num_rows - 1)
        if steps is not None:
            yield to_batch([(*group, *s) for s in steps.steps()], schema)

    def compose(batches):
        key, chunk, state, following = None, None, initial, initial
        for batch in batches:
            schema = pa.schema(
                [batch.schema.field(c) for c in of_chunk] + [pa.field("__enter", pa.int64())]
            )
            done = []
            columns = (batch.column(c).to_pylist() for c in ("__at_chunk", "__low", "__high", "__outcome"))
            for k, c, low, high, outcome in zip(groups(batch, by), *columns):
                if k != key:
                    key, chunk, following = k, None, initial
                if c != chunk:
                    chunk, state = c, following
                    done.append((*k, c, state))
                if low <= state <= high:
                    following = state if outcome is None else outcome
            yield to_batch(done, schema)

    order_names = [f"__order_{i}" for i in range(len(order))]
    steps = walk(heavy, of_chunk, order_names, summarise, step_schema)
    return walk(steps, by, ["__at_chunk", "__low"], compose, start_schema)


# -- runs and adjacent intervals --------------------------------------------------


def merge_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], category: str,
    start: str, end: str, duration: str, time_of_day: str | None = None,
    include_open: bool = False, **split,
) -> DataFrame:
    """Consecutive records of one category as one record.

    Earliest start, latest end, summed duration, smallest time of day. The last
    run of a key is still open and left out unless ``include_open``.
    """
    folds = [
        Fold(start, "min", F.col(start)),
        Fold(end, "max", F.col(end)),
        Fold(duration, "sum", F.col(duration)),
    ]
    if time_of_day:
        folds.append(Fold(time_of_day, "min", F.col(time_of_day)))
    return islands(
        df, keys, order,
        enter=F.col(category), leave=F.col(category),
        breaks=lambda previous, current: ~previous.eqNullSafe(current),
        folds=folds, labels=[category], first_enter=category, last_leave=category,
        keep_open=include_open, **split,
    )


def merge_chains(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    start: str, end: str, duration: str, time_of_day: str, **split,
) -> DataFrame:
    """Intervals that each start where the one before ends, as one interval.

    ``order`` starts with the start column. Every interval or chain comes out
    once.
    """
    return islands(
        df, keys, order,
        enter=F.col(start), leave=F.col(end),
        breaks=lambda previous_end, this_start: previous_end != this_start,
        folds=[
            Fold(start, "min", F.col(start)),
            Fold(end, "max", F.col(end)),
            Fold(duration, "sum", F.col(duration)),
            Fold(time_of_day, "min", F.col(time_of_day)),
        ],
        first_enter=start, last_leave=end,
        **split,
    )


def merge_anchored(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    start: str, end: str, duration: str, time_of_day: str,
    rows_per_chunk: int = ANCHORED_ROWS_PER_CHUNK, costly: bool = False,
) -> DataFrame:
    """Merge records into an anchor that they extend.

    The first record of a key is the anchor and is not emitted itself. A record
    that starts at the anchor's end is merged into it (start of the anchor, own
    end, summed duration, smaller time of day), emitted and is the new anchor;
    any other record is emitted as it is. All four columns and the order
    columns are integers.
    """
    record = [start, end, duration, time_of_day]
    needed = list(dict.fromkeys([*keys, *order, *record]))
    tagged, split = tag_chunks(
        df.select(*needed), keys, order, rows_per_chunk, costly
    )
    if not split:
        none = [F.lit(None).cast("bigint").alias(a) for a in _ANCHOR]
        return _walk_anchored(tagged.select(*needed, *none), keys, order, record, needed)
    anchors = narrow(_entering_anchors(tagged, keys, order, record), split)
    pairs = [*_numbered_pairs(keys, "anchor"), (CHUNK, "__anchor_chunk")]
    rows = tagged.join(anchors, same_key(tagged, anchors, pairs), "left").select(
        *[tagged[c] for c in needed], tagged[CHUNK], *_ANCHOR
    )
    return _walk_anchored(rows, [*keys, CHUNK], order, record, needed)


# The anchor a chunk begins with: its start, end, duration and time of day.
_ANCHOR = ["__a_start", "__a_end", "__a_span", "__a_time"]


def _walk_anchored(
    df: DataFrame, by: Sequence[str], order: Sequence[str], record: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    schema = T.StructType([df.schema[c] for c in columns])

    def step(batches):
        group, anchor = None, None
        for batch in batches:
            starts, ends, spans, times = (batch.column(c).to_pylist() for c in record)
            entering = [batch.column(c).to_pylist() for c in _ANCHOR]
            emitted = []
            for i, g in enumerate(groups(batch, by)):
                if g != group:
                    group = g
                    if entering[2][i] is None:
                        anchor = (starts[i], ends[i], spans[i], times[i])
                        emitted.append(False)
                        continue
                    anchor = tuple(c[i] for c in entering)
                emitted.append(True)
                if starts[i] == anchor[1]:
                    anchor = (anchor[0], ends[i], anchor[2] + spans[i], min(anchor[3], times[i]))
                    starts[i], ends[i], spans[i], times[i] = anchor
            changed = dict(zip(record, (starts, ends, spans, times)))
            arrays = [
                pa.array(changed[c], batch.schema.field(c).type) if c in changed else batch.column(c)
                for c in columns
            ]
            merged = pa.RecordBatch.from_arrays(
                arrays, schema=pa.schema([batch.schema.field(c) for c in columns])
            )
            yield merged.filter(pa.array(emitted, pa.bool_()))

    return walk(df, by, order, step, schema)


def _entering_anchors(
    tagged: DataFrame, keys: Sequence[str], order: Sequence[str], record: Sequence[str]
) -> DataFrame:
    """The anchor at the start of every chunk of a heavy key but its first, one row each.

    A chunk changes an anchor only by the first of its records that starts at the
    anchor's end, and from there on its own records decide. So a chunk is a table
    from such starts to how the anchor leaves the chunk, found by one walk
    backwards. An entry leads on to the first later chunk with an entry for its
    end; a path has an entry per chunk at most, so jumps over 1, 2, 4, ... entries
    reach all of the anchor's path in as many rounds as the chunks have bits.
    """
    tables = cut_lineage(_chunk_tables(tagged, keys, order, record))
    heads = tables.filter("first")
    by_key = Window.partitionBy(*keys)
    heads = heads.withColumn("first", F.col("chunk") == F.min("chunk").over(by_key))  # a row per chunk
    nodes = tables.filter("not first").unionByName(heads.filter("first"))
    at = F.struct("chunk", "start", "first").alias("__at")

    # the next entry of an entry: in the first later chunk that has one for its end
    probes = nodes.select(*keys, F.col("left").alias("__value"), (-F.col("chunk")).alias("__back"), F.lit(0).alias("__side"), at)
    targets = tables.filter("not first").select(
        *keys, F.col("start").alias("__value"), (-F.col("chunk")).alias("__back"), F.lit(1).alias("__side"), at
    )
    links = running(
        probes.unionByName(targets), [*keys, "__value"], ["__back", "__side"],
        [Fold("__next", "last", F.when(F.col("__side") == 1, F.col("__at")))],
    ).filter((F.col("__side") == 0) & F.col("__next").isNotNull())
    jumps = [cut_lineage(links.select(*_numbered(keys, "from"), F.col("__at").alias("__from"), F.col("__next").alias("__to")))]
    most = heads.agg(F.max("chunk")).first()[0] or 0
    for _ in range(most.bit_length() - 1):
        jumps.append(cut_lineage(_double(jumps[-1], keys)))
    path = cut_lineage(nodes.filter("first").select(*keys, at))
    for far in reversed(jumps):
        step = cut_lineage(_follow(path, far, keys))
        path = path.unionByName(step)  # of written tables

    met = path.select(*_numbered(keys, "met"), F.col("__at").alias("__met_at"))
    placed = nodes.withColumn("__at", at)
    on_path = placed.join(met, same_key(placed, met, [*_numbered_pairs(keys, "met"), ("__at", "__met_at")]), "left_semi")
    on_path = on_path.select(
        *_numbered(keys, "on"), F.col("chunk").alias("__on"), F.when(F.col("first"), F.col("start")).alias("__root"),
        "left", "span", "time",
    )
    chunks = heads.select(*keys, "chunk")
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    folded = [
        F.first("__root", ignorenulls=True), F.last("left", ignorenulls=True), F.sum("span"), F.min("time"),
    ]
    joined = chunks.join(on_path, same_key(chunks, on_path, [*_numbered_pairs(keys, "on"), ("chunk", "__on")]), "left")
    return cut_lineage(joined.select(
        *_numbered(keys, "anchor"), F.col("chunk").alias("__anchor_chunk"),
        *[f.over(before).cast("bigint").alias(a) for f, a in zip(folded, _ANCHOR)],
    ))


def _chunk_tables(tagged: DataFrame, keys: Sequence[str], order: Sequence[str], record: Sequence[str]) -> DataFrame:
    """(keys, chunk, start, left, span, time, first): how an anchor that ends at ``start`` leaves a chunk.

    ``left`` is its end then; span and time are those of the records it has
    absorbed. A ``first`` row says the same of the chunk's first record itself.
    """
    backwards = [f"__back_{i}" for i in range(len(order))]
    heavy = tagged.filter(F.col(LAST_CHUNK) > 0).select(
        *keys, F.col(CHUNK).alias("chunk"), *[(-F.col(c)).alias(b) for c, b in zip(order, backwards)],
        *[F.col(c).cast("bigint").alias(f"__{i}") for i, c in enumerate(record)],
    )
    by = [*keys, "chunk"]
    numbers = ["start", "left", "span", "time"]
    schema = T.StructType([
        *[heavy.schema[c] for c in by], *[T.StructField(n, T.LongType()) for n in numbers], T.StructField("first", T.BooleanType()),
    ])

    def entries(group, table, first, kinds):
        own = pa.schema([*zip(by, kinds), *[(n, pa.int64()) for n in numbers], ("first", pa.bool_())])
        rows = [(*group, s, *left, False) for s, left in table.items()]
        for i in range(0, len(rows), 50_000):
            yield to_batch(rows[i : i + 50_000], own)
        yield to_batch([(*group, *first, True)], own)

    def step(batches):
        group, table, first, kinds = None, {}, None, []
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in by]
            columns = (batch.column(f"__{i}").to_pylist() for i in range(4))
            for g, s, e, d, t in zip(groups(batch, by), *columns):
                if g != group:
                    if group is not None:
                        yield from entries(group, table, first, kinds)
                    group, table = g, {}
                onward = table.get(e)
                left = (e, d, t) if onward is None else (onward[0], d + onward[1], min(t, onward[2]))
                table[s] = left
                first = (s, *left)
        if group is not None:
            yield from entries(group, table, first, kinds)

    return walk(heavy, by, backwards, step, schema)


def _numbered(keys: Sequence[str], side: str) -> list[Column]:
    return [F.col(k).alias(f"__{side}_{i}") for i, k in enumerate(keys)]


def _numbered_pairs(keys: Sequence[str], side: str) -> list[tuple[str, str]]:
    return [(k, f"__{side}_{i}") for i, k in enumerate(keys)]


def _follow(absorbed: DataFrame, jumps: DataFrame, keys: Sequence[str]) -> DataFrame:
    pairs = [*_numbered_pairs(keys, "from"), ("__at", "__from")]
    return absorbed.join(jumps, same_key(absorbed, jumps, pairs)).select(
        *[absorbed[k] for k in keys], F.col("__to").alias("__at")
    )


def _double(jumps: DataFrame, keys: Sequence[str]) -> DataFrame:
    onward = jumps.select(
        *[F.col(f"__from_{i}").alias(f"__mid_{i}") for i in range(len(keys))],
        F.col("__from").alias("__mid"),
        F.col("__to").alias("__end"),
    )
    pairs = [(f"__from_{i}", f"__mid_{i}") for i in range(len(keys))] + [("__to", "__mid")]
    return jumps.join(onward, same_key(jumps, onward, pairs)).select(
        *[jumps[f"__from_{i}"] for i in range(len(keys))],
        jumps["__from"],
        F.col("__end").alias("__to"),
    )

"""Sessions of a stream in two chained stateful steps.

The built-in session window sends every row of a key into one group, and a
session over all rows is one group for the whole stream. Here rows are first
aggregated, with a map-side part, to one per key and *slice*, a tumbling pane as
long as the gap: its rows are in one session anyway. A slice comes out when the
watermark has passed its end, so the second step gets few rows, in order, and
merges those that touch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from tidemark.operators.chunks import Fold
from tidemark.operators.windows import W_END, W_START, count_fold
from tidemark.streaming.processors import ValuePerRecord

_MERGE = {
    "count": lambda a, b: a + b,
    "sum": lambda a, b: a + b,
    "min": min,
    "max": max,
}
_FIRST, _LAST, _ALL = "__first", "__last", "__all"


class MergeSlices(ValuePerRecord):
    """The open session of a key: first and last time, then the folds."""

    def __init__(self, keys: Sequence[str], gap_ms: int, names: Sequence[str], kinds: Sequence[str], state: T.StructType):
        super().__init__([_FIRST], state)
        self.keys, self.gap_ms = list(keys), gap_ms
        self.names, self.kinds = list(names), list(kinds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle

    def step(self, state, row):
        new = (row[_FIRST], row[_LAST], *[row[n] for n in self.names])
        if state is None:
            return new, []
        if new[0] - state[1] > self.gap_ms:
            return new, [self.closed([row[k] for k in self.keys], state)]
        folds = [self.merged(kind, a, b) for kind, a, b in zip(self.kinds, state[2:], new[2:])]
        return (min(state[0], new[0]), max(state[1], new[1]), *folds), []

    @staticmethod
    def merged(kind: str, a, b):
        return b if a is None else a if b is None else _MERGE[kind](a, b)

    def closed(self, key: Sequence, state: tuple) -> tuple:
        return (*key, state[0], state[1] + self.gap_ms, *state[2:])

    def save(self, state) -> None:
        super().save(state)
        # A row that still touches is in a slice that ends no later than this.
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(state[1] + 2 * self.gap_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.cell.exists():
            yield Row(*self.output)(*self.closed(key[: len(self.keys)], self.load()))
            self.cell.clear()


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, gap_ms: int, folds: Sequence[Fold] | None = None,
) -> DataFrame:
    """Twin of ``windows.sessions`` on a stream (append mode); no keys: sessions over all rows.

    ``ts`` is a timestamp with a watermark. A session comes out when a later slice
    of the key begins another one, or when the watermark is two gaps past its last
    row. Folds are counts, sums, least and greatest values. Rows without a time,
    and those that the watermark finds late, are in no session.
    """
    folds = list(folds if folds is not None else [count_fold()])
    if any(f.kind not in _MERGE for f in folds):
        raise ValueError(f"folds of sessions on a stream: {', '.join(_MERGE)}")
    at = F.unix_millis(F.col(ts))
    slices = df.filter(F.col(ts).isNotNull()).groupBy(
        *keys, F.window(ts, f"{gap_ms} milliseconds").alias("__slice")
    ).agg(
        F.min(at).alias(_FIRST), F.max(at).alias(_LAST),
        *[f.total(F.lit(None)).alias(f.name) for f in folds],
    )
    # A grouping key must depend on the row.
    group = list(keys) or [_ALL]
    if not keys:
        slices = slices.withColumn(_ALL, F.pmod(F.hash("__slice.start"), F.lit(1)))
    names = [f.name for f in folds]
    state = T.StructType([T.StructField(c, slices.schema[c].dataType) for c in (_FIRST, _LAST, *names)])
    processor = MergeSlices(keys, gap_ms, names, [f.kind for f in folds], state)
    output = T.StructType([
        *[slices.schema[k] for k in keys],
        *T.StructType.fromDDL(f"{W_START} bigint, {W_END} bigint").fields,
        *state.fields[2:],
    ])
    processor.output = output.names
    return slices.groupBy(*group).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime",
    )

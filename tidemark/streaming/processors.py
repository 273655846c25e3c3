"""Streaming twins of the operators that emit per record.

``groupBy().agg()`` in update mode gives one row per key and micro-batch; these
processors give one row per record, and keep their state in the state store
under the stream's checkpoint. The rows of a key within a micro-batch come in
no fixed order and are sorted by ``order`` first; state is read and written once
per key and micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class PerRecord(StatefulProcessor):
    """Walks the new rows of a key in order between reading and saving state."""

    def __init__(self, order: Sequence[str]):
        self.order = list(order)
        self.output: list[str] = []  # column names of what step emits

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        emitted = Row(*self.output)
        state = self.load()
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            state, found = self.step(state, row)
            for values in found:
                yield emitted(*values)
        self.save(state)

    def load(self):
        raise NotImplementedError

    def step(self, state, row):
        raise NotImplementedError

    def save(self, state) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass


class ValuePerRecord(PerRecord):
    """State is one tuple, or None before the first record and after a clear."""

    def __init__(self, order: Sequence[str], state_schema: str | T.StructType):
        super().__init__(order)
        self.state_schema = state_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = handle.getValueState("cell", self.state_schema)

    def load(self):
        return tuple(self.cell.get()) if self.cell.exists() else None

    def save(self, state) -> None:
        if state is None:
            self.cell.clear()
        else:
            self.cell.update(state)


class Reduce(ValuePerRecord):
    """Running reduce of a column by ``combine(accumulated, value)``."""

    def __init__(self, order, value: str, combine: Callable, kind: str):
        super().__init__(order, f"v {kind}")
        self.value, self.combine = value, combine

    def step(self, state, row):
        value = row[self.value]
        total = value if state is None else self.combine(state[0], value)
        return (total,), [(*row, total)]


class Count(ValuePerRecord):
    def __init__(self, order):
        super().__init__(order, "n bigint")

    def step(self, state, row):
        n = 1 + (state[0] if state else 0)
        return (n,), [(*row, n)]


class Listed(PerRecord):
    """All values of the key so far, in a list state."""

    def __init__(self, order, value: str, kind: str, separator: str):
        super().__init__(order)
        self.value, self.kind, self.separator = value, kind, separator

    def init(self, handle) -> None:
        self.cell = handle.getListState("items", f"v {self.kind}")

    def load(self):
        self.added = []
        return [v[0] for v in self.cell.get()] if self.cell.exists() else []

    def step(self, state, row):
        self.added.append((row[self.value],))
        state.append(row[self.value])
        return state, [(*row, self.separator.join(str(v) for v in state))]

    def save(self, state) -> None:
        self.cell.appendList(self.added)


class MapCount(PerRecord):
    """Count per sub-key so far, in a map state."""

    def __init__(self, order, sub_key: str):
        super().__init__(order)
        self.sub_key = sub_key

    def init(self, handle) -> None:
        self.cell = handle.getMapState("counts", "sub string", "n bigint")

    def load(self):
        self.changed = set()
        return {k[0]: v[0] for k, v in self.cell.iterator()} if self.cell.exists() else {}

    def step(self, state, row):
        sub = row[self.sub_key]
        state[sub] = state.get(sub, 0) + 1
        self.changed.add(sub)
        return state, [(*row, dict(sorted(state.items())))]

    def save(self, state) -> None:
        for sub in self.changed:
            self.cell.updateValue((sub,), (state[sub],))


class Delta(ValuePerRecord):
    def __init__(self, order, value: str, limit: int, initial: int):
        super().__init__(order, "last bigint")
        self.value, self.limit, self.initial = value, limit, initial

    def step(self, state, row):
        last = state[0] if state else self.initial
        v = row[self.value]
        if v == 0 or abs(v - last) > self.limit:
            return (v,), [row]
        return (last,), []


class Runs(ValuePerRecord):
    """Runs of one category; a run comes out when the next one begins."""

    STATE = "category string, start_ms bigint, end_ms bigint, duration_ms bigint, start_second int"

    def __init__(self, order, keys: Sequence[str], fields: Sequence[str]):
        super().__init__(order, self.STATE)
        self.keys, self.fields = list(keys), list(fields)

    def step(self, state, row):
        category, start, end, duration, second = (row[f] for f in self.fields)
        if state is not None and state[0] == category:
            return (
                category, min(state[1], start), max(state[2], end),
                state[3] + duration, min(state[4], second),
            ), []
        closed = [] if state is None else [(*[row[k] for k in self.keys], *state)]
        return (category, start, end, duration, second), closed


class Anchored(ValuePerRecord):
    STATE = "start_ms bigint, end_ms bigint, duration_ms bigint, start_second int"

    def __init__(self, order, keys: Sequence[str], fields: Sequence[str]):
        super().__init__(order, self.STATE)
        self.keys, self.fields = list(keys), list(fields)

    def step(self, state, row):
        record = tuple(row[f] for f in self.fields)
        if state is None:
            return record, []
        if record[0] == state[1]:
            record = (state[0], record[1], state[2] + record[2], min(state[3], record[3]))
            state = record
        return state, [(*[row[k] for k in self.keys], *record)]


class Thresholds(ValuePerRecord):
    """Fires on the counts of an app before the record; never purged."""

    def __init__(self, order, event_type: str, install: str, uninstall: str,
                 installs: int, uninstalls: int, fire_types: Sequence[str] | None):
        super().__init__(order, "installs bigint, uninstalls bigint")
        self.event_type, self.install, self.uninstall = event_type, install, uninstall
        self.installs, self.uninstalls, self.fire_types = installs, uninstalls, fire_types

    def step(self, state, row):
        i, u = state or (0, 0)
        kind = row[self.event_type]
        fires = i >= self.installs or u >= self.uninstalls
        if self.fire_types is not None:
            fires = fires and kind in self.fire_types
        after = (i + (kind == self.install), u + (kind == self.uninstall))
        return after, [(*row, i, u)] if fires else []


class AppStore(PerRecord):
    """A store's apps over a threshold, each firing with the first apps by event time.

    State is a count of installs and uninstalls per app, of which only the apps
    of the new rows are read, and the first ``n`` entries of either type.
    """

    def __init__(self, order, app: str, app_kind: str, event_type: str, types: Sequence[str],
                 event_time: Sequence[str], n: int, installs: int, uninstalls: int):
        super().__init__(order)
        self.app, self.app_kind, self.event_type, self.types = app, app_kind, event_type, list(types)
        self.event_time, self.n, self.limits = list(event_time), n, (installs, uninstalls)

    def init(self, handle) -> None:
        self.counts = handle.getMapState("counts", f"app {self.app_kind}", "installs bigint, uninstalls bigint")
        entry = f"struct<at: array<bigint>, app: {self.app_kind}>"
        self.firsts = handle.getValueState("firsts", ", ".join(f"first_{i} array<{entry}>" for i in (0, 1)))

    def load(self):
        found = self.firsts.get() if self.firsts.exists() else ([], [])
        return {}, [[(list(at), app) for at, app in entries] for entries in found]

    def step(self, state, row):
        seen, firsts = state
        app, kind = row[self.app], row[self.event_type]
        if app not in seen:
            known = self.counts.containsKey((app,))
            seen[app] = tuple(self.counts.getValue((app,))) if known else (0, 0)
        before = seen[app]
        seen[app] = tuple(c + (kind == t) for c, t in zip(before, self.types))
        if kind in self.types:
            entries = firsts[self.types.index(kind)]
            entries.append(([row[c] for c in [*self.event_time, *self.order]], app))
            entries.sort(key=lambda e: e[0])
            del entries[self.n :]
        if not any(c >= most for c, most in zip(before, self.limits)):
            return state, []
        return state, [(*row, *before, *[", ".join(str(a) for _, a in entries) for entries in firsts])]

    def save(self, state) -> None:
        seen, firsts = state
        for app, counts in seen.items():
            self.counts.updateValue((app,), counts)
        self.firsts.update(tuple(firsts))


class PaneCount(ValuePerRecord):
    """Fires on every n-th element of a pane, and forgets the pane at its end."""

    def __init__(self, order, n: int, pane_end: str):
        super().__init__(order, "n bigint")
        self.n, self.pane_end = n, pane_end

    def init(self, handle) -> None:
        super().init(handle)
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        if not self.cell.exists():
            self.handle.registerTimer(rows[0][self.pane_end])
        yield from super().handleInputRows(key, rows, timerValues)

    def step(self, state, row):
        n = 1 + (state[0] if state else 0)
        return (n,), [(*row, n)] if n % self.n == 0 else []

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.cell.clear()
        return iter(())


class Peak(ValuePerRecord):
    """Fires when as many panes were seen as the pane counts, with the best so far."""

    def __init__(self, order, start: str, end: str, count: str):
        super().__init__(order, "seen bigint, start bigint, end bigint, best bigint")
        self.start, self.end, self.count = start, end, count

    def step(self, state, row):
        n = row[self.count]
        seen, start, end, best = state or (0, row[self.start], row[self.end], n)
        if n > best:
            start, end, best = row[self.start], row[self.end], n
        state = (seen + 1, start, end, best)
        return state, [state] if seen + 1 >= n else []


class TwoInputs(StatefulProcessor):
    """Rows of two inputs of a key, in the order of their event times.

    Subclasses give ``left`` and ``right``: (state, row) to (state, emitted rows),
    where a row is a dictionary of the keys, the time, the side and what ``reads``
    names besides. None of these may be null.
    With ``expire_ms`` a state is forgotten so long after the row that set it, as
    of the times of later rows of the key, and by a timer when the watermark has
    passed, so that keys of which nothing more comes leave the state store.

    The states of a bucket of keys lie in one cell and share a timer, set to the
    earliest of their ends: calls of the state store are per bucket, not per key.
    """

    def __init__(self, state_schema: str, time: str, side: str, expire_ms: int | None = None, reads: Sequence[str] = ()):
        self.time, self.side, self.expire_ms, self.reads = time, side, expire_ms, list(reads)
        self.state_schema = T.StructType.fromDDL(f"{state_schema}, set_ms bigint")
        self.output: list[str] = []  # column names of what left and right emit

    def keyed(self, keys: Sequence[str], schema: T.StructType) -> None:
        """Names of the key columns, and the schema of the united inputs, before the query starts."""
        self.keys, self.columns = list(keys), schema.names
        kinds = [f.dataType for f in (*[schema[k] for k in keys], *self.state_schema)]
        self.cell_schema = T.StructType([T.StructField(f"c{i}", T.ArrayType(t)) for i, t in enumerate(kinds)])

    def init(self, handle) -> None:
        self.handle = handle
        self.cell = handle.getValueState("cell", self.cell_schema)

    def left(self, state, row):
        raise NotImplementedError

    def right(self, state, row):
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = list(dict.fromkeys([self.time, self.side, *self.keys, *self.reads]))
        at = [self.columns.index(c) for c in names]  # frames may have other names
        given = [r for frame in rows for r in zip(*[frame.iloc[:, i].tolist() for i in at])]
        given.sort(key=itemgetter(0, 1))
        states = self.load()
        emitted = [e for r in given for e in self.step(states, dict(zip(names, r)))]
        self.save(states)
        self.remind(states)
        if emitted:
            yield pd.DataFrame(emitted, columns=self.output, dtype=object)

    def step(self, states, row):
        key, now = tuple([row[k] for k in self.keys]), row[self.time]
        state = states.pop(key, None)
        if state is not None and self.expire_ms is not None and now - state[-1] >= self.expire_ms:
            state = None
        given = state[:-1] if state is not None else None
        state, found = (self.right if row[self.side] else self.left)(given, row)
        if state is not None:
            states[key] = (*state, now)
        return found

    def load(self):
        columns = self.cell.get() if self.cell.exists() else ()
        n = len(self.keys)
        return {entry[:n]: entry[n:] for entry in zip(*columns)}

    def save(self, states) -> None:
        if states:
            columns = zip(*[(*key, *state) for key, state in states.items()])
            self.cell.update(tuple(list(c) for c in columns))
        else:
            self.cell.clear()

    def remind(self, states) -> None:
        """One timer, when the first of the states ends."""
        if self.expire_ms is None:
            return
        due = min(state[-1] for state in states.values()) + self.expire_ms if states else None
        timers = list(self.handle.listTimers())
        for timer in timers:
            if timer != due:
                self.handle.deleteTimer(timer)
        if due is not None and due not in timers:
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        reached = timerValues.getCurrentWatermarkInMs() - self.expire_ms
        states = {k: s for k, s in self.load().items() if s[-1] > reached}
        self.save(states)
        if states:  # the timer that went off goes by itself
            self.handle.registerTimer(min(s[-1] for s in states.values()) + self.expire_ms)
        return iter(())

    def close(self) -> None:
        pass


class Match(TwoInputs):
    """One order and one delivery of a key, whichever comes first is kept."""

    def __init__(self, limit_ms: int, expire_ms: int | None):
        super().__init__("order_ms bigint, delivery_ms bigint", "__t", "__side", expire_ms)
        self.limit_ms = limit_ms

    def left(self, state, row):
        if state is None or state[1] is None:
            return (row["__t"], None), []
        return None, [self.matched(row["id"], row["__t"], state[1])]

    def right(self, state, row):
        if state is None or state[0] is None:
            return (None, row["__t"]), []
        return None, [self.matched(row["id"], state[0], row["__t"])]

    def matched(self, order_id, ordered, delivered):
        deadline = ordered + self.limit_ms
        return (order_id, ordered, delivered, deadline, "on_time" if delivered < deadline else "late")


# -- DataFrame functions -----------------------------------------------------------


def _apply(
    df: DataFrame, keys: Sequence[str], processor: PerRecord,
    schema: T.StructType, time_mode: str = "None",
) -> DataFrame:
    processor.output = schema.names
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append" if time_mode == "EventTime" else "Update",
        timeMode=time_mode,
    )


def _plus(df: DataFrame, *fields: tuple[str, str]) -> T.StructType:
    extra = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))
    return T.StructType([*df.schema.fields, *extra.fields])


def _keyed(df: DataFrame, keys: Sequence[str], ddl: str) -> T.StructType:
    return T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(ddl).fields])


def rolling_reduce(df, keys, order, value, combine, name="reduced") -> DataFrame:
    kind = df.schema[value].dataType.simpleString()
    return _apply(df, keys, Reduce(order, value, combine, kind), _plus(df, (name, kind)))


def rolling_sum(df, keys, order, value, name="total") -> DataFrame:
    return rolling_reduce(df, keys, order, value, lambda a, b: a + b, name)


def rolling_concat(df, keys, order, value, name="texts") -> DataFrame:
    return rolling_reduce(df, keys, order, value, lambda a, b: a + b, name)


def rolling_count(df, keys, order, name="n") -> DataFrame:
    return _apply(df, keys, Count(order), _plus(df, (name, "bigint")))


def rolling_list(df, keys, order, value, name="items", separator=", ") -> DataFrame:
    kind = df.schema[value].dataType.simpleString()
    return _apply(df, keys, Listed(order, value, kind, separator), _plus(df, (name, "string")))


def rolling_map_count(df, keys, order, sub_key, name="counts") -> DataFrame:
    return _apply(df, keys, MapCount(order, sub_key), _plus(df, (name, "map<string,bigint>")))


def delta_filter(df, keys, order, value, limit=5, initial=0) -> DataFrame:
    return _apply(df, keys, Delta(order, value, limit, initial), df.schema)


def merge_runs(df, keys, order, fields) -> DataFrame:
    """``fields``: category, start, end, duration and second-of-day columns."""
    return _apply(df, keys, Runs(order, keys, fields), _keyed(df, keys, Runs.STATE))


def merge_anchored(df, keys, order, fields) -> DataFrame:
    """``fields``: start, end, duration and second-of-day columns."""
    return _apply(df, keys, Anchored(order, keys, fields), _keyed(df, keys, Anchored.STATE))


def over_threshold(
    df, store, app, order, event_type, install="install", uninstall="uninstall",
    installs=100, uninstalls=50, fire_types=None,
) -> DataFrame:
    processor = Thresholds(order, event_type, install, uninstall, installs, uninstalls, fire_types)
    schema = _plus(df, ("installs_before", "bigint"), ("uninstalls_before", "bigint"))
    return _apply(df, [store, app], processor, schema)


def app_store(
    df, store, app, order, event_type, types, event_time, n=3, installs=100, uninstalls=50,
) -> DataFrame:
    """Firings of ``over_threshold``, with the first ``n`` apps by event time that have arrived.

    ``types`` are the install and the uninstall type; ``order`` and ``event_time``
    are numbers.
    """
    kind = df.schema[app].dataType.simpleString()
    processor = AppStore(order, app, kind, event_type, types, event_time, n, installs, uninstalls)
    schema = _plus(
        df, ("installs_before", "bigint"), ("uninstalls_before", "bigint"),
        *[(f"first_{t}", "string") for t in types],
    )
    return _apply(df, [store], processor, schema)


def every_nth(df, keys, order, n, pane_start="w_start", pane_end="w_end") -> DataFrame:
    """``df`` has pane bounds in milliseconds and a watermark on its event time."""
    return _apply(
        df, [*keys, pane_start], PaneCount(order, n, pane_end),
        _plus(df, ("n_so_far", "bigint")), "EventTime",
    )


def dynamic_peak(panes, keys, start="w_start", end="w_end", count="n") -> DataFrame:
    schema = T.StructType.fromDDL(
        "pane_number bigint, peak_start bigint, peak_end bigint, peak_count bigint"
    )
    return _apply(panes, keys, Peak([start], start, end, count), schema)


# Groups of keys whose states lie together: many for each shuffle partition, few rows in each.
BUCKETS = 8192


def two_inputs(
    left: DataFrame, right: DataFrame, keys: Sequence[str], processor: TwoInputs, schema: T.StructType,
) -> DataFrame:
    """Apply a processor of two inputs to streams of equal columns, tagged and united.

    Either side may come first. Expiry needs a watermark on the united streams.
    ``BUCKETS`` must stay as it is while a checkpoint is in use.
    """
    tagged = left.withColumn(processor.side, F.lit(0)).unionByName(right.withColumn(processor.side, F.lit(1)))
    processor.keyed(keys, tagged.schema)
    processor.output = schema.names
    expires = processor.expire_ms is not None
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    return tagged.withColumn("__bucket", bucket).groupBy("__bucket").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append" if expires else "Update",
        timeMode="EventTime" if expires else "None",
    )


def match_deliveries(
    orders: DataFrame, deliveries: DataFrame, order_id: str, delivery_order_id: str,
    order_ms: str, delivery_ms: str, limit_ms: int, expire_ms: int | None = None, delay: str = "0 seconds",
) -> DataFrame:
    """Twin of ``joins.match_deliveries``, without the running numbers of the classes.

    Rows of a key are taken by time within a micro-batch, and as they come from
    one to the next. Rows without a time match nothing, as those without an id.
    With ``expire_ms``, watermarks follow by ``delay``.
    """
    sides = [
        df.select(F.col(key).alias("id"), F.col(at).cast("bigint").alias("__t"))
        .filter("id is not null and __t is not null")
        for df, key, at in ((orders, order_id, order_ms), (deliveries, delivery_order_id, delivery_ms))
    ]
    if expire_ms is not None:
        sides = [s.withColumn("__ts", F.timestamp_millis("__t")).withWatermark("__ts", delay) for s in sides]
    schema = T.StructType(
        [sides[0].schema["id"], *T.StructType.fromDDL(
            "order_ms bigint, delivery_ms bigint, deadline_ms bigint, status string"
        ).fields]
    )
    return two_inputs(*sides, ["id"], Match(limit_ms, expire_ms), schema)

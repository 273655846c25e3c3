"""Ordered walks: Python state over the rows of a group, batch by batch.

For logic that depends on what happened to earlier rows. Rows are placed by
group and sorted on the JVM side; the Python side sees Arrow batches in order
and keeps only the state of the current group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def walk(df: DataFrame, by: Sequence[str], order: Sequence[str], step: Step, schema: T.StructType) -> DataFrame:
    """Apply ``step`` to the batches of partitions sorted by group and order."""
    placed = df.repartition(*by) if by else df.repartition(1)
    if by or order:
        placed = placed.sortWithinPartitions(*by, *order)
    return placed.mapInArrow(step, schema)


def groups(batch: pa.RecordBatch, by: Sequence[str]) -> Iterable[tuple]:
    """The group of each row."""
    if not by:
        return [()] * batch.num_rows
    return zip(*[batch.column(c).to_pylist() for c in by])


def openings(batch: pa.RecordBatch, by: Sequence[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Where groups begin in a sorted batch; its first row goes on with the group of the row before, if that is equal."""
    n = batch.num_rows
    changed = np.zeros(n, bool)
    changed[0] = before is None
    for name in by:
        column = batch.column(name)
        known = column if before is None else pa.concat_arrays([before.column(name), column])
        earlier, later = known.slice(0, len(known) - 1), known.slice(1)
        differs = pc.fill_null(pc.not_equal(earlier, later), False).to_numpy(zero_copy_only=False)
        nulls = known.is_null().to_numpy(zero_copy_only=False)
        changed[n - len(differs) :] |= differs | (nulls[1:] != nulls[:-1])
    return np.flatnonzero(changed)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )

"""What the text operators share: paths, word rules, slices of Arrow batches, joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shared_folder

# White space between words; the same set that bytes.split() cuts at.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# A side is broadcast only up to this many rows of bounded width.
BROADCAST_ROWS = 10_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1_000_000
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a slice holds about ``most_bytes`` of text, or one row."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def with_key(df: DataFrame, key: str, more: str) -> T.StructType:
    """Result schema of a task function: the key as it is in ``df``, then ``more``."""
    return T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL(more).fields])


def join_small(df: DataFrame, small: DataFrame, on: Sequence[str], rows: int, salts: int = 64) -> DataFrame:
    """Inner null-safe join with a table of ``rows`` rows, unique in ``on``.

    Up to ``BROADCAST_ROWS`` rows it is broadcast. Beyond that both sides are
    shuffled; as one key may hold a third of ``df``, every key is then spread
    over ``salts`` parts and the small rows are copied to each.
    """
    right = small.select(
        *[F.col(c).alias(f"__on_{i}") for i, c in enumerate(on)],
        *[c for c in small.columns if c not in on],
    )
    if rows <= BROADCAST_ROWS:
        left, right = df, F.broadcast(right)
        same = F.lit(True)
    else:
        left = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        right = right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same = F.col("__salt") == F.col("__part")
    for i, c in enumerate(on):
        same = same & F.col(c).eqNullSafe(F.col(f"__on_{i}"))
    joined = left.join(right, same, "inner")
    return joined.drop("__salt", "__part", *[f"__on_{i}" for i in range(len(on))])

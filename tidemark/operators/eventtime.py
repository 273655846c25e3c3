"""Watermarks, late rows and side outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.chunks import Fold, position, running
from tidemark.operators.windows import W_END, W_START, tumbling


def bounded_watermark(df: DataFrame, ts: str, delay_ms: int, allowed_lateness_ms: int = 0) -> DataFrame:
    """Watermark of a stream that is out of order by at most ``delay_ms``.

    Call it on the parsed rows: a source needs no watermark of its own. Allowed
    lateness keeps panes open longer, which is a larger delay here.
    """
    return df.withWatermark(ts, f"{delay_ms + allowed_lateness_ms} milliseconds")


def with_lateness(
    df: DataFrame, arrival: Sequence[str], ts_ms: str, size: int, delay_ms: int,
    allowed_lateness_ms: int = 0, **split,
) -> DataFrame:
    """Add pane bounds and whether the pane was closed when the row arrived.

    A pane is closed once the largest time seen before, less the delay, has
    reached its end. The prefix maximum runs over the whole table in arrival
    order; it is chunked like any heavy key.
    """
    seen = running(
        df, [], arrival, [Fold("__seen", "max", F.col(ts_ms))], exclusive=True, **split
    )
    reached = F.col("__seen") - delay_ms - allowed_lateness_ms
    return (
        tumbling(seen, ts_ms, size)
        .withColumn("is_late", F.coalesce(F.col(W_END) <= reached, F.lit(False)))
        .drop("__seen")
    )


def refired_panes(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts_ms: str, size: int, delay_ms: int,
    allowed_lateness_ms: int, folds: Sequence[Fold], **split,
) -> DataFrame:
    """Every firing of tumbling panes that are kept for some time after their end.

    Firing 0 is that of the watermark, over all rows that were on time. Then each
    late row whose pane ended less than ``allowed_lateness_ms`` before the
    watermark fires the pane again, with the result that includes it: firing 1,
    2, ... in the order of arrival, with the columns of the row. Later rows fire
    nothing. A pane without rows on time begins with firing 1.
    """
    seen = running(
        df, [], arrival, [Fold("__seen", "max", F.col(ts_ms))], exclusive=True, **split
    )
    reached = F.col("__seen") - delay_ms
    late = F.coalesce(F.col(W_END) <= reached, F.lit(False))
    rows = tumbling(seen, ts_ms, size).withColumn("__late", late)
    kept = rows.filter(~F.col("__late") | (reached < F.col(W_END) + allowed_lateness_ms)).drop("__seen")
    pane = [*keys, W_START, W_END]
    first = kept.filter(~F.col("__late")).groupBy(*pane).agg(
        F.lit(0).cast("bigint").alias("firing"), *[f.total(position(arrival)).alias(f.name) for f in folds]
    )
    number = Fold("firing", "count", F.when(F.col("__late"), 1))
    again = running(kept, pane, arrival, [number, *folds], **{"costly": True, **split}).filter("__late")
    return again.drop("__late").unionByName(first, allowMissingColumns=True)


def split_late(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows on time and late rows, each without the mark."""
    on_time = marked.filter(~F.col("is_late")).drop("is_late")
    late = marked.filter("is_late").drop("is_late")
    return on_time, late


def late_message(row: Column) -> Column:
    return F.concat(F.lit("Late Data: "), row)


def side_output(panes: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """All panes, and those that also go to the tagged second output."""
    return panes, panes.filter(condition)

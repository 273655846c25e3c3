"""Late rows of a stream as a second output.

The engine's own late-row handling uses a watermark that is one micro-batch
behind and drops what it finds late. Here each micro-batch is split by the rule
of :func:`tidemark.operators.eventtime.with_lateness`: the largest time seen in
earlier batches is carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.chunks import Fold, running
from tidemark.operators.windows import W_END, tumbling

_REACHED = "bigint"


class LateSplit:
    """``foreachBatch`` function that writes rows on time and late rows.

    Everything a batch leaves behind is stored under its batch id and replaced
    if the batch is replayed: its rows, and the largest time up to its end. A
    batch reads what its predecessor left, so a replay sees the same number.
    """

    def __init__(
        self, folder: str, arrival: Sequence[str], ts_ms: str, size: int, delay_ms: int,
        **split,
    ):
        self.folder, self.arrival, self.ts_ms = folder, list(arrival), ts_ms
        self.size, self.delay_ms, self.split = size, delay_ms, split

    def _carried(self, batch: DataFrame, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        path = f"{self.folder}/seen/batch={batch_id - 1}"
        left = batch.sparkSession.read.schema(f"seen {_REACHED}").parquet(path).first()
        return left["seen"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        carried = F.lit(self._carried(batch, batch_id)).cast(_REACHED)
        batch.persist()
        try:
            seen = running(
                batch, [], self.arrival, [Fold("__seen", "max", F.col(self.ts_ms))],
                exclusive=True, **self.split,
            )
            reached = F.greatest("__seen", carried) - self.delay_ms
            marked = (
                tumbling(seen, self.ts_ms, self.size)
                .withColumn("is_late", F.coalesce(F.col(W_END) <= reached, F.lit(False)))
                .drop("__seen")
            )
            for name, condition in (("on_time", ~F.col("is_late")), ("late", F.col("is_late"))):
                marked.filter(condition).drop("is_late").write.mode("overwrite").parquet(
                    f"{self.folder}/{name}/batch={batch_id}"
                )
            batch.agg(
                F.greatest(F.max(self.ts_ms).cast(_REACHED), carried).alias("seen")
            ).write.mode("overwrite").parquet(f"{self.folder}/seen/batch={batch_id}")
        finally:
            batch.unpersist()

    def start(self, df: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            df.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

"""Sinks: labelled print, several sinks from one stream, index files, SQL insert."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import keyed_state, shared_folder

Write = Callable[[DataFrame], None] | Callable[[DataFrame, int], None]


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with the sink's label in front, as a labelled print shows them."""
    return df.select(F.lit(label).alias("label"), "*")


def print_stream(
    df: DataFrame, checkpoint: str, label: str | None = None, mode: str = "append",
    sink: str = "console", every: str | None = None,
) -> StreamingQuery:
    """Print a stream; with ``sink="memory"`` it fills a table named by the label.

    ``every`` is the micro-batch interval, at which watermarks advance; without
    it the query handles what is there and ends.
    """
    writer = df.writeStream.format(sink).outputMode(mode)
    if sink != "memory":
        writer = writer.option("checkpointLocation", checkpoint)
    if label:
        writer = writer.queryName(label)
    pace = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**pace).start()


class Ledger:
    """Which sink has written which batch: an empty file for each, in a folder that outlives the driver.

    A sink's entry follows its write, so a batch that is replayed is written again
    only to the sink that was at it when the run ended. A sink that takes the
    number of the batch can write over what it had begun.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _file(self, sink: str, batch_id: int):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{sink}/batch={batch_id}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def has(self, sink: str, batch_id: int) -> bool:
        store, path = self._file(sink, batch_id)
        return store.exists(path)

    def add(self, sink: str, batch_id: int) -> None:
        store, path = self._file(sink, batch_id)
        store.create(path, True).close()


def to_all(
    sinks: Mapping[str, tuple[Callable[[DataFrame], DataFrame], Write]], ledger: Ledger | None = None,
):
    """A ``foreachBatch`` function that feeds several sinks from one read.

    Each entry derives its own rows from the batch; the batch is kept so that
    it is computed once. A sink is a function of the rows, or of the rows and the
    number of the batch. With a ``ledger`` a replayed batch goes only to the sinks
    that have not written it.
    """
    numbered = {name: len(signature(sink).parameters) > 1 for name, (_, sink) in sinks.items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        due = [name for name in sinks if ledger is None or not ledger.has(name, batch_id)]
        if not due:
            return
        batch.persist()
        try:
            for name in due:
                derive, sink = sinks[name]
                sink(derive(batch), *([batch_id] if numbered[name] else []))
                if ledger is not None:
                    ledger.add(name, batch_id)
        finally:
            batch.unpersist()

    return write


def write_all(
    parent: DataFrame,
    sinks: Mapping[str, tuple[Callable[[DataFrame], DataFrame], Write]],
) -> None:
    """The same for a static table."""
    to_all(sinks)(parent, 0)


def index_writer(folder: str, index: str, file_format: str = "json"):
    """A ``foreachBatch`` function that adds each batch to an index folder.

    Batches go to a folder of their own, which a replayed batch overwrites, so
    each record is in the index once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(file_format).save(
            f"{folder}/{index}/batch={batch_id}"
        )

    return write


def drained(df: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives for all that is in its sources now, as a table in the shared folder."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/drained-{uuid.uuid4().hex}"
    write = index_writer(folder, "rows", "parquet")
    write(spark.createDataFrame([], df.schema), -1)  # a source may have nothing at all
    with keyed_state(spark):
        query = (
            df.writeStream.foreachBatch(write).outputMode(mode)
            .option("checkpointLocation", f"{folder}/log")
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows").select(df.columns)


def insert_select(
    spark: SparkSession, target: str, source: str, columns: Sequence[str],
    overwrite: bool = False,
) -> DataFrame:
    """``INSERT INTO target SELECT columns FROM source``; returns the target."""
    verb = "OVERWRITE" if overwrite else "INTO"
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"INSERT {verb} {target} SELECT {names} FROM {source}")
    return spark.table(target)


def insert_stream(df: DataFrame, target: str, checkpoint: str, columns: Sequence[str]) -> StreamingQuery:
    return (
        df.select(*columns)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(target)
    )

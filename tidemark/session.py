"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or reuse) a session with the settings this package expects.

    ``spark.sql.shuffle.partitions`` is deliberately not set here: the cluster
    configures it, and AQE coalesces what turns out too small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Panes, dates and day names are defined in UTC, whoever built the session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of a few megabytes, unless the session says otherwise.

    A batch of long rows is otherwise held several times at up to 64 MB: beside
    the heap of the executor, and in its Python workers.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, "4m")
    return spark


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Settings that a query with keyed state takes over when it is started, whoever built the session."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Otherwise each of many small state partitions reserves megabytes of disk.
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only where a local session names none is a temporary one made up; on a
    cluster that would be a disk that the executors do not share.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    A reliable checkpoint outlives a lost executor; used where a costly input
    would otherwise be computed several times.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)

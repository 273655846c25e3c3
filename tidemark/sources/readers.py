"""Sources: tables, literal rows, CSV, message topics and generated rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import use_utc


def with_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as UTC instants; watermarks need the latter."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampNTZType)
        }
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return with_instants(spark.read.parquet(f"{folder}/{name}.parquet"))


def table_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    files_per_batch: int = 1,
) -> DataFrame:
    """The parquet files of a folder as a stream, some files per micro-batch."""
    use_utc(spark)
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    return with_instants(stream)


def whole_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of one micro-batch: order and watermark do not depend on how its files are cut."""
    use_utc(spark)
    path = f"{folder}/{name}.parquet"
    # A table may be a single file, which the stream source takes only by a pattern.
    pattern = f"{folder}/{name}.parque[t]"
    return with_instants(spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern))


def rows(
    spark: SparkSession, data: Iterable[Sequence], schema: T.StructType
) -> DataFrame:
    """Literal rows, numbered by an ``arrival`` column in list order."""
    numbered = T.StructType([*schema.fields, T.StructField("arrival", T.LongType())])
    return spark.createDataFrame(
        [(*row, i) for i, row in enumerate(data)], numbered
    )


def csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header-less CSV with typed columns by position; bad rows fail."""
    use_utc(spark)
    return spark.read.schema(schema).csv(path, header=False, mode="FAILFAST")


def csv_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1
) -> DataFrame:
    use_utc(spark)
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder, header=False, mode="FAILFAST")
    )


def topic_options(
    servers: str, topic: str, starting: str = "earliest", **extra: str
) -> dict[str, str]:
    """Options of the Kafka source for one topic."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **extra,
    }


def topic_stream(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """A topic as a stream of its message bytes.

    Needs the Kafka connector on the class path of the cluster.
    """
    use_utc(spark)
    options = topic_options(servers, topic, **extra)
    return spark.readStream.format("kafka").options(**options).load().select("value")


def decode_csv_value(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Comma-separated message bytes as typed columns.

    The first field of a message is a header and is skipped. A bad number or a
    missing field fails the job, with or without ANSI mode.
    """
    fields = F.split(F.col(value).cast("string"), ",")

    def field(i: int, kind: T.DataType) -> Column:
        text = F.get(fields, F.lit(i))
        typed = text.try_cast(kind)
        return F.when(typed.isNotNull(), typed).otherwise(
            F.raise_error(
                F.concat(F.lit(f"field {i} is not {kind.simpleString()}: "),
                         F.coalesce(F.col(value).cast("string"), F.lit("null")))
            ).cast(kind)
        )

    return df.select(
        *[field(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields, 1)]
    )


def generated_users(
    ids: DataFrame,
    id_column: str = "id",
    seed: int = 42,
    rating: tuple[int, int] = (1, 100),
    keep: Sequence[str] = (),
) -> DataFrame:
    """A user row per id with a repeatable pseudo-random rating and flag, beside the columns of ``keep``.

    One multiplicative congruential step per column on the id, so that a rerun
    of a lost task gives the same rows and no order or partitioning matters.
    """
    low, high = rating
    state = _minstd(F.col(id_column).cast("bigint") + seed)
    return ids.select(
        F.col(id_column).cast("bigint").alias("id"),
        (F.lit(low) + state % (high - low + 1)).cast("int").alias("rating"),
        (_minstd(state + 1) % 2 == 0).alias("subscription"),
        *keep,
    )


# Modulus and multiplier of the MINSTD generator.
_MINSTD_MODULUS = 2147483647
_MINSTD_MULTIPLIER = 48271


def _minstd(value: Column) -> Column:
    return F.pmod(value, F.lit(_MINSTD_MODULUS)) * _MINSTD_MULTIPLIER % _MINSTD_MODULUS


def generated_table(spark: SparkSession, n: int = 10_000, **options) -> DataFrame:
    return generated_users(spark.range(n), **options)


def generated_stream(
    spark: SparkSession, rows_per_batch: int = 500, ms_per_batch: int = 1000, **options
) -> DataFrame:
    """The generated rows at a fixed number per micro-batch."""
    source = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("advanceMillisPerBatch", ms_per_batch)
        .load()
    )
    return generated_users(source, id_column="value", **options)


def spread(df: DataFrame) -> DataFrame:
    """Enough partitions for costly work on each row of a small table.

    A small file is often a single row group, which one task reads. A scan that
    has a split per core already is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

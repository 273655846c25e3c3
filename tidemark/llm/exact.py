"""Exact deduplication with the keyed state of a stream. DataFrame operations only.

The rows are written once to the shared folder, where file and row number give
each a stable *locator*. That table is then read as a stream: a grouped
aggregate keeps, per digest of the normalised text and without expiry, the
number of copies and the identifier and locator of the best one, in RocksDB on
the executors' disks with its change log in the shared folder. All bytes of the
texts are then compared per digest; copies of one text meet already in their
own task there, so a text with very many copies is one row per task. Should
two texts share a digest, the groups of that digest are formed by text instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SPACE, scratch
from tidemark.session import ROCKSDB_PROVIDER, cut_lineage

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Otherwise each of many small state partitions reserves megabytes of disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass(frozen=True)
class Groups:
    """``members``: a row per document; ``kept``: the rows that stay, with the input's columns."""

    members: DataFrame
    kept: DataFrame


# Order of preference within a group: longest original text, smallest id,
# then the first locator, so that of rows repeated in full just one stays.
def _best(chars: Column, doc_id: Column, file: Column, row: Column) -> Column:
    return F.struct(
        (-chars).alias("chars"), doc_id.isNull().alias("no_id"), doc_id.alias("id"),
        file.alias("file"), row.alias("row"),
    )


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None,
) -> Groups:
    """Group documents whose texts are equal without white space.

    ``members`` has doc_id, keep_id, group_size, kept and ``digest``. Null texts
    equal empty ones. Rows that repeat an id, or all columns, are documents of
    their own. A null id loses against any other at equal length. An empty table
    gives empty results; other columns take no part and may have any names.
    ``files_per_batch`` bounds a micro-batch; by default all files form one.
    """
    spark = docs.sparkSession
    intake = scratch(spark, "exact-intake")
    body = F.coalesce(F.col(text), F.lit(""))
    docs.select(
        F.col(doc_id).alias("id"),
        F.length(body).cast("bigint").alias("chars"),
        digest(normalised(F.col(text))).alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
    ).write.parquet(intake)

    whole = spark.read.parquet(intake)
    rows = _located(whole)
    state = _state(whole, intake, files_per_batch)

    # Full bytes: every text of a digest must be the same one.
    texts = rows.select("digest", normalised(F.col("whole")[text]).alias("norm"))
    collided = cut_lineage(
        texts.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1").select("digest")
    )
    narrow = rows.select("id", "digest", "file", "row")
    if collided.isEmpty():
        members = _members(narrow, state, ["digest"])
        best = state
    else:
        clean = state.join(collided, "digest", "left_anti")
        told = rows.join(collided, "digest").withColumn("norm", normalised(F.col("whole")[text]))
        by_text = told.groupBy("digest", "norm").agg(
            F.min(_best(F.col("chars"), F.col("id"), F.col("file"), F.col("row"))).alias("best"),
            F.count(F.lit(1)).alias("n"),
        )
        same_text = _members(told.select("id", "digest", "norm", "file", "row"), by_text, ["digest", "norm"])
        members = _members(narrow, clean, ["digest"]).unionByName(same_text)
        best = clean.unionByName(by_text.drop("norm"))
    at = best.select(F.col("best.file").alias("file"), F.col("best.row").alias("row"))
    kept = rows.join(at, ["file", "row"], "left_semi").select("whole.*")
    return Groups(members, kept)


def _located(df: DataFrame) -> DataFrame:
    return df.select(
        *df.columns,
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def _members(rows: DataFrame, best: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(best, on).select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))).alias("kept"),
        "digest",
    )


def _state(whole: DataFrame, intake: str, files_per_batch: int | None) -> DataFrame:
    """Run the stream over the intake; the last state of every digest."""
    spark = whole.sparkSession
    fields = T.StructType([whole.schema[c] for c in ("id", "chars", "digest")])
    reader = spark.readStream.schema(fields)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    counted = _located(reader.parquet(intake)).groupBy("digest").agg(
        F.min(_best(F.col("chars"), F.col("id"), F.col("file"), F.col("row"))).alias("best"),
        F.count(F.lit(1)).alias("n"),
    )
    updates = scratch(spark, "exact-state")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        query = (
            counted.writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", scratch(spark, "exact-log"))
            .trigger(availableNow=True).start()
        )
    finally:  # the query has its own copy of the settings
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    saved = spark.read.schema(T.StructType([*counted.schema.fields, T.StructField("batch", T.LongType())]))
    # Written once more, so that a join with it finds two plain shuffles and can
    # split the rows of a digest that very many documents share.
    return cut_lineage(
        saved.parquet(updates)
        .groupBy("digest")
        .agg(F.max_by(F.struct("best", "n"), "batch").alias("last"))
        .select("digest", "last.best", "last.n")
    )

"""Long rows reach Python in small Arrow batches, and a text once."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language


def largest(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes])})


def test_languages_passes_small_batches(spark, folder):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    docs = spark.range(0, 12, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 50_000).alias("text"),
        F.lit("en").alias("lang"), F.lit(7).alias("a.b"), F.lit("r").alias("row"),
    )
    try:
        kept = corpus_pipeline.languages(spark, docs, folder)
        assert docs.select("text").mapInArrow(largest, "n bigint").agg(F.max("n")).first()[0] < 5_000_000
        assert kept.columns == docs.columns and kept.schema["lang"].dataType == docs.schema["lang"].dataType
        assert kept.exceptAll(docs).count() == 0 and kept.count() == 12
        found = language.identify(docs, language.train(docs), keep_text=True)
        assert found.columns == ["doc_id", "lang_pred", "score", "text"]
        spark.conf.set(limit, "1m")
        corpus_pipeline.languages(spark, docs, folder)
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit)

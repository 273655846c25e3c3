"""A corpus pipeline: five operators on whole documents, one after the other.

language ID, exact dedup, near-dedup, mixing to target weights, tokens. Every
stage gets all documents that its predecessor kept, from Parquet; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, language, mixing, pieces, simhash
from tidemark.llm.common import scratch, word_count
from tidemark.llm.queries import piece_model

# A text is rejected if no language has this share of its letters.
LEAST_SHARE = 0.3


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, and those that no language dominates.

    Null and empty texts go. Rows that repeat stay or go together; ids play no
    part. An empty table stays empty; other columns are passed on, whatever their
    names.
    """
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    # The text goes to Python and back once; the other columns go beside it.
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), "text")
    found = language.identify(rows, model, key="row", keep_text=True)
    accepted = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)
    return found.filter(accepted).select(
        *[F.col("text") if c == "text" else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, one stays.

    Of equal texts that is the longest, then the one with the smallest id (null
    last); of rows that repeat, one. Null counts as empty. An empty table stays
    empty; other columns are passed on, whatever their names.
    """
    return exact.deduplicate(docs).kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the one with the smallest id stays.

    Fingerprints are those of three-word shingles; two that differ in at most
    three bits are linked (see ``simhash``).

    A document is its id and its text: of different texts with one id, and of
    those with a null id (which come last), one stays. Rows that repeat both id
    and text stay or go together; the stage before leaves one of them. An empty
    table stays empty; other columns are passed on, whatever their names.
    """
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), digest.alias("digest"))
    found = simhash.near_duplicates(docs.select(key.alias("key"), "text"), "key", words=3, radius=3)
    # Those that go are far fewer than those that stay, so the join rarely has to sort texts.
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id.id", "doc_id.digest").distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", digest.alias("of_row")
    )
    same = (F.col("of_row") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("id"))
    return rows.join(gone, same, "left_anti").select("row.*")


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as rows of its own.

    Null texts and those without words are never taken. Rows that repeat are
    taken alike, null ids and null sources as any other. An empty table stays
    empty; other columns are passed on, whatever their names.
    """
    plan = mixing.mix(docs)
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id", "source", word_count(F.col("text")).alias("size"),
    )
    counted = plan.repetitions(sized, "size", "doc_id", "source").filter("repetitions > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("repetitions")))
    return counted.select("row", copies.alias("copy")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, checked by decoding them.

    Null texts count as empty and have the end id only. There is a row for every
    row; other columns take no part.
    """
    found = pieces.encode_decode(docs, piece_model())
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language", languages),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("mix", weights),
    ("sentencepiece", tokens),
]

# Trained models, XXH64 and tokens have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)

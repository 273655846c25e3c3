"""Nulls, empty and long texts, repeats, empty tables and clashing names, for every operator."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import exact, language, mixing, neighbours, passages, pieces, pii, quality, simhash, urls
from tidemark.llm.common import word_count

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "some words again " * 20_000

# Columns named like internal and result columns of the operators.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, row string, "
    "fingerprint string, bucket string, size string, target string, key string, `odd name` string, file string"
)


def docs(spark, texts, start=0):
    rows = [
        (start + i, t, "en" if i % 2 else None, [None, "a", "b"][i % 3], 1, *["x"] * 9) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


TEXTS = [None, "", "   \n\t", "one", "the same text here", "the same text here", LONG, "x" * 200_000, "¡Ünïcode 日本語 ½ 😀!"]


def mixed(df):
    plan = mixing.mix(df)
    sized = df.withColumn("__size", word_count(F.col("text")))
    return plan.repetitions(sized, "__size", "doc_id", "source")


OPERATORS = {
    "language": lambda df: language.identify(df, language.train(df)),
    "pieces": lambda df: pieces.encode_decode(df, MODEL),
    "mix": mixed,
    "pii": lambda df: pii.pseudonymised(df, "key"),
    "simhash": simhash.near_duplicates,
    "passages": passages.remove_repeats,
    "exact": lambda df: exact.deduplicate(df).members,
    "quality": lambda df: quality.score(df, quality.fit(df)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_per_row_with_odd_texts_and_names(spark, name):
    df = docs(spark, TEXTS)
    assert sorted(r["doc_id"] for r in OPERATORS[name](df).collect()) == list(range(len(TEXTS)))


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_that_repeat_and_null_ids(spark, name):
    df = docs(spark, TEXTS[:6])
    twice = df.union(df).union(df.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    assert OPERATORS[name](twice).count() == 14


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](docs(spark, TEXTS).limit(0)).count() == 0


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [1e300, 1e300]),
        (10, [1.0, 0.1]), (11, [1.0, 0.1]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id") == 0, k=3).orderBy("rank").collect()
    # Of three equal vectors the smaller ids come first.
    assert [(r["rank"], r["vec_id"]) for r in found] == [(1, 1), (2, 10), (3, 11)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    every = neighbours.nearest(df, F.col("vec_id") == 0, k=9).collect()
    assert len(every) == 4 and abs(every[-1]["score"] - 0.5**0.5) < 1e-12 or len(every) == 4


def test_urls_that_are_no_urls(spark):
    rows = [(0, None), (1, ""), (2, "no scheme"), (3, "http://"), (4, "http://A.Com"), (5, "x://y?z://w/p"),
            (6, "http://h/a#b/c?d"), (6, "http://h/a#b/c?d")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("h/a",), ("h/a",), (None,)], "canonical string")
    found = sorted(tuple(r) for r in urls.judge(df, listed, [("block", "com", "")]).select("page_id", "host", "path", "rule", "verdict").collect())
    assert found == [
        (0, "", "", None, "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "a.com", "", "com", "block"), (5, "y", "", None, "allow"), (6, "h", "/a", None, "block"), (6, "h", "/a", None, "block"),
    ]
    assert urls.judge(df.limit(0), listed.limit(0), []).count() == 0


def test_listed_rows_keep_columns_of_any_name(spark):
    rows = [(i, k, "mine", "too", "x") for i, k in enumerate(["a", None, "b", "a", "h" * 100_000])]
    df = spark.createDataFrame(rows, "id long, key string, listed string, block string, row string")
    listed = spark.createDataFrame([("a",), ("a",), (None,), ("h" * 100_000,)], "listed string")
    found = urls.listed_rows(df, "key", listed, "listed")
    assert found.columns == [*df.columns, "listed_"]
    assert sorted((r["id"], r["listed"], r["block"], r["row"], r["listed_"]) for r in found.collect()) == [
        (i, "mine", "too", "x", i in (0, 3, 4)) for i in range(5)]
    assert urls.listed_rows(df.limit(0), "key", listed, "listed").count() == 0
    assert urls.listed_rows(df, "key", listed.limit(0), "listed").filter("listed_").count() == 0


def test_near_copies_with_ids_that_repeat_or_are_null(spark):
    import corpus_pipeline as pipeline

    body = " ".join(f"word{i}" for i in range(300))
    rows = [(5, body), (5, body.replace(" ", "  ", 1)), (7, body), (None, body + " "), (5, "another text with this id"),
            (None, "a text without an id"), (None, None)]
    df = docs(spark, [t for _, t in rows]).drop("doc_id", "text")
    packed = spark.createDataFrame(
        [(i, t, *["x"] * (len(df.columns))) for i, t in rows],
        "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in df.columns),
    )
    found = pipeline.near_copies(spark, packed, "")
    assert found.columns == packed.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    same = {t for i, t in kept if t and t.startswith("word0")}
    # Of four near copies one of the smallest id; what is no copy stays, whatever its id.
    assert len(kept) == 4 and len(same) == 1
    assert [i for i, t in kept if t in same] == [5]
    assert sum(1 for i, _ in kept if i is None) == 2


def test_near_copies_against_brute_force(spark):
    import random

    import xxhash

    import corpus_pipeline as pipeline

    rng = random.Random(11)
    texts = []
    for n in (1, 8, 40, 400, 1500):
        for _ in range(5):
            base = [f"w{rng.randrange(3000)}" for _ in range(n)]
            texts.append(base)
            for changes in (0, 1, 1, 2, 8):
                copy = list(base)
                for _ in range(min(changes, n // 8)):
                    copy[rng.randrange(n)] = f"v{rng.randrange(3000)}"
                texts.append(copy)

    def fingerprint(w):
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [fingerprint(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    due = {i for i in range(len(texts)) if top(i) == i}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = {r["doc_id"] for r in pipeline.near_copies(spark, df, "").collect()}
    assert kept == due and 20 <= len(due) < len(texts)


CLASHING = "target whole source_size repetitions __size listed a.b row size copy digest of_row id __at".split()


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_values_of_columns_of_any_name(spark, stage):
    import corpus_pipeline as pipeline

    rows = [(i, f"some words of text number {i} and {i * i} more", "en", "ab"[i % 2]) for i in range(30)]
    rows += [(None, "a text without an id and a source", None, None)] * 2
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    schema = f"doc_id long, text string, lang string, source string, {extra}"
    df = spark.createDataFrame([(*r, *[f"{c}-{r[0]}" for c in CLASHING]) for r in rows], schema)
    found = pipeline.STAGES[stage][1](spark, df, "")
    assert found.columns == df.columns
    kept = {tuple(r) for r in found.collect()}
    assert len(kept) > 10 and kept <= {tuple(r) for r in df.collect()}
    assert pipeline.STAGES[stage][1](spark, df.limit(0), "").count() == 0


def test_last_stage_of_an_odd_table(spark):
    import corpus_pipeline as pipeline

    df = docs(spark, TEXTS[:6])
    twice = df.union(df).union(df.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    assert pipeline.tokens(spark, twice, "").count() == 13
    assert pipeline.tokens(spark, twice.limit(0), "").count() == 0


@pytest.mark.parametrize("copies", [6, 40])
def test_nearest_row_that_occurs_many_times(spark, copies):
    near = [(1, [1.0, 0.01])] * copies
    rest = [(i, [1.0, 0.1 * i]) for i in range(2, 12)]
    df = spark.createDataFrame([(0, [1.0, 0.0]), *near, *rest], "vec_id long, embedding array<float>")
    found = neighbours.nearest(df, F.col("vec_id") == 0, k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [1, 2, 3, 4, 5]
    assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]

"""License scans against a search of every block for every template."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses
from tidemark.llm.queries import LICENSE_PHRASES, QUERIES


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(text, templates, phrases, containment):
    w = words(text)
    base = [(i, label) for p, label in phrases for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    labels, score = {x for _, x in base}, 1.0 if base else 0.0
    for label, t in templates:
        n = len(words(t))
        due = set(words(t))
        step = max(8, 2 ** math.ceil(math.log2(n)))
        for start in range(0, max(1, len(w)), step):
            share = len(due & set(w[start : start + 2 * step])) / len(due)
            if share >= containment - 1e-9:
                labels.add(label)
                score = max(score, share)
    starts = [i for i, _ in base]
    return (len(w), len(base), min(starts, default=None), max(starts, default=None),
            sorted({x for _, x in base}), sorted(labels), score)


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]


def check(rows, texts, templates, phrases, containment):
    for r in rows:
        due = expected(texts[r["doc_id"]], templates, phrases, containment)
        assert tuple(r[c] for c in COLUMNS) == due[:-1] and abs(r["score"] - due[-1]) < 1e-12, r


@pytest.mark.parametrize("containment", [0.5, 0.7, 0.9, 1.0])
def test_blocks_against_all_templates(spark, containment):
    import random

    rng = random.Random(3)
    templates = [(f"t{i}", " ".join(rng.choice("abcdefghijklmnop") for _ in range(n))) for i, n in enumerate((3, 5, 9, 12, 20, 33))]
    phrases = [("a b", "ab"), ("a a", "aa"), ("c", "c")]
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice((0, 1, 7, 40, 200)))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(df, templates, phrases, containment).collect()
    assert len(rows) == len(texts)
    check(rows, texts, templates, phrases, containment)


def test_notices_in_long_texts_and_odd_rows(spark):
    filler = "plain prose about other things " * 3000
    texts = [None, "", "...", filler + "Released under\nthe MIT\tLicense. " + filler, "ALL RIGHTS RESERVED all rights reserved",
             "cc-by, CC BY. ccby", "É general public license 3", "licensed under the apache license version 2 0", filler,
             "permission is granted to any person", "x" * 200_000]
    schema = "doc_id long, text string, row string, places string, blocks string, label string, key string, `a.b` string"
    df = spark.createDataFrame([(i, t, *["x"] * 6) for i, t in enumerate(texts)], schema)
    rows = licenses.scan(df, phrases=LICENSE_PHRASES).orderBy("doc_id").collect()
    check(rows, texts, licenses.TEMPLATES, LICENSE_PHRASES, 0.9)
    assert rows[3]["labels"] == ["mit"] and rows[7]["labels"] == ["apache-2.0"] and not rows[8]["labels"]
    at = rows[3]["blocks"][0]
    assert at["start"] <= 15_000 and at["stop"] >= 15_005 and at["containment"] == 1.0
    twice = df.union(df).union(df.limit(4).withColumn("doc_id", F.lit(None).cast("long")))
    assert licenses.scan(twice, phrases=LICENSE_PHRASES).count() == 2 * len(texts) + 4
    assert licenses.scan(df.limit(0)).count() == 0
    assert licenses.scan(df, templates=(), phrases=()).filter("score = 0").count() == len(texts)


def test_query_on_all_documents(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op12_license_scan"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        due = expected(texts[r["doc_id"]], licenses.TEMPLATES, LICENSE_PHRASES, 0.9)
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])
        assert got == (*due[:4], ",".join(due[4]), ",".join(due[5])) and 0 <= r["score"] <= 1
    assert any("mit" in r["labels"] for r in rows) and any("apache-2.0" in r["labels"] for r in rows)

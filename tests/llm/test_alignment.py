"""Token alignment against a plain search over all token pairs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from tidemark.llm import alignment

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(BYTES)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pair(spark):
    return alignment.read_pair(spark, BYTES, PIECES)


def parts_of_a(text):
    byte = {c: bytes([b]) for c, b in alignment._byte_of_character().items()}
    ids = A.encode(" " + text, add_special_tokens=False).ids
    return [(i, b"".join(byte[c] for c in A.id_to_token(i))) for i in ids]


def parts_of_b(text):
    found = B.encode(text)
    return [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in found]


def expected(texts):
    """Per text: numbers, groups as text, links; and the documents that hold each id pair."""
    out, holders = [], defaultdict(int)
    for text in texts:
        a, b = (parts_of_a(text), parts_of_b(text)) if text else ([], [])
        due = b" " + text.encode() if text else b""
        if b"".join(x for _, x in a) != due or b"".join(x for _, x in b) != due:
            a = b = []
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, last = [], 0
        for end in common:
            sides = [[str(i) for (i, _), e in zip(side, es) if last < e <= end] for side, es in zip((a, b), ends)]
            groups.append("|".join(",".join(s) for s in sides))
            last = end
        links = Counter()
        for (i, x), e in zip(a, ends[0]):
            for (j, y), f in zip(b, ends[1]):
                if max(e - len(x), f - len(y)) < min(e, f):
                    links[i, j] += 1
        for pair in links:
            holders[pair] += 1
        out.append((len(a), len(b), len(groups), ";".join(groups), links))
    most = defaultdict(int)
    for (i, _), n in holders.items():
        most[i] = max(most[i], n)
    return [
        (na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if holders[p] == most[p[0]]),
         sum(n * holders[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if na else "")
        for na, nb, ng, text, links in out
    ], holders


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "a", "  two  spaces ", "a▁marker", "▁", "<|endoftext|> and </s> <s> <unk> <0x41>", "tab\tand\r\nlines\n\n  x",
    "日本語 テキスト 😀👩‍👩‍👧", "é́ﬁ½ Ａ １２３", "don't we'll 12345 !!!", "\x00\x01\x1c \x85 \xa0　", "x" * 700, "hello world", "hello world",
]


def test_odd_texts_against_all_token_pairs(spark, pair):
    due, holders = expected(ODD)
    schema = "doc_id long, text string, block long, pairs string, at string, key string, `a.b` string, n long"
    df = spark.createDataFrame([(i, t, 1, *["x"] * 4, 2) for i, t in enumerate(ODD)], schema)
    found, pairs = alignment.measure(df, pair)
    assert [tuple(r[c] for c in COLUMNS) for r in found.orderBy("doc_id").collect()] == due
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == holders


def test_documents_over_many_blocks(spark, folder, pair, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("n_chars < 1500").limit(60).cache()
    rows = docs.orderBy("doc_id").collect()
    due, _ = expected([r["text"] for r in rows])
    for size in (1, 5000):
        monkeypatch.setattr(alignment, "BLOCK_BYTES", size)
        monkeypatch.setattr(alignment, "SLICE_BYTES", size)
        # The sizes are read where batches are cut, so the functions ship with them.
        found, _ = alignment.measure(docs.repartition(3), pair)
        got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}
        assert [got[r["doc_id"]] for r in rows] == due


def test_groups_as_arrays(spark, pair):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    due, _ = expected(ODD)
    for r, d in zip(alignment.groups(df, pair).orderBy("doc_id").collect(), due):
        stops = list(zip([0, *r["a_stops"]], r["a_stops"], [0, *r["b_stops"]], r["b_stops"]))
        text = ";".join(
            ",".join(map(str, r["a_ids"][i:j])) + "|" + ",".join(map(str, r["b_ids"][k:m])) for i, j, k, m in stops
        )
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == d[-1]
        assert len(stops) == d[2] and len(r["a_ids"]) == d[0]


def test_rows_that_repeat_null_ids_and_empty_tables(spark, pair):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)], "doc_id long, text string")
    found, pairs = alignment.measure(df, pair)
    rows = found.orderBy(F.col("doc_id").asc_nulls_last(), F.desc("n_a")).collect()
    assert [r["doc_id"] for r in rows] == [1, 1, None, None]
    assert {r["n"] for r in pairs.collect()} == {3}
    assert [r["count_sum"] for r in rows] == [3 * rows[0]["n_links"]] * 3 + [0]
    for part in alignment.measure(df.limit(0), pair):
        assert part.count() == 0
    assert alignment.groups(df.limit(0), pair).count() == 0


def test_gallop_from_any_guess():
    rng = np.random.default_rng(5)
    for n, m in ((1, 1), (3, 50), (200, 40), (1000, 1000)):
        hay = np.unique(rng.integers(0, 5000, n))
        needles = np.sort(rng.integers(0, hay[-1] + 1, m))
        guess = rng.integers(-5, n + 5, m)
        assert (alignment.gallop(needles, hay, guess) == np.searchsorted(hay, needles)).all()


def test_merges_out_of_the_order_of_ids_take_the_library():
    import json

    read = json.load(open(BYTES))
    vocabulary = read["model"]["vocab"]
    one, two = "".join(read["model"]["merges"][0]), "".join(read["model"]["merges"][1])
    vocabulary[one], vocabulary[two] = vocabulary[two], vocabulary[one]
    coder = alignment.ByteCoder(json.dumps(read).encode())
    assert not coder.lossless
    library = Tokenizer.from_str(json.dumps(read))
    texts = ["the other thing", "", "then"]
    flat, counts, fine = coder.encode(texts)
    due = [library.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
    assert flat.tolist() == sum(due, []) and counts.tolist() == [len(d) for d in due] and fine.all()

"""Operators against brute force, exact round trips and held-out labels."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from tests.compare import differences
from tidemark.llm import components, exact, language, mixing, neighbours, passages, pieces, pii, quality, simhash, urls
from tidemark.llm.queries import QUERIES, SQL

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, folder, name):
    assert differences(spark, folder, name, QUERIES, SQL) is None


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_languages_on_held_out_documents(spark, folder):
    found = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, folder).collect()}
    held = [(r["lang"], found[r["doc_id"]]) for r in documents(spark, folder).collect() if found[r["doc_id"]]["held_out"]]
    assert len(held) > 40
    assert sum(lang == r["lang_pred"] for lang, r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 0, 4, 5])
    scores = rng.normal(size=(lengths.sum(), 3))
    path = language.viterbi(scores, lengths, 1.5)
    at = 0
    for n in lengths:
        def worth(p):
            return sum(scores[at + i, c] for i, c in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))

        best = max(worth(p) for p in np.ndindex(*[3] * n)) if n else 0
        assert abs(worth(path[at : at + n]) - best) < 1e-9
        at += n


def test_spans_of_a_mixed_text(spark, folder):
    docs = documents(spark, folder)
    model = language.train(docs)
    one = {lang: docs.filter(F.col("lang") == lang).filter("n_chars between 300 and 2000").first()["text"] for lang in ("fr", "de")}
    both = spark.createDataFrame([(0, one["fr"] + " " + one["de"])], "doc_id int, text string")
    found = [(r["start"], r["lang"]) for r in language.spans(both, model).orderBy("start").collect()]
    assert found[0] == (0, "fr") and found[-1][1] == "de" and len(found) <= 4


def test_scripts_narrow_languages(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("привет мир как дела", "ru"), ("hello world how are you", "en")] * 20)]
    model = language.train(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert model.score(["zzz"])[0][model.languages.index("ru")] == -np.inf
    assert model.score(["щщщ"])[0][model.languages.index("en")] == -np.inf


def test_scripts_of_all_letters_of_a_word(spark):
    texts = [("абвгдежзhello", "xx"), ("привет мир как дела", "ru"), ("hello world how are you", "en")]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts * 20)]
    model = language.train(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    en, ru, xx = (model.languages.index(x) for x in ("en", "ru", "xx"))
    latin, cyrillic, mixed, unknown = model.score(["hello", "привет", "абвhello", "日本"])
    assert latin[en] > -np.inf and latin[xx] > -np.inf and latin[ru] == -np.inf
    assert cyrillic[ru] > -np.inf and cyrillic[xx] > -np.inf and cyrillic[en] == -np.inf
    assert mixed[xx] > -np.inf and mixed[en] == mixed[ru] == -np.inf
    assert (unknown > -np.inf).all()
    two = language.Model(("en", "ru"), model.weights[:, [en, ru]], model.scripts[:, [en, ru]], model.sizes, model.switch)
    assert (two.score(["абвhello"]) > -np.inf).all()  # no language has both: both stay open


def test_tokens_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert pieces.by_words(library)
    rng = random.Random(1)
    texts = ["", None, " ", "a ", " ▁ ▁▁x▁", "\t\n\r x", "é́ﬁ½", "<s> </s> <0x0A>", "x" * 5000]
    texts += ["".join(rng.choice(" ▁ab\n\té日😀.,<>0x1 ́") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    encoded = pieces.encode_decode(df, MODEL, table_words=50)
    for r in encoded.collect():
        ids = library.encode(texts[r["doc_id"]] or "") + [library.eos_id()]
        assert r["ids"] == ids and r["decoded"] == library.decode(ids)
    assert pieces.decode(encoded, MODEL).exceptAll(encoded.select("doc_id", "decoded")).count() == 0


def test_mix_comes_near_its_targets(spark, folder):
    rows = QUERIES["op3_mix_sources"](spark, folder).collect()
    taken, target = Counter(), {}
    source = {r["doc_id"]: r["source"] for r in documents(spark, folder).collect()}
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    assert abs(sum(target.values()) - sum(r["size"] for r in rows)) < 1e-3
    for s, wanted in target.items():
        assert wanted * 0.85 <= taken[s] <= wanted + 1e-6


def test_water_filling_clamps_and_reshares(spark):
    sources = spark.createDataFrame([("a", 10, 1), ("b", 100, 2), ("c", 1000, 3)], "source string, source_size long, weight int")
    found = {r["source"]: r["target"] for r in mixing.targets(sources, 3).collect()}
    assert found == {"a": 30.0, "b": 300.0, "c": 780.0}


def luhn(digits):
    return sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark):
    texts = [
        "ann.b@mail.example.com +1 (988) 555-2485 4539578763621486 192.168.0.1 123-45-6789 1984-02-29 12/31/1999",
        "4539 5787 6362 1486, 988-555-2485, ann.b@mail.example.com",
        "999.1.1.1 1985-02-29 1234567812345678 000-12-3456 1.2.3.4.5 version 3.4",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [r["text"] for r in pii.pseudonymised(df, "k").orderBy("doc_id").collect()]
    mail, plus, area, phone, card, ip, ssn, iso, slashed = found[0].split()
    assert luhn(card) and card != "4539578763621486" and re.fullmatch(r"[a-z]{3}\.[a-z]@mail\.example\.com", mail)
    assert max(map(int, ip.split("."))) < 256 and re.fullmatch(r"\d{3}-\d{2}-\d{4}", ssn)
    np.datetime64(iso), re.fullmatch(r"\d\d/\d\d/\d{4}", slashed).group()
    linked = re.sub(r"[ -]", "", found[1])
    assert card in linked and (area + phone).translate(str.maketrans("", "", "()-")) in linked and mail in linked
    assert found[2] == texts[2]
    assert pii.pseudonymised(df, "other").filter("doc_id = 0").first()["text"] != found[0]


def test_permutations_are_one_to_one(spark):
    df = spark.range(271 * 3).select(pii.permuted(F.col("id"), F.lit(271).cast("long"), F.lit(3).cast("long"), "k", "t").alias("y"))
    assert sorted(r["y"] for r in df.collect()) == list(range(271 * 3))


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text").collect()
    for i, d in enumerate(docs[:40]):  # near copies: a word more at the end
        docs.append((10_000 + i, (d["text"] or "") + " more"))
    df = spark.createDataFrame([tuple(d) for d in docs], "doc_id long, text string")
    prints = {d[0]: brute_fingerprint(d[1]) for d in docs}
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for r in simhash.near_duplicates(df).collect():
        assert r["fingerprint"] & (1 << 64) - 1 == prints[r["doc_id"]] and r["component_id"] == find(r["doc_id"])


def test_links_lose_none_in_tiles_and_blocks(spark):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) for c in centres for _ in range(20)} | {0, 1, 7}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    for quarters, block in ((4, 2048), (4, 2), (8, 16)):
        found = components.components(simhash.links(df, 3, quarters, block)).collect()
        roots = {r["node"]: r["root"] for r in found}
        brute = {v: v for v in signed}
        changed = True
        while changed:
            changed = False
            for a in signed:
                for b in signed:
                    if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and brute[b] < brute[a]:
                        brute[a], changed = brute[b], True
        assert {v: roots.get(v, v) for v in signed} == brute


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def brute_passages(docs, width=13):
    first, words = {}, {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    for i, w in words.items():
        for k in range(len(w) - width + 1):
            g = tuple(w[k : k + width])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < i for j in range(width)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_passages_against_brute_force(spark):
    rng = random.Random(3)
    shared = [" ".join(str(rng.randrange(50)) for _ in range(n)) for n in (13, 14, 40, 200)]
    docs = []
    for i in range(200):
        parts = [" ".join(str(rng.randrange(3000)) for _ in range(rng.randrange(30))) for _ in range(3)]
        docs.append((i, " ".join([parts[0], rng.choice(shared), parts[1], rng.choice(shared), parts[2], "a " * (i % 40)])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for bucket_bytes, phrases in ((4_000_000, 50_000), (5_000, 7)):
        found = {r["doc_id"]: tuple(r)[1:] for r in passages.remove_repeats(df, bucket_bytes=bucket_bytes, phrases=phrases).collect()}
        assert found == brute_passages(docs)


def test_passages_of_pieces_in_many_contexts(spark):
    """One line of nine words between lines that vary, so that a piece is in far more than ``SHARED`` passages."""
    line = " ".join(f"w{i}" for i in range(9))
    around = [" ".join(f"c{k}x{i}" for i in range(5)) for k in range(60)]
    docs = [(i, " ".join([around[i % 60], line, around[(i * 7 + i // 60) % 60], line, "a " * 30])) for i in range(300)]
    found = passages.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: tuple(r)[1:] for r in found.collect()} == brute_passages(docs)


def test_passages_come_from_the_automata(monkeypatch):
    text = " ".join(f"w{i}" for i in range(20))
    held = passages._Bucket(pa.table({"doc_id": [1, 2], "text": [text, "x " + text]}))
    window = passages._runs(held.hashes[0], 13)
    order = np.argsort(window)
    first = np.full(len(window), 1)

    def removed():
        return [int(m.sum()) for m in passages._covered(held, window[order], first, 13, 100)]

    assert removed() == [0, 20]
    # Words that differ are not covered, though a window's hash is listed.
    held.hashes[1][1:] = held.hashes[0]
    held.words[1][10] = b"other"
    held.distinct = {w: 0 for w in {*held.words[0], *held.words[1]}}
    assert removed() == [0, 0]
    monkeypatch.setattr(passages, "_batches", lambda *a: iter(()))
    held.words[1][10] = b"w9"
    assert removed() == [0, 0]


def test_passages_with_rows_of_one_id_in_many_buckets(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None if i % 2 else 7, f"{i} {text} {i}") for i in range(40)]
    df = spark.createDataFrame([*rows, (9, text)], "doc_id long, text string")
    found = passages.remove_repeats(df, bucket_bytes=500).collect()
    assert len(found) == 41
    assert all(r["n_removed"] == (0 if r["doc_id"] == 7 else 40) for r in found)


def test_exact_with_colliding_digests_and_small_batches(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    weak = exact.deduplicate(docs.repartition(5), digest=lambda t: F.unhex(F.hex(F.crc32(t) % 7)), files_per_batch=1)
    strong = exact.deduplicate(docs)
    shown = ["doc_id", "keep_id", "group_size", "kept"]
    assert sorted(weak.members.select(shown).collect()) == sorted(strong.members.select(shown).collect())
    assert sorted(weak.kept.collect()) == sorted(strong.kept.collect())
    assert strong.kept.count() == strong.members.filter("kept").count()


def test_exact_keeps_the_longest_and_one_of_repeated_rows(spark):
    rows = [(3, "a b"), (1, "a b"), (2, "a  b"), (2, "a  b"), (4, None), (5, " ")]
    found = exact.deduplicate(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted((r["doc_id"], r["text"]) for r in found.kept.collect()) == [(2, "a  b"), (5, " ")]
    assert {(r["keep_id"], r["group_size"]) for r in found.members.collect()} == {(2, 4), (5, 2)}


def test_nearest_against_brute_force(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    v = np.stack(table["embedding"]).astype(float)
    ids = table["vec_id"].to_numpy()
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    found = defaultdict(list)
    for r in sorted(QUERIES["op6_nearest"](spark, folder).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[q]
        near[q] = -9
        best = ids[np.lexsort((ids, -near))[:5]]
        hits += len({i for i, _ in found[ids[q]]} & set(best.tolist()))
        for i, score in found[ids[q]]:
            assert abs(score - near[np.flatnonzero(ids == i)[0]]) < 1e-12
    assert hits >= 0.9 * 5 * len(found)


def test_nearest_in_small_cells(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    query = F.pmod("vec_id", F.lit(50)) == 0
    every = dict(parts=8, probes=8)
    a = neighbours.nearest(vectors, query, **every).collect()
    b = neighbours.nearest(vectors, query, cell_rows=9, cell_queries=2, **every).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in a) == sorted((r["query_id"], r["rank"], r["vec_id"]) for r in b)


def test_quality_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    kept = {r["doc_id"]: r["keep"] for r in QUERIES["op9_quality"](spark, folder).collect()}
    told = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert sum(kept[r["doc_id"]] == bool(r["quality"]) for r in told) >= 0.95 * len(told)
    assert all(kept[r["doc_id"]] for r in told if r["quality"]) or sum(not kept[r["doc_id"]] for r in told if r["quality"]) < 5


def test_labellers_are_estimated(spark):
    rng = np.random.default_rng(4)
    good = rng.random(4000) < 0.7
    patterns = Counter(
        "".join("+-"[int(rng.random() > p) ^ int(not g)] for p in (0.95, 0.8, 0.7)) for g in good
    )
    told = sorted(patterns.items())
    model = quality.estimate([p for p, _ in told], np.array([n for _, n in told], float))
    assert abs(model.good - 0.7) < 0.1 and model.accuracies()[0] > model.accuracies()[2]


def test_bloom_has_no_false_misses_and_few_false_hits(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(10_000).select(F.concat(F.lit("k"), "id").alias("key"))
    for most in (1, urls.MOST_BLOCKS):  # a filter that is full, and one of the wanted size
        found = urls.listed_rows(rows, "key", keys, "key", most)
        assert found.count() == 10_000 and found.filter("listed").count() == 5000
    bloom = urls.bloom(keys, "key")
    other = spark.range(5000, 10_000).select(F.concat(F.lit("k"), "id").alias("key"))
    probes = other.select(urls._block(F.col("key"), len(bloom.blocks)).alias("b"), urls._bits(F.col("key")).alias("bits")).toPandas()
    assert bloom.may_contain(probes["b"].to_numpy(), np.stack(probes["bits"]).astype(np.int64)).mean() < 0.02


def test_pipeline_stages(spark, folder):
    import corpus_pipeline as pipeline

    docs = documents(spark, folder)
    columns = docs.columns
    odd = spark.createDataFrame([(9_000_001, "1234 5678", None, None, 9), (9_000_002, None, None, None, 0)], docs.schema)
    docs = docs.union(odd)
    stages = dict(pipeline.STAGES)
    spoken = stages["language"](spark, docs, folder)
    assert spoken.columns == columns and spoken.count() == docs.count() - 2
    single = stages["exact_dedup"](spark, spoken, folder)
    texts = {re.sub(r"[\x20\x09-\x0D]", "", r["text"]) for r in spoken.collect()}
    assert single.columns == columns and single.count() == len(texts)
    apart = stages["simhash"](spark, single, folder)
    assert apart.columns == columns and 0 < apart.count() <= single.count()
    mixed = stages["mix"](spark, apart, folder)
    assert mixed.columns == columns and max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3
    ids = stages["sentencepiece"](spark, mixed, folder)
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert ids.count() == mixed.count()
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in ids.collect())


def test_word_table_has_all_frequent_words_once(spark):
    texts = ["the cat sat"] * 9 + ["the dog ran"] * 5 + ["rare"] + ["x" * 300 + " the"] * 4
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    proto = pieces.read_model(spark, MODEL)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    table = pieces.word_table(df, proto)
    assert sorted(table.words) == sorted("▁" + w for w in ("the", "cat", "sat", "dog", "ran"))
    stops = np.cumsum(table.sizes)
    for word, a, b in zip(table.words, stops - table.sizes, stops):
        assert table.ids[a:b].tolist() == library.encode(word[1:])
    assert pieces.word_table(df, proto, table_words=2).words == ["▁the"]
    assert pieces.word_table(df.limit(0), proto).words == []

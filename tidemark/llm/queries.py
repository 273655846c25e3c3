"""The operators of this subpackage as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm,
         length(coalesce(text, '')) AS chars
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)"""
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.exact import deduplicate

    members = deduplicate(read(spark, folder, "documents")).members
    return members.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


FILLS, SEED = 4, 7

# Water-filling in closed form: in the order of cap per weight, the first source
# that stays below its cap at the level over it and all later ones sets the level.
_MIX_SQL = (
    r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5('""" + str(SEED) + r""":' || CAST(doc_id AS VARCHAR)), 1, 16) AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
o AS (
  SELECT *, row_number() OVER before AS place,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM w WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, place) AS top FROM o WHERE NOT weight * level > 3 * source_size),
t AS (
  SELECT source, source_size,
         CASE WHEN weight * top > 3 * source_size THEN (3 * source_size)::DOUBLE
              ELSE weight * top END AS target
  FROM o, l),
f AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r0 AS (
  SELECT d.doc_id, d.source, d.size, d.u, f.target - f.whole * f.source_size AS fits, false AS taken
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)"""
    + "".join(
        f""",
x{i} AS (
  SELECT *, size > 0 AND NOT taken AND size <= fits AS candidate FROM r{i}),
y{i} AS (
  SELECT *, candidate AND sum(CASE WHEN candidate THEN size ELSE 0 END)
            OVER (PARTITION BY source ORDER BY u, doc_id) <= fits AS now FROM x{i}),
r{i + 1} AS (
  SELECT doc_id, source, size, u,
         fits - sum(CASE WHEN now THEN size ELSE 0 END) OVER (PARTITION BY source) AS fits,
         taken OR now AS taken FROM y{i})"""
        for i in range(FILLS)
    )
    + f"""
SELECT r{FILLS}.doc_id, r{FILLS}.size, f.source_size, f.target,
       (r{FILLS}.size * (f.whole + taken::INT))::BIGINT AS taken
FROM r{FILLS} JOIN f ON r{FILLS}.source IS NOT DISTINCT FROM f.source"""
)


@query(_MIX_SQL)
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.mixing import mix

    docs = read(spark, folder, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    planned = mix(docs, fills=FILLS, seed=SEED).repetitions(sized, "size", "doc_id", "source")
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken")
    )


@query()
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.simhash import near_duplicates

    found = near_duplicates(read(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.pieces import digests, encode_decode

    return digests(encode_decode(read(spark, folder, "documents"), piece_model()))


@query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.language import held_out, identify, train

    docs = read(spark, folder, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query(
    r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM p),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM g),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM f, generate_series(0, 12) AS s(k) WHERE first < doc_id),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
x AS (SELECT d.doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
k AS (
  SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept
  FROM x ANTI JOIN c ON x.doc_id = c.doc_id AND x.i = c.i GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN k ON d.doc_id = k.doc_id"""
)
def op7_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.passages import remove_repeats

    found = remove_repeats(read(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# The block list of the query: canonical URLs of pages whose text offers one of these.
SPAM = r"(?i)\b(casino|jackpot|viagra|pills|free money|click here|buy now)\b|spam-farm|cheap-pills"

_HOST_SQL = r"""
WITH r AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, html,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '(/|\.html)$', '')
            END AS canonical FROM p),
l AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(coalesce(html, '') || ' ' || host, '""" + SPAM + r"""')),
j AS (
  SELECT c.*, l.canonical IS NOT NULL AS listed,
         CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
              WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
              WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM c LEFT JOIN l ON c.canonical = l.canonical)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM j"""


@query(_HOST_SQL)
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.urls import canonical, host, judge, path

    pages = read(spark, folder, "pages")
    at = F.coalesce(host(F.col("url")), F.lit(""))
    spam = F.concat(F.coalesce("html", F.lit("")), F.lit(" "), at).rlike(SPAM)
    named = canonical(at, F.coalesce(path(F.col("url")), F.lit("")))
    listed = pages.filter(spam).select(named.alias("canonical"))
    return judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.neighbours import nearest

    return nearest(read(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


@query()
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.pii import pseudonymised

    return pseudonymised(read(spark, folder, "documents"), key="documents")


@query()
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.quality import fit, score

    docs = read(spark, folder, "documents")
    return score(docs, fit(docs))


@query()
def op11_align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.alignment import measure, read_pair

    pair = read_pair(spark, public_tokenizers.path("byte_bpe_50k.json"), piece_model())
    found, _ = measure(read(spark, folder, "documents"), pair)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


LICENSE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


def _license_sql() -> str:
    """Every block of every text against every template of its step, without filters."""
    import math

    from tidemark.llm.licenses import SHORTEST, TEMPLATES, words_of

    rows = []
    for label, text in TEMPLATES:
        words = [w.decode() for w in words_of(text)]
        step = max(SHORTEST, 1 << (len(words) - 1).bit_length())
        rows.append((label, sorted(set(words)), step, math.ceil(0.9 * len(set(words)) - 1e-9)))
    templates = ", ".join(f"('{label}', {whole}, {step}, {need})" for label, whole, step, need in rows)
    phrases = ", ".join(f"({text.split()}, '{label}')" for text, label in LICENSE_PHRASES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
t(label, whole, step, need) AS (VALUES {templates}),
p(words, label) AS (VALUES {phrases}),
i AS (SELECT r, w, unnest(range(len(w))) AS pos FROM d),
b AS (SELECT r, pos, label FROM i, p WHERE w[pos + 1] = words[1] AND w[pos + 1:pos + len(words)] = words),
s AS (SELECT r, w[pos + 1:pos + 2 * step] AS block, step FROM i, (SELECT DISTINCT step FROM t) x WHERE pos % step = 0),
m AS (
  SELECT r, label, len(list_intersect(whole, block))::DOUBLE / len(whole) AS share
  FROM s JOIN t ON s.step = t.step WHERE len(list_intersect(whole, block)) >= need),
l AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share FROM m UNION ALL SELECT r, label, 1.0 FROM b) x GROUP BY r),
n AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN l ON d.r = l.r LEFT JOIN n ON d.r = n.r"""


@query(_license_sql())
def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.licenses import scan

    found = scan(read(spark, folder, "documents"), phrases=LICENSE_PHRASES)
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query()
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.prefixes import trie, turns, with_starts

    found = trie(with_starts(turns(read(spark, folder, "conversations"))))
    return found.nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )

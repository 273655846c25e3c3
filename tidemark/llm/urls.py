"""URL filters: rules for hosts and paths, and a list of canonical URLs.

A blocked Bloom filter of the listed URLs passes possible hits on to an exact
join with the list, which removes the false ones. A key has all its bits in one
block of 512, so a probe reads one cache line. Blocks are built by the
executors with a bitwise aggregate. The filter has a size bound that does not
grow with the list: a longer list only makes false hits more frequent, and the
join then gets more rows, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_key
from tidemark.session import cut_lineage

WORDS = 8  # of 64 bits in a block
BITS = 8  # set by a key
BITS_PER_KEY = 12
MOST_BLOCKS = 1 << 18  # 16 MB


def host(url: Column) -> Column:
    """From the first ``://`` to the next ``/ ? #`` or the end, in lower case A-Z."""
    rest = _after_scheme(url)
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(host_: Column, path_: Column) -> Column:
    """Host without ``www.`` and path without a final slash or ``.html``; null without a host.

    Scheme, query and fragment do not tell pages apart.
    """
    bare = F.regexp_replace(host_, r"^www\.", "")
    short = F.regexp_replace(path_, r"(/|\.html)$", "")
    return F.when(host_ != "", F.concat(bare, short))


def rule(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host followed by path) and its verdict, or nulls.

    ``rules`` are (verdict, host, path). A rule fits its host and all subdomains
    of it, if the path starts with the rule's.
    """
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, start in reversed(ordered):
        fits = ((host_ == at) | F.endswith(host_, F.lit(f".{at}"))) & F.startswith(path_, F.lit(start))
        name = F.when(fits, F.lit(at + start)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> Column:
    """Two 36-bit numbers of a key: four 9-bit places of bits each."""
    second = F.xxhash64(key, F.lit(1))
    third = F.xxhash64(key, F.lit(2))
    return F.array(*[
        F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511)).cast("int") for h in (second, third) for i in range(BITS // 2)
    ])


class Bloom:
    """Blocks of bits; ``may_contain`` works on arrays of blocks and bit places."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    def may_contain(self, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
        words = self.blocks[block[:, None], bits >> 6]
        return ((words >> (bits & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def bloom(listed: DataFrame, key: str, most_blocks: int = MOST_BLOCKS) -> Bloom:
    """Build the filter of all keys; the driver gets its blocks, at most ``most_blocks``."""
    keys = listed.select(F.col(key).alias("key")).filter("key is not null")
    wanted = -(-keys.count() * BITS_PER_KEY // (WORDS * 64))
    blocks = min(max(1, wanted), most_blocks)
    places = keys.select(_block(F.col("key"), blocks).alias("block"), F.explode(_bits(F.col("key"))).alias("bit"))
    word = F.shiftright("bit", 6)
    one = F.expr("shiftleft(1L, bit & 63)")
    rows = places.groupBy("block").agg(
        *[F.bit_or(F.when(word == i, one).otherwise(F.lit(0).cast("bigint"))).alias(f"w{i}") for i in range(WORDS)]
    ).toPandas()
    filled = np.zeros((blocks, WORDS), np.uint64)
    if len(rows):
        filled[rows["block"].to_numpy(np.int64)] = rows[[f"w{i}" for i in range(WORDS)]].to_numpy(np.int64).view(np.uint64)
    return Bloom(filled)


def listed_rows(rows: DataFrame, key: str, listed: DataFrame, listed_key: str, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """Add ``listed`` to every row: is its key in the list? A null key is not.

    The list may have repeats and nulls. If the rows have a column of that name it
    stays, and underscores are put after the new one's name until it is free. An
    empty table or an empty list is no special case.
    """
    name = "listed"
    while name in rows.columns:
        name += "_"
    # Written once: it is counted, made into the filter and joined.
    keys = cut_lineage(listed.select(F.col(listed_key).alias("__key")).filter("__key is not null").distinct())
    found = bloom(keys, "__key", most_blocks)
    blocks = len(found.blocks)
    probed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        F.coalesce(_block(F.col(key), blocks), F.lit(0)).alias("block"), _bits(F.col(key)).alias("bits"),
        F.col(key).isNotNull().alias("has"),
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").flatten().to_numpy(zero_copy_only=False).reshape(-1, BITS).astype(np.int64)
            hit = found.may_contain(batch.column("block").to_numpy(), bits)
            hit &= batch.column("has").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(hit)], ["row", "hit"])

    probed = probed.mapInArrow(apply, with_key(probed, "row", "hit boolean"))
    hits = probed.filter("hit").select("row", F.col("row")[key].alias("__key"))
    sure = hits.join(keys.withColumn("__listed", F.lit(True)), "__key", "left")
    return (
        probed.filter("not hit").select("row.*", F.lit(False).alias(name))
        .unionByName(sure.select("row.*", F.coalesce("__listed", F.lit(False)).alias(name)))
    )


def judge(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]],
    page_id: str = "page_id", url: str = "url", listed_key: str = "canonical", most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """(page_id, host, path, canonical, rule, listed, verdict) of every page.

    A fitting rule decides; otherwise listed URLs are blocked and all others
    allowed. A url that is null or has no ``://`` has empty host and path, is in
    no list and is allowed. Rows may repeat; other columns take no part.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.coalesce(host(F.col(url)), F.lit("")).alias("host"),
        F.coalesce(path(F.col(url)), F.lit("")).alias("path"),
    )
    rows = rows.withColumn("canonical", canonical(F.col("host"), F.col("path")))
    marked = listed_rows(rows, "canonical", listed, listed_key, most_blocks)
    name, says = rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.select(
        "page_id", "host", "path", "canonical", name.alias("rule"), "listed", F.coalesce(says, by_list).alias("verdict")
    )

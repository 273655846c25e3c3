"""SimHash near-duplicates: tiled exact comparison of all fingerprints.

Fingerprints are 64 bits over hashed word shingles. Documents of equal
fingerprint are one node. Distinct fingerprints are dealt into *tiles* by the
population counts of their four 16-bit quarters: two fingerprints that differ
in at most r bits have counts that differ by at most r in sum, so all other
tile pairs are skipped, without loss. What is left is compared block by block
with numpy, exclusive-or and bit counts. A block pair returns a spanning forest
of the links it finds, not the links, so a dense group stays linear in size.

Work per fingerprint: its tile row is copied to the 64 neighbours on one side,
at most 512 bytes; the comparisons in numpy grow with the square of a tile. At
most 17^4 tiles exist; with ``quarters=8`` eighths are counted instead, which
makes tiles finer and pairs rarer for very large tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, with_key
from tidemark.llm.components import components
from tidemark.session import cut_lineage, small_batches

BLOCK = 2048  # fingerprints of a tile in one block


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42
) -> DataFrame:
    """(doc_id, fingerprint as a signed 64-bit number) of every row.

    Words are cut at ASCII white space and A-Z is lower-cased; a bit is set if
    it is set in over half of the XXH64 hashes of the shingles, repeats
    included. A text with fewer words is one shingle; an empty or null text has
    fingerprint zero.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = [_fingerprint(t, words, seed) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))],
                ["doc_id", "fingerprint"],
            )

    return rows.mapInArrow(apply, with_key(rows, "doc_id", "fingerprint bigint"))


_HASHES_AT_ONCE = 1 << 17


def _fingerprint(text: str | None, words: int, seed: int) -> int:
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    joined = b" ".join(parts)
    width = min(words, len(parts))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(parts) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    count = np.zeros(64, np.int64)
    for i in range(0, len(starts), _HASHES_AT_ONCE):
        some = zip(starts[i : i + _HASHES_AT_ONCE], stops[i : i + _HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], seed) for a, b in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        count += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * count > len(starts), bitorder="little")
    return int(set_bits.view("<u8")[0])


def _tile(fingerprint: Column, quarters: int) -> list[Column]:
    width = 64 // quarters
    mask = F.lit((1 << width) - 1)
    return [
        F.bit_count(F.shiftrightunsigned(fingerprint, i * width).bitwiseAND(mask)).cast("int")
        for i in range(quarters)
    ]


def _near(quarters: int, radius: int) -> list[tuple[int, ...]]:
    """Steps between tiles that can hold a link; of each and its opposite, one."""
    steps = product(range(-radius, radius + 1), repeat=quarters)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * quarters]


def links(distinct: DataFrame, radius: int = 3, quarters: int = 4, block: int = BLOCK) -> DataFrame:
    """A forest (a, b) that connects all ``fingerprint`` values within ``radius`` bits.

    ``distinct`` has every fingerprint once.
    """
    parts = [f"q{i}" for i in range(quarters)]
    placed = distinct.select("fingerprint", *[c.alias(p) for c, p in zip(_tile(F.col("fingerprint"), quarters), parts)])
    sizes = placed.groupBy(*parts).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    blocked = placed.join(sizes, parts).withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")))
    tiles = cut_lineage(blocked.groupBy(*parts, "block").agg(F.collect_list("fingerprint").alias("ones")))
    steps = F.array(*[F.array(*[F.lit(x) for x in s]) for s in _near(quarters, radius)])
    left = tiles.select(
        F.col("block").alias("left_block"), F.col("ones").alias("left_ones"), *parts, F.explode(steps).alias("step")
    )
    left = left.select(
        "left_block", "left_ones",
        F.forall("step", lambda x: x == 0).alias("same"),
        *[(F.col(p) + F.col("step")[i]).alias(p) for i, p in enumerate(parts)],
    )
    pairs = left.join(tiles, parts).filter(~F.col("same") | (F.col("left_block") <= F.col("block")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for c in ("left_ones", "ones")
                )
                found = _forest(a, b, radius)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[:, 0].view(np.int64)), pa.array(found[:, 1].view(np.int64))], ["a", "b"]
                    )

    return pairs.select("left_ones", "ones").mapInArrow(compare, "a bigint, b bigint")


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Star links that connect what is within ``radius`` between two blocks."""
    near = np.empty((len(a), len(b)), bool)
    for i in range(0, len(a), 256):
        near[i : i + 256] = np.bitwise_count(a[i : i + 256, None] ^ b[None, :]) <= radius
    rows, cols = near.any(axis=1), near.any(axis=0)
    a, b, near = a[rows], b[cols], near[np.ix_(rows, cols)]
    if not len(a):
        return np.empty((0, 2), np.uint64)
    # Nodes by value: a fingerprint in both blocks (a tile with itself) is one node.
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    of_a, of_b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        np.minimum.at(root, of_a, np.where(near, root[of_b][None, :], len(nodes)).min(axis=1))
        np.minimum.at(root, of_b, np.where(near, root[of_a][:, None], len(nodes)).min(axis=0))
        root = root[root]
        if np.array_equal(root, before):
            break
    linked = root != np.arange(len(nodes))
    return np.stack([nodes[linked], nodes[root[linked]]], axis=1)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3, quarters: int = 4
) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest doc_id reachable by links.

    Rows that repeat an id share its component; null ids take part in links but
    never name a component that has another id. All rows are returned; an empty
    table gives none. Texts are read whole; other columns take no part.
    """
    rows = cut_lineage(fingerprints(docs, doc_id, text, words))
    nodes = cut_lineage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = cut_lineage(components(links(nodes.select("fingerprint"), radius, quarters)))
    linked = nodes.join(roots, F.col("fingerprint") == F.col("node"))
    least = linked.groupBy("root").agg(F.min("least").alias("least_of_all"))
    named = roots.join(least, "root").select(F.col("node").alias("fingerprint"), "least_of_all")
    # Written, so that the last join has a plain shuffle on either side and can
    # split the rows of a fingerprint that very many documents share.
    names = cut_lineage(nodes.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("least_of_all", "least").alias("component_id")
    ))
    return rows.join(names, "fingerprint").select("doc_id", "fingerprint", "component_id")

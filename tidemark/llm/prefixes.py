"""A trie of conversation prefixes, as tables of nodes with minimal perfect hashes.

A node is a distinct sequence of first turns, named by a digest that is chained
along the turns, so conversations are compared without bringing them together.

* *Private* nodes, which only one conversation reaches, need no trie: below them
  there is one leaf and nothing shared. All else is done for *shared* nodes.
* A shared node is *light* if the paths below it have at most ``limit`` turns in
  sum. Light subtrees are the shards: a shard's nodes go to one task, which packs
  whole shards into a table. A minimal perfect hash gives every digest of the
  table a slot, which is verified against the digest that is stored there;
  counts are scattered into flat arrays, every node looks up its parent's slot,
  and values are added to the parents in the order of depth, deepest first.
* The tops of the shards hand their sums to their parents, which are heavy. One
  path for each lowest heavy node is the input of the next round, and so on
  until nothing is heavy. So no subtree, however many conversations share it,
  is held by one task, and every round leaves a small part of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rolling import rolling_count
from tidemark.session import cut_lineage

PART = 1024  # turns of a conversation chained in one go
LIMIT = 1000  # turns of the paths below a light node
TABLE = 100_000  # nodes of a table, but for its last shard
IDS = 512  # width of a range of ids that is joined to text in one row
ROOT = b""


def turns(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, place, said, chars): the turns of every conversation in order, places from 0.

    Null turns come first; equal turns go by role, then by the digest of role and
    text, so repeated rows stay repeated turns. Null roles and texts are empty.
    Rows without a key belong to no conversation and take no part.
    """
    spoken, body = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    said = _digest(F.concat(F.char_length(spoken).cast("string"), F.lit(":"), spoken, body).cast("binary"))
    rows = conversations.select(
        F.col(key).alias("key"), F.col(turn).alias("turn"), spoken.alias("role"), said.alias("said"),
        F.char_length(body).cast("bigint").alias("chars"),
    ).filter("key is not null")
    counted = rolling_count(rows, ["key"], ["turn", "role", "said"], "n", costly=True)
    return counted.select("key", (F.col("n") - 1).alias("place"), "said", "chars")


def _digest(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def with_starts(rows: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Rebuild every conversation on the start of its group's first one.

    Conversation c begins with the first h turns of conversation c - c % group
    (all if it has fewer, none if it is absent) and goes on with its own turns
    after its first h, where h is the CRC-32 of the decimal c modulo ``most``.
    Returns (key, place, said, chars, length); a conversation without any turn
    left has one row, with place -1 and length 0.
    """
    rows = cut_lineage(rows)
    taken = F.pmod(F.crc32(F.col("key").cast("string").cast("binary")), F.lit(most))
    own = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("taken", taken)
    own = cut_lineage(own.withColumn("base", F.expr(f"key - key % {group}")))
    first = own.select(F.col("key").alias("base"), F.col("n").alias("there"))
    kept = F.least("taken", F.coalesce("there", F.lit(0)))
    sizes = own.join(first, "base", "left").withColumn("kept", kept)
    sizes = cut_lineage(
        sizes.withColumn("length", F.col("kept") + F.greatest(F.col("n") - F.col("taken"), F.lit(0)))
        .select("key", "base", "taken", "kept", "length")
    )
    starts = rows.filter(F.col("place") < most - 1).withColumnRenamed("key", "base")
    starts = sizes.join(starts, "base").filter("place < kept").select("key", "place", "said", "chars", "length")
    rest = rows.join(sizes, "key").filter("place >= taken")
    rest = rest.select("key", (F.col("place") - F.col("taken") + F.col("kept")).alias("place"), "said", "chars", "length")
    none = sizes.filter("length = 0").select(
        "key", F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("binary").alias("said"),
        F.lit(0).cast("bigint").alias("chars"), "length",
    )
    return starts.unionByName(rest).unionByName(none)


def chained(rows: DataFrame) -> DataFrame:
    """(key, depth, digest, parent, chars, length): the digest of every prefix.

    Turns are chained by parts of ``PART`` turns; the parts of a long
    conversation are chained by their last digests.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, ROOT
        for batch in batches:
            digests, parents = [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "part", "said"))
            for key, part, said in zip(*columns):
                if (key, part) != at:
                    at, digest = (key, part), ROOT
                parents.append(digest)
                digest = hashlib.sha256(digest + said).digest()[:16]
                digests.append(digest)
            kept = [batch.column(c) for c in ("key", "part", "depth", "chars", "length")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(digests, pa.binary()), pa.array(parents, pa.binary())],
                ["key", "part", "depth", "chars", "length", "digest", "parent"],
            )

    def link_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, ROOT
        for batch in batches:
            before = []
            for key, last in zip(batch.column("key").to_pylist(), batch.column("digest").to_pylist()):
                # The first part's digests stand as they are, later ones go on from what came before.
                digest = hashlib.sha256(digest + last).digest()[:16] if key == at else last
                at = key
                before.append(digest)
            part = pa.compute.add(batch.column("part"), 1)
            yield pa.RecordBatch.from_arrays([batch.column("key"), part, pa.array(before, pa.binary())], ["key", "part", "before"])

    kind = rows.schema["key"].dataType.simpleString()
    parted = rows.filter("place >= 0").withColumns({"part": F.expr(f"place div {PART}"), "depth": F.col("place") + 1})
    local = cut_lineage(
        parted.repartition("key", "part").sortWithinPartitions("key", "part", "place")
        .select("key", "part", "depth", "chars", "length", "said")
        .mapInArrow(link, f"key {kind}, part bigint, depth bigint, chars bigint, length bigint, digest binary, parent binary")
    )
    # One row for every full part.
    ends = local.filter(F.col("depth") % PART == 0).select("key", "part", "digest")
    before = ends.repartition("key").sortWithinPartitions("key", "part").mapInArrow(
        link_parts, f"key {kind}, part bigint, before binary"
    )
    later = local.filter("part > 0").join(before, ["key", "part"])
    go_on = {c: _digest(F.concat("before", c)) for c in ("digest", "parent")}
    go_on["parent"] = F.when(F.col("depth") % PART == 1, F.col("before")).otherwise(go_on["parent"])
    names = ["key", "depth", "digest", "parent", "chars", "length"]
    return local.filter("part = 0").select(*names).unionByName(later.withColumns(go_on).select(*names))


class Slots:
    """A minimal perfect hash of distinct 128-bit digests.

    Every level hashes the digests that are left into twice as many places; those
    alone in their place get it. A slot is the rank of the place among all that
    are taken.
    """

    def __init__(self, digests: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, taken = np.arange(len(digests)), 0
        while len(left):
            at = self._at(digests[left], len(self.levels), 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            left = left[~alone[at]]
            if len(self.levels) > 200:
                raise ValueError("equal digests in a table")
        self.stored = np.zeros((taken, 2), np.uint64)
        self.stored[self._find(digests)] = digests

    @staticmethod
    def _at(digests: np.ndarray, level: int, places: int) -> np.ndarray:
        mixed = (digests[:, 0] ^ np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15) + digests[:, 1] * np.uint64(2 * level + 1)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(places)).astype(np.int64)

    def _find(self, digests: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._at(digests[left], level, len(alone))
            hit = alone[at]
            slots[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return slots

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        """Slots, and -1 for what is not in the table."""
        slots = self._find(digests)
        known = slots >= 0
        known[known] = (self.stored[slots[known]] == digests[known]).all(axis=1)
        return np.where(known, slots, -1)


def _as_numbers(column: pa.Array) -> np.ndarray:
    """Digests as rows of two numbers; the empty one of the root is zero."""
    return np.frombuffer(b"".join(d.ljust(16, b"\0") for d in column.to_pylist()), np.uint64).reshape(-1, 2)


def add_up(
    digests: np.ndarray, parents: np.ndarray, depth: np.ndarray, children: np.ndarray, leaves: np.ndarray, saved: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Children, leaves and savings of each node's subtree in one table, and whether its parent is elsewhere.

    The last three inputs are what children outside the table and the node itself bring.
    """
    slots = Slots(digests)
    own = slots(digests)
    up = np.full(len(own), -1, np.int64)
    up[own] = slots(parents)
    values = [np.zeros(len(own), np.int64) for _ in range(3)]
    for flat, given in zip(values, (children, leaves, saved)):
        flat[own] = given
    n, below, spared = values
    level = np.zeros(len(own), np.int64)
    level[own] = depth
    order = np.argsort(-level, kind="stable")
    np.add.at(n, up[up >= 0], 1)
    for some in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        below[some[n[some] == 0]] = 1
        inner = some[up[some] >= 0]
        np.add.at(below, up[inner], below[inner])
        np.add.at(spared, up[inner], spared[inner])
    return n[own], below[own], spared[own], up[own] < 0


_SUMS = ("n_children", "n_leaves", "saved_tokens")
_DONE = "digest binary, parent binary, n_children bigint, n_leaves bigint, saved_tokens bigint, is_top boolean"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the nodes of a partition that is sorted by shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TABLE:
            together = pa.Table.from_batches(held).combine_chunks()
            tops = together.column("top").to_pylist()
            cut = next((i for i in range(len(tops) - 1, 0, -1) if tops[i] != tops[i - 1]), 0)
            if cut:  # the last shard may go on
                yield _table(together.slice(0, cut))
                held = together.slice(cut).to_batches()
    if held:
        yield _table(pa.Table.from_batches(held))


def _table(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    numbers = [rows.column(c).to_numpy() for c in ("depth", *_SUMS)]
    n, leaves, saved, is_top = add_up(*(_as_numbers(rows.column(c)) for c in ("digest", "parent")), *numbers)
    arrays = [*(rows.column(c).combine_chunks() for c in ("digest", "parent")), *map(pa.array, (n, leaves, saved, is_top))]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _DONE.split(", ")])


def subtrees(nodes: DataFrame, paths: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(digest, parent, n_children, n_leaves, saved_tokens) of every shared node's subtree.

    ``nodes``: (digest, parent, depth, n_children, n_leaves, saved_tokens) with what
    the node itself and its private children bring. ``paths``: (key, depth, digest,
    length) of all members.
    """
    done = None
    while True:
        below = F.sum(F.col("length") - F.col("depth") + 1)
        # ``by`` is one of the paths through a node; they all meet the same light top above it.
        weights = cut_lineage(paths.groupBy("digest").agg((below <= limit).alias("light"), F.min("key").alias("by")))
        weighed = paths.join(weights.select("digest", "light"), "digest")
        tops = weighed.filter("light").groupBy("key").agg(F.min(F.struct("depth", "digest")).alias("top"))
        marked = cut_lineage(nodes.join(weights, "digest"))
        shards = marked.filter("light").join(tops.select(F.col("key").alias("by"), F.col("top.digest").alias("top")), "by")
        shards = shards.select("top", "digest", "parent", "depth", *_SUMS)
        sums = cut_lineage(shards.repartition("top").sortWithinPartitions("top").mapInArrow(_tables, _DONE))
        done = sums if done is None else done.unionByName(sums)
        heavy = marked.filter("not light")
        if heavy.isEmpty():
            return done.drop("is_top")
        handed = sums.filter("is_top").groupBy(F.col("parent").alias("digest")).agg(
            F.count(F.lit(1)).alias("c0"), F.sum("n_leaves").alias("c1"), F.sum("saved_tokens").alias("c2")
        )
        more = {c: F.col(c) + F.coalesce(f"c{i}", F.lit(0)) for i, c in enumerate(_SUMS)}
        heavy = cut_lineage(heavy.join(handed, "digest", "left").withColumns(more).drop("c0", "c1", "c2"))
        nodes = heavy.drop("light", "by")
        inner = nodes.select(F.col("parent").alias("digest")).distinct()
        lowest = heavy.join(inner, "digest", "left_anti").select(F.col("by").alias("key"), F.col("depth").alias("last"))
        paths = cut_lineage(
            weighed.filter("not light").drop("light", "length").join(lowest, "key").filter("depth <= last")
            .withColumnRenamed("last", "length")
        )


def ends(members: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the keys that end at a node, ascending, joined by commas.

    Keys are joined to text by ranges of their values, so that a node where very
    many conversations end is a row per range, and is read as a stream.
    """
    pieces = members.groupBy("digest", F.floor(F.col("key") / IDS).alias("range")).agg(
        F.array_join(F.array_sort(F.collect_list("key")).cast("array<string>"), ",").alias("piece")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None
        for batch in batches:
            out = []
            for digest, piece in zip(batch.column("digest").to_pylist(), batch.column("piece").to_pylist()):
                if digest != at:
                    if at is not None:
                        out.append((at, running.hexdigest()))
                    at, running = digest, hashlib.sha256(piece.encode())
                else:
                    running.update(b"," + piece.encode())
            yield _pairs(out)
        if at is not None:
            yield _pairs([(at, running.hexdigest())])

    placed = pieces.repartition("digest").sortWithinPartitions("digest", "range")
    return placed.mapInArrow(hashed, "digest binary, ends_sha256 string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["digest", "ends_sha256"]
    )


@dataclass(frozen=True)
class Trie:
    """``nodes``: a row per node; ``members``: (key, depth, digest) of every prefix of every conversation."""

    nodes: DataFrame
    members: DataFrame


def trie(rows: DataFrame, limit: int = LIMIT) -> Trie:
    """The trie of sequences (key, place, said, chars, length), see ``with_starts``.

    Nodes have digest, conv_id (smallest member), depth, parent_conv_id (null for
    the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. A
    conversation without turns is a member of the root alone. Without any
    conversation there is no node.
    """
    rows = cut_lineage(rows)
    members = cut_lineage(chained(rows))
    grouped = members.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("key").alias("first"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.min("chars").alias("chars"), F.max("length").alias("length"),
    )
    grouped = cut_lineage(grouped)
    shared = grouped.filter("n_convs > 1")
    private = grouped.filter("n_convs = 1")
    # Private nodes: is the parent shared? Then its smallest member is the parent's name.
    above = shared.select(F.col("digest").alias("parent"), F.col("first").alias("above"))
    private = cut_lineage(private.join(above, "parent", "left"))

    outer = private.filter("above is not null").groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("alone"))
    alone = F.coalesce("alone", F.lit(0))
    given = shared.join(outer, "digest", "left").select(
        "digest", "parent", "depth", alone.alias("n_children"), alone.alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    of_shared = members.join(shared.select("digest"), "digest")
    paths = of_shared.select("key", "depth", "digest", "length")
    sums = cut_lineage(subtrees(cut_lineage(given), cut_lineage(paths), limit))

    last = members.filter("depth = length").select("digest", "key")
    at_shared = last.join(shared.select("digest"), "digest")
    at_root = rows.filter("length = 0").select(F.lit(ROOT).alias("digest"), "key")
    ended = cut_lineage(ends(at_shared.unionByName(at_root)))
    none = hashlib.sha256(b"").hexdigest()
    of_ends = F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")

    whole = rows.filter("place <= 0").agg(F.countDistinct("key").alias("n_convs"), F.min("key").alias("first"))
    tops = private.filter("depth = 1").agg(F.count(F.lit(1)).alias("a0"), F.count(F.lit(1)).alias("a1"), F.lit(0).alias("a2"))
    tops = tops.unionByName(sums.filter(F.col("parent") == F.lit(ROOT)).agg(
        F.count(F.lit(1)).alias("a0"), F.coalesce(F.sum("n_leaves"), F.lit(0)).alias("a1"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("a2"),
    )).agg(*[F.sum(f"a{i}").alias(f"a{i}") for i in range(3)])
    root_first = whole.select(F.col("first").alias("above"))
    root = (
        whole.filter("n_convs > 0").join(F.broadcast(tops))  # one row each
        .join(ended.filter(F.col("digest") == F.lit(ROOT)), F.lit(True), "left")
        .select(
            F.lit(ROOT).alias("digest"), F.col("first").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"),
            F.lit(None).cast(rows.schema["key"].dataType).alias("parent_conv_id"), "n_convs",
            F.col("a0").alias("n_children"), F.greatest("a1", F.lit(1)).alias("n_leaves"), F.col("a2").alias("saved_tokens"), of_ends,
        )
    )
    least = root_first.first()["above"]
    at_top = F.when(F.col("depth") == 1, F.lit(least).cast(rows.schema["key"].dataType))
    is_end = F.col("depth") == F.col("length")
    of_private = private.select(
        "digest", F.col("first").alias("conv_id"), "depth", F.coalesce(at_top, "above", "first").alias("parent_conv_id"),
        "n_convs", F.when(is_end, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(is_end, F.sha2(F.col("first").cast("string"), 256)).otherwise(none).alias("ends_sha256"),
    )
    of_shared = (
        shared.drop("parent").join(sums, "digest").join(above, "parent", "left").join(ended, "digest", "left")
        .select("digest", F.col("first").alias("conv_id"), "depth", F.coalesce(at_top, "above").alias("parent_conv_id"),
                "n_convs", *_SUMS, of_ends)
    )
    return Trie(of_private.unionByName(of_shared).unionByName(root), members.select("key", "depth", "digest"))

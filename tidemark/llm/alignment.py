"""Alignment of two tokenizers: galloping intersection of their byte ends.

Both tokenizers cut the same bytes (a space and the text), so a text has two
sorted lists of byte ends. The shorter list of a text drives the search in the
longer one: from a guess, steps double until they pass the end that is looked
for, and the bracket is then halved. That gives every end its *rank* in the
longer list, and tells which ends are common. Common ends cut the tokens into
groups; the difference of the ranks of two neighbouring ends is the range of
tokens of the other side that a token overlaps. All texts of a slice are
searched together, in numpy.

How often two ids are linked in the corpus needs all documents:

1. Tasks encode and align blocks of documents. A block's distinct id pairs are
   written once, with the number of its documents that hold each; a document
   keeps places in that list.
2. The pairs of all blocks are summed; the highest count of every id follows.
3. Each block gets the counts of its own pairs back, and its documents add up
   theirs.

So shuffles carry a pair once per block, however many documents hold it, and no
table of all pairs has to fit anywhere.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, text_slices, with_key
from tidemark.llm.pieces import MARK, Model, Table, read_model

SLICE_BYTES = 2_000_000  # text aligned together
BLOCK_BYTES = 16_000_000  # text whose pairs are written together
CACHED = 400_000  # marked words a task remembers

# How the byte-level pre-tokenizer splits a text.
SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Coder:
    """A tokenizer; ``tokens`` are the bytes of every id."""

    tokens: list[bytes]
    lossless = False  # can a text's tokens have other bytes than the text?

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of each text's."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their numbers, and whether a text's tokens have the bytes of a space and the text."""
        if not hasattr(self, "widths"):
            self.widths = np.array([len(t) for t in self.tokens], np.int64)
        flat, counts = self.ids(texts)
        due = [(" " + t).encode() if t else b"" for t in texts]
        total = np.concatenate([[0], np.cumsum(self.widths[flat])])
        stops = np.concatenate([[0], np.cumsum(counts)])
        fine = np.diff(total[stops]) == np.fromiter(map(len, due), np.int64, len(due))
        if not fine.all() or not self.lossless and b"".join([self.tokens[i] for i in flat.tolist()]) != b"".join(due):
            each = (flat[i:j].tolist() for i, j in zip(stops[:-1], stops[1:]))
            fine = np.array([b"".join([self.tokens[i] for i in ids]) == d for ids, d in zip(each, due)], bool)
        return flat, counts, fine


class ByteCoder(Coder):
    """A byte-level tokenizer of the tokenizers library, applied to a space and the text.

    Where its merges come in the order of their ids, the ids themselves are the
    ranks of the merges, and tiktoken applies them several times as fast.
    """

    def __init__(self, definition: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        byte = _byte_of_character()
        read = json.loads(definition)
        vocabulary = read["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in read["added_tokens"]}
        names = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items() if i not in special}
        self.tokens = [names.get(i, special.get(i, b"")) for i in range(max({**names, **special}) + 1)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        made = [vocabulary["".join(m)] for m in merges]
        if made == sorted(set(made)) and len(made) + 256 == len(names) and (not made or made[0] >= 256):
            ranks = {t: i for i, t in names.items()}
            fast = tiktoken.Encoding("own", pat_str=SPLITS, mergeable_ranks=ranks, special_tokens={})
            self._one = lambda text: fast.encode_to_numpy(text, disallowed_special=())
            self.lossless = True  # every byte has an id, and a merge joins the bytes of its parts
        else:
            library = Tokenizer.from_str(definition.decode("utf-8"))
            library.encode_special_tokens = True
            self._one = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [self._one(" " + t) if t else _NONE for t in texts]
        return np.concatenate([_NONE, *each]).astype(np.int64), np.fromiter(map(len, each), np.int64, len(each))


_NONE = np.empty(0, np.uint32)


class PieceCoder(Coder):
    """A sentencepiece model that puts a space before the text by itself.

    Distinct marked words are segmented once per task, see ``pieces``.
    """

    def __init__(self, proto: bytes):
        self.model = Model(proto, Table(), CACHED)
        lib = self.model.library
        self.tokens = [
            bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(lib.id_to_piece(i) for i in range(lib.get_piece_size()))
        ]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, stops = self.model.encode(texts, end=False)
        return flat.astype(np.int64), np.diff(stops)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as they are, all others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def gallop(needles: np.ndarray, hay: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """First place in sorted ``hay`` that is not below each needle (at most the last needle's end).

    All needles advance together: steps double away from the guess until the
    needle is bracketed, then the bracket is halved.
    """
    n = len(hay)
    low = np.full(len(needles), -1, np.int64)  # below the needle, or -1
    high = np.full(len(needles), n, np.int64)  # not below it, or n
    guess = np.clip(guess, 0, n - 1)
    under = hay[guess] < needles
    for side, up in ((np.flatnonzero(under), True), (np.flatnonzero(~under), False)):
        (low if up else high)[side] = guess[side]
        step = 1
        while len(side):
            at = low[side] + step if up else high[side] - step
            inside = at < n if up else at >= 0
            side, at = side[inside], at[inside]
            on = (hay[at] < needles[side]) == up
            (high if up else low)[side[~on]] = at[~on]
            side, at = side[on], at[on]
            (low if up else high)[side] = at
            step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        is_low = hay[middle] < needles[open_]
        low[open_[is_low]] = middle[is_low]
        high[open_[~is_low]] = middle[~is_low]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


@dataclass(frozen=True)
class Aligned:
    """A slice of texts: ids of both sides in a row, group ends, and links by place."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray  # tokens of each text
    n_b: np.ndarray
    a_ends: np.ndarray  # does a group end with this token?
    b_ends: np.ndarray
    link_a: np.ndarray  # places in ``a`` and ``b`` of tokens that overlap
    link_b: np.ndarray

    def per_text(self, counted: np.ndarray, of_a: np.ndarray) -> np.ndarray:
        """Sum of a number per A token, by text."""
        owner = np.repeat(np.arange(len(self.n_a)), self.n_a)[of_a]
        return np.bincount(owner, weights=counted, minlength=len(self.n_a)).astype(np.int64)


def align(a: Coder, b: Coder, texts: list[str | None]) -> Aligned:
    """Align a slice of texts. Null, empty and texts that tokens do not give back have no tokens.

    A marker in a text always comes back as a space, so such texts are left out at once.
    """
    texts = [t if t and MARK not in t else "" for t in texts]
    ids_a, n_a, fine_a = a.encode(texts)
    ids_b, n_b, fine_b = b.encode(texts)
    if not (fine_a & fine_b).all():
        texts = [t if x and y else "" for t, x, y in zip(texts, fine_a, fine_b)]
        ids_a, n_a, _ = a.encode(texts)
        ids_b, n_b, _ = b.encode(texts)
    # A text has the same bytes on both sides, so ends may be counted through the whole slice.
    ends = np.cumsum(a.widths[ids_a]), np.cumsum(b.widths[ids_b])
    numbers = n_a, n_b
    starts = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    group_ends = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    shorter_a = n_a <= n_b
    for short, drives in ((0, shorter_a), (1, ~shorter_a)):
        long = 1 - short
        own = np.repeat(np.arange(len(texts)), numbers[short])
        places = np.flatnonzero(drives[own])
        if not len(places):
            continue
        own = own[places]
        inner = places - starts[short][own]
        guess = starts[long][own] + inner * numbers[long][own] // numbers[short][own]
        needles = ends[short][places]
        rank = gallop(needles, ends[long], guess)
        common = ends[long][rank] == needles
        group_ends[short][places[common]] = True
        group_ends[long][rank[common]] = True
        # A token overlaps from the end of its predecessor up to its own end.
        first = np.empty_like(rank)
        first[1:] = rank[:-1] + common[:-1]
        opening = inner == 0
        first[opening] = starts[long][own[opening]]
        width = rank - first + 1
        total = np.cumsum(width)
        of_short = np.repeat(places, width)
        of_long = np.repeat(first - (total - width), width) + np.arange(total[-1])
        links.append((of_short, of_long) if short == 0 else (of_long, of_short))
    link_a, link_b = (np.concatenate([p[i] for p in links]) if links else np.empty(0, np.int64) for i in (0, 1))
    return Aligned(ids_a, ids_b, n_a, n_b, *group_ends, link_a, link_b)


class GroupText:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size_a: int, size_b: int):
        self.width = len(str(max(size_a, size_b))) + 1
        self.sizes = size_a, size_b
        self.of_a, self.of_b = (self._table(n, ends) for n, ends in ((size_a, [",", "|"]), (size_b, [",", ";", ""])))
        self.long_a, self.long_b = (np.char.str_len(t).astype(np.uint8) for t in (self.of_a, self.of_b))

    def _table(self, size: int, ends: list[str]) -> np.ndarray:
        """Every id with every sign after it; unused bytes are zero."""
        return np.array([f"{i}{end}".encode() for end in ends for i in range(size)], f"S{self.width}")

    def __call__(self, x: Aligned) -> list[bytes]:
        group_a = np.cumsum(x.a_ends) - x.a_ends
        group_b = np.cumsum(x.b_ends) - x.b_ends
        stops_a, stops_b = np.flatnonzero(x.a_ends) + 1, np.flatnonzero(x.b_ends) + 1
        starts_b = np.concatenate([[0], stops_b])
        sign_b = x.b_ends.astype(np.int64)
        sign_b[np.cumsum(x.n_b)[x.n_b > 0] - 1] = 2  # nothing after a text's last token
        out = np.empty(len(x.a) + len(x.b), f"S{self.width}")
        lengths = np.empty(len(out), np.uint8)
        for at, which, table, long in (
            (np.arange(len(x.a)) + starts_b[group_a], x.a + x.a_ends * self.sizes[0], self.of_a, self.long_a),
            (np.arange(len(x.b)) + stops_a[group_b], x.b + sign_b * self.sizes[1], self.of_b, self.long_b),
        ):
            out[at], lengths[at] = table[which], long[which]
        signs = out.view(np.uint8)
        joined = signs[signs != 0].tobytes()
        stops = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[np.concatenate([[0], np.cumsum(x.n_a + x.n_b)])]
        return [joined[i:j] for i, j in zip(stops[:-1], stops[1:])]


@dataclass(frozen=True)
class Pair:
    """Two tokenizers as the bytes of their files; tasks load them."""

    byte_level: bytes
    pieces: bytes

    def coders(self) -> tuple[Coder, Coder]:
        """Made once per Python worker, which runs many tasks."""
        return _coders(self)


@lru_cache(maxsize=1)
def _coders(pair: Pair) -> tuple[Coder, Coder]:
    return ByteCoder(pair.byte_level), PieceCoder(pair.pieces)


def read_pair(spark, byte_level: str, pieces: str) -> Pair:
    return Pair(read_model(spark, byte_level), read_model(spark, pieces))


def groups(docs: DataFrame, tokenizers: Pair, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a_ids, b_ids, a_stops, b_stops): tokens of both sides and where groups stop.

    Group g holds the tokens from stop g-1 up to stop g on either side. Null and
    empty texts, and texts that tokens do not give back byte by byte, have empty
    arrays. A row per row, whatever repeats; other columns take no part.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers.coders()
        for batch in text_slices(batches, "text", SLICE_BYTES):
            x = align(a, b, batch.column("text").to_pylist())
            lists = [_lists(ids.astype(np.int32), n) for ids, n in ((x.a, x.n_a), (x.b, x.n_b))]
            for flags, n in ((x.a_ends, x.n_a), (x.b_ends, x.n_b)):
                owner = np.repeat(np.arange(len(n)), n)
                inner = np.arange(len(flags)) - np.repeat(np.cumsum(n) - n, n) + 1
                per = np.bincount(owner[flags], minlength=len(n)).astype(np.int64)
                lists.append(_lists(inner[flags].astype(np.int32), per))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *lists], ["key", "a_ids", "b_ids", "a_stops", "b_stops"]
            )

    schema = with_key(rows, "key", "a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>")
    return rows.mapInArrow(apply, schema).withColumnRenamed("key", key)


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    stops = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(flat))


_MEASURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_BLOCK = "block bigint, at array<int>, times array<int>, pairs array<bigint>, holders array<int>"


def measure(docs: DataFrame, tokenizers: Pair, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Align all documents, and count how many documents hold each id pair linked.

    First (key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of
    every row: ``count_sum`` adds up the counts of its links, ``n_best`` are links
    whose count is the highest of their A id, ties included. Then (a, b, n, best):
    all linked pairs. Null and empty texts, and texts that tokens do not give
    back, have zeros and an empty digest. Rows that repeat count each. An empty
    table gives none; other columns take no part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    sizes = [len(c.tokens) for c in tokenizers.coders()]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers.coders()
        written = GroupText(*sizes)
        blocks = _Blocks(TaskContext.get().partitionId() << 32)
        for batch in text_slices(batches, "text", SLICE_BYTES):
            x = align(a, b, batch.column("text").to_pylist())
            linked = x.a[x.link_a].astype(np.int64) * sizes[1] + x.b[x.link_b]
            owner = np.repeat(np.arange(batch.num_rows), x.n_a)[x.link_a]
            both, times = np.unique(owner * (sizes[0] * sizes[1]) + linked, return_counts=True)
            measures = [
                x.n_a, x.n_b, x.per_text(x.a_ends, np.arange(len(x.a))), np.bincount(owner, minlength=batch.num_rows),
                [hashlib.sha256(t).hexdigest() if t else "" for t in written(x)],
            ]
            held = np.bincount(both // (sizes[0] * sizes[1]), minlength=batch.num_rows)
            yield from blocks.add(batch, measures, both % (sizes[0] * sizes[1]), times, held)
        yield from blocks.close()

    folder = scratch(spark, "alignment")
    schema = with_key(rows, "key", f"{_MEASURES}, {_BLOCK}")
    rows.mapInArrow(apply, schema).write.parquet(folder)
    # Read once for each use, so that either reads its own columns only.
    blocks, documents = (spark.read.schema(schema).parquet(folder) for _ in range(2))
    held = blocks.filter("pairs is not null").select(
        "block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "held")
    ).select("block", "place", F.col("held.pairs").alias("pair"), F.col("held.holders").alias("n"))
    counted = held.groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has at most as many rows as there are B ids.
    of_a = F.expr(f"pair div {sizes[1]}")
    counted = counted.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(of_a)))
    back = held.select("block", "place", "pair").join(counted, "pair").select("block", "place", "n", "best")
    documents = documents.filter("pairs is null").drop("pairs", "holders")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        places = right.column("place").to_numpy()
        n, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        n[places] = right.column("n").to_numpy()
        best[places] = right.column("best").to_numpy()
        at, times = (left.column(c).combine_chunks() for c in ("at", "times"))
        owner = np.repeat(np.arange(left.num_rows), pa.compute.list_value_length(at).to_numpy())
        at, times = (x.flatten().to_numpy().astype(np.int64) for x in (at, times))
        sums = [_sums(owner, values[at] * times, left.num_rows) for values in (best, n)]
        names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        return pa.table([*[left.column(c) for c in names], *sums], [*names, "n_best", "count_sum"])

    schema = with_key(rows, "key", f"{_MEASURES}, n_best bigint, count_sum bigint")
    summed = documents.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(add_up, schema)
    pairs = counted.select(
        of_a.cast("int").alias("a"), F.expr(f"pair % {sizes[1]}").cast("int").alias("b"), "n", "best"
    )
    return summed.withColumnRenamed("key", key), pairs


def _sums(owner: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Exact sums of whole numbers by owner; owners are in order."""
    total = np.concatenate([[0], np.cumsum(values)])
    stops = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.array(total[stops[1:]] - total[stops[:-1]], pa.int64())


class _Blocks:
    """Collects documents of a task until their texts make a block."""

    def __init__(self, number: int):
        self.number, self.parts, self.bytes = number, [], 0

    def add(self, batch: pa.RecordBatch, measures: list, pairs, times, held) -> Iterator[pa.RecordBatch]:
        self.parts.append((batch.column("key"), measures, pairs, times, held))
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0)
        self.bytes += pa.compute.sum(sizes).as_py() or 0
        if self.bytes >= BLOCK_BYTES:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        pairs = np.concatenate([p[2] for p in self.parts])
        distinct, place, holders = np.unique(pairs, return_inverse=True, return_counts=True)
        first = 0
        for key, measures, own, times, held in self.parts:
            n = len(key)
            at = place[first : first + len(own)].astype(np.int32)
            first += len(own)
            none = [pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))]
            yield self._batch(
                key, measures, [_lists(at, held), _lists(times.astype(np.int32), held), *none]
            )
        key = pa.nulls(1, self.parts[0][0].type)
        none = [pa.nulls(1, pa.list_(pa.int32()))] * 2
        whole = [_lists(distinct, [len(distinct)]), _lists(holders.astype(np.int32), [len(distinct)])]
        yield self._batch(key, [[None]] * 5, [*none, *whole])
        self.number, self.parts, self.bytes = self.number + 1, [], 0

    def _batch(self, key: pa.Array, measures: list, lists: list) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 4, pa.string()]
        names = [f.split()[0] for f in f"{_MEASURES}, {_BLOCK}".split(", ")]
        columns = [pa.array(m, k) for m, k in zip(measures, kinds)]
        block = pa.array(np.full(len(key), self.number))
        return pa.RecordBatch.from_arrays([key, *columns, block, *lists], ["key", *names])

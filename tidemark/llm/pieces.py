"""SentencePiece encoding and decoding with a table of distinct marked words.

If no piece of the model has a marker after another character, no piece can
cross from one marked word (a run of markers and what follows it) into the
next, so each distinct marked word is segmented once and its ids are put back
at all its positions.

1. Tasks count their marked words, and the counts of all tasks are summed. A
   task leaves out what it has met once, which a table would not make cheaper.
2. Every distinct word that is frequent enough for a table of ``table_words``
   is segmented once, by the executors, and the table goes to all tasks.
3. Tasks look the words of a text up and put their ids in a row, position by
   position. Words that are too rare or too long for the table are segmented
   where they occur, into a bounded table of the task. So no text and no
   occurrence of a word is shuffled, only distinct words are.

Models without this property, or with a normaliser that changes characters,
encode whole texts instead.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, with_key
from tidemark.session import cut_lineage, small_batches

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
# Characters that usual normalisers change; they must come out as they went in.
_PROBE = "ﬁ Ａ  é ½　\t​ ­\r\n x "


TABLE_WORDS = 200_000
WORD_LENGTH = 64  # longest word of a table, in characters; with the above, it bounds the table


@dataclass(frozen=True)
class Table:
    """Words, how many ids each has, and all ids in a row."""

    words: list[str] = field(default_factory=list)
    sizes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))


def marked_words(text: str) -> list[str]:
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def segments(library, words: list[str]) -> list[list[int]]:
    """Ids of each marked word."""
    # The library puts one marker before a text by itself, except an empty one.
    found = library.encode([w[1:].replace(MARK, " ") for w in words], num_threads=1)
    alone = [library.piece_to_id(MARK)]
    return [alone if w == MARK else ids for w, ids in zip(words, found)]


class Model:
    """A sentencepiece model, the table of all documents and the task's own one."""

    def __init__(self, proto: bytes, table: Table, table_words: int, word_length: int = WORD_LENGTH):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.table, self.table_words, self.word_length = table, table_words, word_length
        self.by_words = by_words(self.library)
        self._clear()

    def _clear(self) -> None:
        self.place = dict(zip(self.table.words, range(len(self.table.words))))
        self.ids, self.sizes = self.table.ids, self.table.sizes
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _learn(self, words: set[str]) -> None:
        added = list(words)
        found = segments(self.library, added)
        sizes = np.fromiter(map(len, found), np.int64, len(added))
        first = len(self.ids) + np.cumsum(sizes) - sizes
        self.place.update(zip(added, range(len(self.place), len(self.place) + len(added))))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, first])
        self.sizes = np.concatenate([self.sizes, sizes])

    def encode(self, texts: list[str], end: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin (and the last one's end)."""
        tail = [self.library.eos_id()] if end else []
        if not self.by_words:
            each = [ids + tail for ids in self.library.encode(texts, num_threads=1)]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter((i for ids in each for i in ids), np.int32, int(sizes.sum()))
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        words = [marked_words(t) for t in texts]
        if len(self.place) > len(self.table.words) + self.table_words:
            self._clear()
        new = set().union(*words) - self.place.keys()
        long = {w for w in new if len(w) > self.word_length}
        self._learn(new - long)
        kept = len(self.place), len(self.ids)
        self._learn(long)
        n = sum(map(len, words))
        at = np.fromiter((self.place[w] for ws in words for w in ws), np.int64, n)
        sizes, starts = self.sizes[at], self.starts[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if n else 0
        flat = self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.concatenate([[0], ends])[np.cumsum(counts)]
        if end:
            flat = np.insert(flat, stops, tail[0]).astype(np.int32)
            stops = stops + np.arange(1, len(stops) + 1)
        if long:  # very long words are not worth keeping
            for w in long:
                del self.place[w]
            self.ids, self.starts, self.sizes = self.ids[: kept[1]], self.starts[: kept[0]], self.sizes[: kept[0]]
        return flat, np.concatenate([[0], stops])


def by_words(library) -> bool:
    """Can texts be cut into marked words without a change of result?"""
    pieces = (library.id_to_piece(i) for i in range(library.get_piece_size()))
    crossing = any(MARK in p.lstrip(MARK) for p in pieces)
    same = library.decode(library.encode(_PROBE)) == _PROBE
    marked = library.encode("a", out_type=str)[0].startswith(MARK)
    return not crossing and same and marked


def read_model(spark, path: str) -> bytes:
    """The bytes of a model file; a model is small, so tasks get them with the job."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as f:
        return f.read()


def word_table(
    texts: DataFrame, proto: bytes, table_words: int = TABLE_WORDS, word_length: int = WORD_LENGTH
) -> Table:
    """The most frequent marked words of column ``text``, each segmented once.

    All texts are counted. Words are taken by powers of two of their count, from
    the top, as long as all of a power fit. Words that no task met twice are left
    out: they are segmented where they occur.
    """
    import sentencepiece

    if not by_words(sentencepiece.SentencePieceProcessor(model_proto=proto)):
        return Table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in text_slices(batches, "text"):
            here = Counter(chain.from_iterable(map(marked_words, batch.column("text").to_pylist())))
            seen.update({w: n for w, n in here.items() if len(w) <= word_length})
            if len(seen) > TABLE_WORDS:
                yield _counts(seen)
                seen = Counter()
        yield _counts(seen)

    words = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = cut_lineage(words.withColumn("power", F.length(F.bin("n"))))
    powers = words.groupBy("power").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("power")).collect()  # 64 at most
    least, held = 65, 0
    for r in powers:
        held += r["words"]
        if held > table_words:
            break
        least = r["power"]

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            found = segments(library, batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(found, pa.list_(pa.int32()))], ["word", "ids"]
            )

    table = words.filter(F.col("power") >= least).select("word").mapInArrow(segment, "word string, ids array<int>").toArrow()
    ids = table.column("ids").combine_chunks()
    return Table(
        table.column("word").to_pylist(),
        pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64),
        ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32),
    )


def _counts(seen: Counter) -> pa.RecordBatch:
    again = {w: n for w, n in seen.items() if n > 1}
    return pa.RecordBatch.from_arrays(
        [pa.array(list(again), pa.string()), pa.array(list(again.values()), pa.int64())], ["word", "n"]
    )


def encode_decode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
    end: bool = True, decode: bool = True, table_words: int = TABLE_WORDS,
) -> DataFrame:
    """(key, ids array<int>, decoded): texts as the library encodes them, and back.

    Null texts count as empty; an empty text has the end id only. Texts are
    encoded whole, a slice of rows at a time. ``table_words`` bounds the table of
    all documents and that of a task. Rows may repeat; other columns take no
    part. An empty table gives an empty result.
    """
    proto = read_model(small_batches(docs.sparkSession), model)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    table = word_table(rows.select("text"), proto, table_words)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Model(proto, table, table_words)
        for batch in text_slices(batches, "text"):
            flat, stops = tool.encode(batch.column("text").to_pylist(), end)
            ids = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(flat))
            back = _decode(tool.library, flat, stops) if decode else [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), ids, pa.array(back, pa.string())], ["key", "ids", "decoded"]
            )

    found = rows.mapInArrow(apply, with_key(rows, "key", "ids array<int>, decoded string"))
    return found.select(F.col("key").alias(key), "ids", *(["decoded"] if decode else []))


def _decode(library, flat: np.ndarray, stops: np.ndarray) -> list[str]:
    ids = flat.tolist()
    return library.decode([ids[a:b] for a, b in zip(stops[:-1], stops[1:])], num_threads=1)


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, decoded): text of arrays of ids. Null arrays give null."""
    proto = read_model(encoded.sparkSession, model)
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            back = [None if x is None else library.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(back, pa.string())], ["key", "decoded"])

    return rows.mapInArrow(apply, with_key(rows, "key", "decoded string")).withColumnRenamed("key", key)


def digests(encoded: DataFrame) -> DataFrame:
    """Replace ids and decoded text by their number and SHA-256 digests."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    kept = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(
        *kept,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

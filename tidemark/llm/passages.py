"""Substring dedup: words in passages that an earlier document has are removed.

A *window* is ``width`` consecutive words. A word goes if a window over it also
starts in a document with a smaller id.

1. Documents are dealt into buckets of a few megabytes, by one shuffle that all
   steps share. Each window has an anchor, its least hashed run of ``run``
   words: equal windows have equal anchors, and there are about a fifth as many
   anchors as windows. Per bucket, distinct anchors go out; those found in one
   document only rule their windows out.
2. The other windows are confirmed: each bucket sends their distinct hashes with
   its first and last document; a window is repeated where a bucket has a
   document after the first one of all. A passage that very many documents
   share is one row per bucket in either step.
3. Each bucket gets its repeated windows with the first document of each.
   Consecutive ones form *passages*, each window in the passage where the bucket
   has it first. Passages are cut into pieces, so short that every window holds a
   whole one; the words of the pieces are compiled into Aho-Corasick automata, a
   bounded number per automaton, and all documents of the bucket are streamed
   through them. From every match the passage is followed to both sides word by
   word; what it and the document have in common there is covered. Pieces that
   occur in many passages are replaced by the whole windows around them, so a
   match never stands for more than ``SHARED`` places.

Windows of different buckets are the same if their 64-bit hashes are; within a
bucket words are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice, product, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BYTES = 4_000_000
PHRASES = 50_000  # of one automaton
SHARED = 16  # passages that may have a piece in common
MATCHES = 20_000  # followed at a time
_NO_ID = np.iinfo(np.int64).max

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words."""
    found = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        found = found * _FACTOR + words[i : len(found) + i]
    found = (found ^ (found >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(29))


def _anchors(words: np.ndarray, width: int, run: int) -> np.ndarray:
    """The anchor of every window."""
    runs = _runs(words, run)
    return np.lib.stride_tricks.sliding_window_view(runs, width - run + 1).min(axis=1)


class _Bucket:
    """The documents of a bucket as arrays of word hashes."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").cast(pa.int64())
        self.ids = pa.compute.fill_null(ids, int(_NO_ID)).combine_chunks().to_numpy(zero_copy_only=False)
        texts = table.column("text").to_pylist()
        self.words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        self.distinct: dict[bytes, int] = {}
        self.hashes = list(map(self._hash, self.words))

    def _hash(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        new = set(words).difference(self.distinct)
        self.distinct.update(zip(new, map(xxhash.xxh64_intdigest, new)))
        return np.fromiter(map(self.distinct.__getitem__, words), np.uint64, len(words))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """A number per word, all documents in a row, and where each document starts."""
        starts = np.concatenate([[0], np.cumsum([len(w) for w in self.words], dtype=np.int64)])
        if len(set(self.distinct.values())) == len(self.distinct):
            numbers = self.hashes
        else:  # two words with one hash
            number = {w: i for i, w in enumerate(self.distinct)}
            numbers = [np.fromiter(map(number.__getitem__, w), np.uint64, len(w)) for w in self.words]
        return np.concatenate([np.empty(0, np.uint64), *numbers]), starts


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Place in ``ordered`` of each value, or -1."""
    if not len(ordered):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


def _send_anchors(width: int, run: int, bucket_of: str) -> Callable[[pa.Table], pa.Table]:
    def apply(table: pa.Table) -> pa.Table:
        held = _Bucket(table)
        found = [np.unique(_anchors(h, width, run)) for h in held.hashes if len(h) >= width]
        anchors, count = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
        bucket = table.column(bucket_of)[0].as_py()
        # A negative slot says that two documents of the bucket have the anchor.
        slots = np.where(count > 1, -bucket - 1, bucket).astype(np.int32)
        return pa.table({"anchor": anchors.view(np.int64), "slot": slots})

    return apply


def _send_windows(width: int, run: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def apply(table: pa.Table, repeated: pa.Table) -> pa.Table:
        held = _Bucket(table)
        flagged = np.sort(_numbers(repeated, "anchor"))
        windows, ids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for doc, h in zip(held.ids, held.hashes):
            if len(h) < width or not len(flagged):
                continue
            own = np.unique(_runs(h, width)[_in(_anchors(h, width, run), flagged) >= 0])
            windows.append(own)
            ids.append(np.full(len(own), doc))
        window, doc = np.concatenate(windows), np.concatenate(ids)
        order = np.lexsort((doc, window))
        window, doc = window[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])[: len(window)])
        last = np.concatenate([first[1:], [len(window)]])[: len(first)] - 1
        bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
        return pa.table({
            "bucket": np.full(len(first), bucket, np.int32), "window": window[first].view(np.int64),
            "first": doc[first], "last": doc[last],
        })

    return apply


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)


_BASE = 256


def _codes(n: int) -> Iterator[str]:
    """Words' codes. Each place has letters of its own, so a code never matches across two words."""
    length = 1
    while _BASE**length < n:
        length += 1
    letters = [[chr(256 + _BASE * place + i) for i in range(_BASE)] for place in range(length)]
    return map("".join, islice(product(*letters), n))


def _remove(width: int, phrases: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def apply(table: pa.Table, repeated: pa.Table) -> pa.Table:
        held = _Bucket(table)
        window = _numbers(repeated, "window")
        order = np.argsort(window)
        first = _numbers(repeated, "first").view(np.int64)[order]
        covered = _covered(held, window[order], first, width, phrases)
        kept = [
            b" ".join([w for w, gone in zip(words, mask.tolist()) if not gone]) if mask.any() else b" ".join(words)
            for words, mask in zip(held.words, covered)
        ]
        return pa.table({
            "doc_id": table.column("doc_id"),
            "n_words": pa.array([len(w) for w in held.words], pa.int64()),
            "n_removed": pa.array([int(m.sum()) for m in covered], pa.int64()),
            "kept": pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()),
        })

    return apply


class _Passages:
    """Repeated windows of a bucket, each at its first place there.

    ``first`` has the first document of the window that starts at a place, for
    these places only. ``patterns`` are (place, number of words, places of the
    same words in passages).
    """

    def __init__(self, held: _Bucket, window: np.ndarray, first: np.ndarray, width: int):
        self.words, self.starts = held.joined()
        self.width, self.piece = width, (width + 1) // 2
        confirmed = np.full(len(self.words), -1)
        for start, h in zip(self.starts.tolist(), held.hashes):
            if len(h) >= width:
                confirmed[start : start + len(h) - width + 1] = _in(_runs(h, width), window)
        repeated = np.flatnonzero(confirmed >= 0)
        places = np.sort(repeated[np.unique(confirmed[repeated], return_index=True)[1]])
        self.first = np.full(len(self.words), _NO_ID)
        self.first[places] = first[confirmed[places]]
        self.patterns = list(self._patterns(places))

    def _patterns(self, places: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        if not len(places):
            return
        opens = np.concatenate([[True], np.diff(places) != 1])
        passage = places[opens][np.cumsum(opens) - 1]
        pieces = np.unique(places + (passage - places) % self.piece)
        same: dict[bytes, list[int]] = {}
        for place, words in zip(pieces.tolist(), np.lib.stride_tricks.sliding_window_view(self.words, self.piece)[pieces]):
            same.setdefault(words.tobytes(), []).append(place)
        around: set[int] = set()
        for found in same.values():
            if len(found) <= SHARED:
                yield found[0], self.piece, found
            else:
                for place in found:
                    around.update(range(max(0, place - self.piece + 1), place + 1))
        for place in np.intersect1d(places, np.fromiter(around, np.int64)).tolist():
            yield place, self.width, [place]

    def follow(self, at: np.ndarray, place: np.ndarray, doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Starts of the windows over matches ``at`` in document number ``doc`` that the
        passages at ``place`` have as well and an earlier document too."""
        n, piece, width = len(self.words), self.piece, self.width

        def common(steps) -> np.ndarray:
            alive, length = np.ones(len(at), bool), np.zeros(len(at), np.int64)
            for step in steps:
                a, b = at + step, place + step
                alive &= (np.minimum(a, b) >= 0) & (np.maximum(a, b) < n)
                alive &= self.words[np.clip(a, 0, n - 1)] == self.words[np.clip(b, 0, n - 1)]
                length += alive
            return length

        before = common(range(-1, -piece, -1))
        after = common(range(piece, width))
        found = []
        for back in range(piece):
            start, there = at - back, np.maximum(place - back, 0)
            hit = (before >= back) & (after >= width - piece - back)
            hit &= (start >= self.starts[doc]) & (start + width <= self.starts[doc + 1])
            hit &= self.first[there] < ids[doc]
            found.append(start[hit])
        return np.concatenate(found)


def _covered(held: _Bucket, window: np.ndarray, first: np.ndarray, width: int, phrases: int) -> list[np.ndarray]:
    """Which words of each document are in a window that an earlier document has."""
    passages = _Passages(held, window, first, width)
    n = len(passages.words)
    step = np.zeros(n + 1, np.int64)
    for at, place, doc in _matches(held, passages, phrases):
        starts = np.unique(passages.follow(at, place, doc, held.ids))
        step[starts] += 1
        step[starts + width] -= 1
    return np.split(np.cumsum(step)[:n] > 0, passages.starts[1:-1])


def _matches(held: _Bucket, passages: _Passages, phrases: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Where pieces of passages occur: place in a document, place in a passage, number of the document."""
    for shard in range(0, len(passages.patterns), phrases):
        patterns = passages.patterns[shard : shard + phrases]
        automaton, code = _automaton(held, passages, patterns)
        length = len(next(iter(code.values())))
        size = np.array([words for _, words, _ in patterns])
        count = np.array([len(places) for _, _, places in patterns])
        places = np.concatenate([np.array(places) for _, _, places in patterns])
        begin = np.cumsum(count) - count
        for doc, matches in _batches(held, automaton, code):
            end, pattern = matches.T
            at = passages.starts[doc] + (end + 1) // length - size[pattern]
            copies = count[pattern]
            nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            place = places[np.repeat(begin[pattern], copies) + nth]
            yield np.repeat(at, copies), place, np.repeat(doc, copies)


def _batches(held: _Bucket, automaton, code: dict[bytes, str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(end, pattern) of all matches, about ``MATCHES`` at a time, and the numbers of their documents."""
    other = repeat("a" * len(next(iter(code.values()))))  # in no pattern
    found, docs, counts = [], [], []
    for doc, words in enumerate(held.words):
        matches = automaton.iter("".join(map(code.get, words, other)))
        while some := list(islice(matches, MATCHES)):
            found += some
            docs.append(doc)
            counts.append(len(some))
            if len(found) >= MATCHES:
                yield np.repeat(docs, counts), np.array(found)
                found, docs, counts = [], [], []
    if found:
        yield np.repeat(docs, counts), np.array(found)


def _automaton(held: _Bucket, passages: _Passages, patterns: list) -> tuple:
    """An automaton over the words of patterns, and the codes of these words."""
    import ahocorasick

    texts, numbers = [], {}
    places = np.array([place for place, _, _ in patterns])
    docs = np.searchsorted(passages.starts, places, side="right") - 1
    for (place, size, _), doc, start in zip(patterns, docs.tolist(), passages.starts[docs].tolist()):
        words = held.words[doc][place - start : place - start + size]
        texts.append(words)
        for w in words:
            numbers.setdefault(w, len(numbers))
    code = dict(zip(numbers, _codes(len(numbers))))
    automaton = ahocorasick.Automaton()
    for i, words in enumerate(texts):
        automaton.add_word("".join([code[w] for w in words]), i)
    automaton.make_automaton()
    return automaton, code


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 13, run: int = 5,
    bucket_bytes: int = BUCKET_BYTES, phrases: int = PHRASES,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` is the text left.

    Words are cut at ASCII white space and compared unchanged; kept ones are
    joined by one space. Windows are judged on the input. Ids are integers;
    rows of the same id do not shorten each other, and a null id counts as
    larger than all others; rows repeated in full are handled in one task. Null and empty texts have no words; texts shorter
    than a window are returned whole. An empty table gives an empty result.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # By id and text, so that rows without an id, or with the same one, are spread.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))
    dealt = rows.groupBy("bucket")

    anchors = dealt.applyInArrow(_send_anchors(width, run, "bucket"), "anchor bigint, slot int")
    same = Window.partitionBy("anchor")
    repeated = anchors.withColumn("n", F.count(F.lit(1)).over(same)).withColumn("many", F.min("slot").over(same) < 0)
    repeated = repeated.filter("n > 1 or many").select(
        F.when(F.col("slot") < 0, -F.col("slot") - 1).otherwise(F.col("slot")).alias("bucket"), "anchor"
    )
    windows = dealt.cogroup(repeated.groupBy("bucket")).applyInArrow(
        _send_windows(width, run), "bucket int, window bigint, first bigint, last bigint"
    )
    phrase = windows.withColumn("start", F.min("first").over(Window.partitionBy("window"))).filter("last > start")
    phrase = phrase.select("bucket", "window", F.col("start").alias("first"))
    return dealt.cogroup(phrase.groupBy("bucket")).applyInArrow(
        _remove(width, phrases), "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    )

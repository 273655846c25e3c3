"""Language identification with spans.

Training counts, per language, hashed character n-grams of words and the
scripts of its letters, on a bounded sample of labelled texts. To label a text,
the scripts of all letters of a word narrow the languages that come into question, each of
them scores the word, and Viterbi over the words with a penalty for switching
gives spans of one language. The language with the most letters in its spans is
the text's, and its share of the letters is the score.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, with_key
from tidemark.session import small_batches

UNKNOWN = "und"

# First code points of ranges and their scripts, fixed values of Unicode.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x1900, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"),
    (0x20000, "han"),
)
_FIRSTS = [first for first, _ in SCRIPT_RANGES]
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))
_SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])

_RUN = re.compile(r"[^\W\d_]+")


def script(letter: str) -> int:
    return SCRIPTS.index(SCRIPT_RANGES[bisect_right(_FIRSTS, ord(letter)) - 1][1])


def scripts_of(words: list[str]) -> np.ndarray:
    """Which scripts each word has, over all its letters: words x scripts."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    found = np.zeros((len(words), len(SCRIPTS)), bool)
    found[owner, _SCRIPT_OF[np.searchsorted(_FIRSTS, codes, side="right") - 1]] = True
    return found


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; combining marks end a run."""
    return _RUN.findall(text.lower())


def letters(word: str) -> int:
    return sum(map(str.isalpha, word))


def grams(words: list[str], sizes: tuple[int, ...], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams of words with their ends marked, then the words themselves.

    A pair per size: the buckets of all words in a row, and how many each word has.
    All words are hashed together, as one array of code points.
    """
    codes = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _mixed(codes.astype(np.uint64))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    to_end = np.repeat(ends, lengths) - np.arange(len(codes))
    found = []
    for n in sizes:
        if len(codes) < n:
            found.append((np.empty(0, np.int64), np.zeros(len(words), np.int64)))
            continue
        rolled = np.zeros(len(codes) - n + 1, np.uint64)
        for i in range(n):
            rolled = rolled * _FACTOR + codes[i : len(codes) - n + 1 + i]
        inside = rolled[to_end[: len(rolled)] >= n]
        found.append(((_mixed(inside + np.uint64(n)) % np.uint64(buckets)).astype(np.int64), np.maximum(lengths - n + 1, 0)))
    whole = np.add.reduceat(codes * (2 * to_end + 1).astype(np.uint64), ends - lengths)
    found.append(((_mixed(whole) % np.uint64(buckets)).astype(np.int64), np.ones(len(words), np.int64)))
    return found


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class Model:
    """Sorted languages, log probabilities per bucket, and which scripts each one uses."""

    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages
    scripts: np.ndarray  # scripts x languages
    sizes: tuple[int, ...]
    switch: float

    def score(self, words: list[str]) -> np.ndarray:
        """Scores of words per language; minus infinity where the script rules one out."""
        total = np.zeros((len(words), len(self.languages)))
        for bucket, counts in grams(words, self.sizes, len(self.weights)):
            sums = np.concatenate([np.zeros((1, total.shape[1])), np.cumsum(self.weights[bucket], axis=0, dtype=np.float64)])
            stops = np.cumsum(counts)
            total += sums[stops] - sums[stops - counts]
        total /= len(self.sizes)
        # Scripts that no language uses tell nothing. Of the others, a language should
        # use all that a word has; if none does, those that use one of them stay open.
        found = scripts_of(words) & self.scripts.any(axis=1)
        used = found.astype(np.int64) @ self.scripts.astype(np.int64)
        every = used == np.maximum(found.sum(axis=1, keepdims=True), 1)
        open_to = np.where(every.any(axis=1, keepdims=True), every, used > 0)
        narrowed = open_to.any(axis=1, keepdims=True) & ~open_to
        return np.where(narrowed, -np.inf, total).astype(np.float32)


def train(
    docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", most_texts: int = 8_000,
    sizes: tuple[int, ...] = (2, 3, 4), bits: int = 16, switch: float = 12.0, most_languages: int = 500,
    smoothing: float = 0.5,
) -> Model:
    """Learn from rows with a text and a label.

    ``most_texts`` bounds the sample: each language gives about an equal part of
    it, chosen by a hash of the key, and all its texts if it has fewer. The rest
    of the model has ``2**bits`` rows and a column per language. More than
    ``most_languages`` labels are an error. Without labelled rows the model has
    no language.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("lang"))
    given = given.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = given.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    told = {r["lang"]: r["n"] for r in counts.limit(most_languages + 1).collect()}
    if len(told) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = tuple(sorted(told))
    if not languages:
        return Model((), np.zeros((1, 0)), np.zeros((len(SCRIPTS), 0), bool), sizes, switch)
    share = {name: most_texts / len(languages) / n for name, n in told.items()}
    place = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    chosen = F.lit(False)
    for name, part in share.items():
        chosen = chosen | ((F.col("lang") == name) & (place < part))
    buckets = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        scripts: dict[str, Counter] = {}
        for batch in batches:
            for body, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                held = seen.setdefault(name, np.zeros(buckets, np.int64))
                used = scripts.setdefault(name, Counter())
                told = Counter(words_of(body))
                if not told:
                    continue
                # A word's repeats within a text count less and less.
                times = np.array([1 + n.bit_length() for n in told.values()])
                for bucket, each in grams(list(told), sizes, buckets):
                    held += np.bincount(bucket, np.repeat(times, each), buckets).astype(np.int64)
                used.update(script(c) for w in told for c in w if c.isalpha())
        for name, held in seen.items():
            at = np.flatnonzero(held)
            more = sorted(scripts[name])
            ids = np.concatenate([at, np.array(more, np.int64) - len(SCRIPTS)])
            sums = np.concatenate([held[at], np.array([scripts[name][s] for s in more], np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(ids)), pa.array(ids.astype(np.int64)), pa.array(sums.astype(np.int64))], ["lang", "bucket", "n"]
            )

    parts = given.filter(chosen).select("text", "lang").mapInArrow(count, "lang string, bucket bigint, n bigint")
    total = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most buckets x languages
    column = total["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    bucket, n = total["bucket"].to_numpy(np.int64), total["n"].to_numpy(np.float64)
    counted = np.zeros((buckets, len(languages)))
    is_gram = bucket >= 0
    counted[bucket[is_gram], column[is_gram]] = n[is_gram]
    by_script = np.zeros((len(SCRIPTS), len(languages)))
    by_script[bucket[~is_gram] + len(SCRIPTS), column[~is_gram]] = n[~is_gram]
    odds = np.log((counted + smoothing) / (counted.sum(axis=0) + smoothing * buckets))
    uses = by_script > 0.02 * np.maximum(by_script.sum(axis=0), 1)
    return Model(languages, odds.astype(np.float32), uses, sizes, switch)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word; ``scores`` holds the words of text after text.

    All texts advance together, one word per step, the longest ones first, so a
    step is one operation on arrays.
    """
    n, k = scores.shape
    if n == 0:
        return np.empty(0, np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    alive = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")
    back = np.empty((n, k), np.int16)
    best = np.zeros((len(lengths), k), np.float64)
    every = np.arange(k)
    for t, m in enumerate(alive):
        at = starts[:m] + t
        if t == 0:
            best[:m] = scores[at]
            back[at] = every
            continue
        top = best[:m].argmax(axis=1)
        moved = best[np.arange(m), top] - switch
        stay = best[:m] >= moved[:, None]
        back[at] = np.where(stay, every, top[:, None])
        best[:m] = np.where(stay, best[:m], moved[:, None]) + scores[at]
    path = np.empty(n, np.int64)
    state = best.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        at = starts[: alive[t]] + t
        path[at] = state[: alive[t]]
        state[: alive[t]] = back[at, state[: alive[t]]]
    return path


class Labeller:
    """Applies a model; remembers the scores of up to ``most_words`` words."""

    def __init__(self, model: Model, most_words: int = 200_000):
        self.model, self.most_words = model, most_words
        self.place: dict[str, int] = {}
        self.scores = np.empty((0, len(model.languages)), np.float32)
        self.letters = np.empty(0, np.int64)

    def _places(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.place) > self.most_words:
            self.place, self.scores, self.letters = {}, self.scores[:0], self.letters[:0]
        new = list(set().union(*texts) - self.place.keys())
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        if new:
            self.scores = np.concatenate([self.scores, self.model.score(new)])
            self.letters = np.concatenate([self.letters, np.array([letters(w) for w in new])])
        return np.fromiter((self.place[w] for t in texts for w in t), np.int64, sum(map(len, texts)))

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language and score of each text; language and letters of each word, in one row."""
        words = [words_of(t) if t else [] for t in texts]
        k = len(self.model.languages)
        lengths = np.array([len(w) for w in words], np.int64)
        if not k:
            none = np.empty(0, np.int64)
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), none, none
        at = self._places(words)
        scores, weight = self.scores[at], self.letters[at]
        path = viterbi(np.maximum(scores, np.float32(-1e6)), lengths, self.model.switch)
        owner = np.repeat(np.arange(len(texts)), lengths)
        sums = np.bincount(owner * k + path, weights=weight, minlength=len(texts) * k).reshape(-1, k)
        total = sums.sum(axis=1)
        top = sums.argmax(axis=1)
        share = np.where(total > 0, sums[np.arange(len(texts)), top] / np.maximum(total, 1), 0.0)
        names = [self.model.languages[i] if n else UNKNOWN for i, n in zip(top, total)]
        return names, share, path, weight


def identify(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep_text: bool = False
) -> DataFrame:
    """(key, lang_pred, score) of every row, from its whole text alone.

    ``und`` with score 0 if the text is null or has no letter (or the model knows
    no language). Equal languages of a text go to the first by name. Rows may
    repeat; other columns take no part. With ``keep_text`` the text, as ``text``,
    comes last, so that the key need not hold it.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    more = ["text"] if keep_text else []

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Labeller(model)
        for batch in text_slices(batches, "text", 2_000_000):
            names, share, _, _ = tool.label(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names, pa.string()), pa.array(share), *[batch.column(c) for c in more]],
                ["key", "lang_pred", "score", *more],
            )

    columns = "lang_pred string, score double" + "".join(f", {c} string" for c in more)
    found = rows.mapInArrow(apply, with_key(rows, "key", columns))
    return found.withColumnRenamed("key", key)


def spans(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, stop, lang): runs of words of one language, by number of word.

    Null and empty texts, those without letters, and a model without languages
    give no spans. Rows that repeat give theirs each; ids may be null. Equal paths
    go to the first language by name. An empty table gives none; other columns
    take no part.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Labeller(model)
        for batch in text_slices(batches, "text", 2_000_000):
            bodies = batch.column("text").to_pylist()
            _, _, path, _ = tool.label(bodies)
            out, first = [], 0
            for owner, body in enumerate(bodies):
                n = len(words_of(body)) if body and len(path) else 0
                own = path[first : first + n]
                cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), n] if n else []
                out += [(owner, a, b, model.languages[own[a]]) for a, b in zip(cuts[:-1], cuts[1:])]
                first += n
            owners, starts, stops, names = zip(*out) if out else ((), (), (), ())
            keys = batch.column("key").take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(names, pa.string())],
                ["key", "start", "stop", "lang"],
            )

    found = rows.mapInArrow(apply, with_key(rows, "key", "start int, stop int, lang string"))
    return found.withColumnRenamed("key", key)


def held_out(doc_id: Column) -> Column:
    """Documents that training leaves out: a third, by CRC-32 of the id as text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1

"""Quality scores from weak labels.

Heuristic labellers vote good, bad or abstain on every text. Expectation-
maximisation over the counts of all vote patterns estimates how often each
labeller votes which way on good and on bad texts, and so the chance that a
text with a pattern is good. With these chances as labels, a linear model over
hashed words and word shapes is trained on a bounded sample; it scores every
text, also where all labellers abstain.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, with_key

_SYMBOLS = re.compile(r"[#%&*$^~|<>{}\[\]\\=_@+]")
_CAPS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTERS = re.compile(r"[^\W\d_]")


# Each kind of junk has a labeller of its own, which abstains on everything else;
# what is none of them is told by labellers of plain prose.
LABELLERS = ("symbols", "capitals", "stutter", "loud", "table", "letters", "plain", "varied", "prose")


def votes(text: str | None) -> str:
    """A character per labeller: ``+`` good, ``-`` bad, ``0`` abstains."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return "-" * len(LABELLERS)
    chars = len(text)
    letters = len(_LETTERS.findall(text))
    counts = Counter(words)
    symbols = len(_SYMBOLS.findall(text)) / chars
    capitals = len(_CAPS.findall(text)) / max(letters, 1)
    stutter = sum(a == b for a, b in zip(words, words[1:])) / n
    loud = sum(w.endswith("!!") for w in words) / n
    table = counts["|"] / n
    top = counts.most_common(1)[0][1] / n
    bad = (
        symbols >= 0.03, capitals >= 0.3, stutter >= 0.2 and n >= 6, loud >= 0.1, table >= 0.08,
        letters / chars < 0.6,
    )
    good = (
        symbols <= 0.004 and capitals <= 0.15 and loud == 0 and table == 0 and stutter <= 0.02,
        n >= 20 and stutter <= 0.02 and top <= 0.15,
        letters / chars >= 0.75 and 2 <= letters / n <= 12 and capitals <= 0.15 and stutter <= 0.05,
    )
    return "".join(["-" if b else "0" for b in bad] + ["+" if g else "0" for g in good])


@dataclass(frozen=True)
class WeakLabels:
    """``good``: chance of a good text; ``rates[y, j, v]``: vote v of labeller j on class y."""

    good: float
    rates: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Chance that a text with the votes is good. Who abstains says nothing."""
        log = np.log(np.array([1 - self.good, self.good]))[:, None] + np.zeros((2, len(patterns)))
        told = np.array([["-0+".index(v) for v in p] for p in patterns]).reshape(len(patterns), -1)
        for j in range(self.rates.shape[1]):
            log += np.where(told[:, j] == 1, 0.0, np.log(self.rates[:, j, :])[:, told[:, j]])
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Per labeller, how often it is right where it votes."""
        right = self.good * self.rates[1, :, 2] + (1 - self.good) * self.rates[0, :, 0]
        wrong = self.good * self.rates[1, :, 0] + (1 - self.good) * self.rates[0, :, 2]
        return right / (right + wrong)


def estimate(patterns: list[str], counts: np.ndarray, rounds: int = 100) -> WeakLabels:
    """Expectation-maximisation, from the majority vote; every rate is smoothed by one."""
    told = np.array([["-0+".index(v) for v in p] for p in patterns]).reshape(len(patterns), -1)
    balance = (told == 2).sum(axis=1) - 2.0 * (told == 0).sum(axis=1)
    chance = 1 / (1 + np.exp(-balance))
    model = None
    for _ in range(rounds):
        weight = np.stack([(1 - chance) * counts, chance * counts])
        rates = np.stack([(told == v).T @ weight.T for v in range(3)], axis=-1).transpose(1, 0, 2) + 1.0
        model = WeakLabels(
            float((weight[1].sum() + 1) / (weight.sum() + 2)), rates / rates.sum(axis=2, keepdims=True)
        )
        fresh = model.posterior(patterns)
        if np.abs(fresh - chance).max() < 1e-9:
            break
        chance = fresh
    return model


def features(bits: int):
    """Function from a word to the hashed buckets of its body and of its shape."""

    def of(word: str) -> tuple[int, int]:
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"\d", "9", _LETTERS.sub("a", _CAPS.sub("A", word))))
        return tuple(zlib.crc32(t.encode("utf-8", "replace")) % (1 << bits) for t in (word.lower(), " " + shape))

    return of


def shares(text: str | None, buckets, bits: int) -> np.ndarray:
    """Share of each bucket in a text, with one for repeats of a word in a row."""
    found = np.zeros((1 << bits) + 1)
    words = (text or "").split()
    for word, n in Counter(words).items():
        for i in buckets(word):
            found[i] += n / len(words)
    if words:
        found[-1] = sum(map(eq, words, words[1:])) / len(words)
    return found


@dataclass(frozen=True)
class Scorer:
    labels: WeakLabels
    weights: np.ndarray
    offset: float
    bits: int

    def weigh(self):
        """Weight of a word, remembered per word: its body's and its shape's."""
        buckets, weights = features(self.bits), self.weights

        class Known(dict):
            def __missing__(self, word: str) -> float:
                found = float(sum(weights[i] for i in buckets(word)))
                if len(self) < 300_000 and len(word) < 100:
                    self[word] = found
                return found

        return Known()

    def score(self, text: str | None, known) -> float:
        words = (text or "").split()
        if not words:
            return 0.0
        total = sum(map(known.__getitem__, words)) + self.weights[-1] * sum(map(eq, words, words[1:]))
        return float(1 / (1 + np.exp(-(total / len(words) + self.offset))))


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = 4_000, bits: int = 12,
    epochs: int = 60, seed: int = 5,
) -> Scorer | None:
    """Estimate the labellers on all texts and train the scorer on about ``sample`` of them.

    The sample is chosen by a hash of the id. None if there are no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = rows.count()
    if not total:
        return None

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in text_slices(batches, "text"):
            seen.update(map(votes, batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["votes", "n"]
        )

    counted = rows.mapInArrow(vote, "votes string, n bigint").groupBy("votes").agg(F.sum("n").alias("n"))
    told = sorted((r["votes"], r["n"]) for r in counted.collect())  # at most 3 ** labellers rows
    labels = estimate([p for p, _ in told], np.array([n for _, n in told], float))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000))
    chosen = rows.filter(place < F.lit(int(1_000_000 * sample / total) + 1))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = features(bits)
        for batch in text_slices(batches, "text"):
            out = [(votes(t), x) for t in batch.column("text").to_pylist() for x in [shares(t, buckets, bits)]]
            at = [np.flatnonzero(x) for _, x in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _ in out], pa.string()), pa.array(at, pa.list_(pa.int64())),
                 pa.array([x[i] for (_, x), i in zip(out, at)], pa.list_(pa.float64()))], ["votes", "at", "share"]
            )

    table = chosen.mapInArrow(describe, "votes string, at array<bigint>, share array<double>").limit(2 * sample).collect()
    table.sort(key=lambda r: (r["votes"], r["at"], r["share"]))
    x = np.zeros((len(table), (1 << bits) + 1))
    for i, r in enumerate(table):
        x[i, r["at"]] = r["share"]
    y = labels.posterior([r["votes"] for r in table]) if len(table) else np.zeros(0)
    return Scorer(labels, *_logistic(x, y, epochs, seed), bits)


def _logistic(x: np.ndarray, y: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes of equal weight (Adagrad)."""
    w, b = np.zeros(x.shape[1]), 0.0
    g, gb = np.full(x.shape[1], 1e-6), 1e-6
    if not len(x):
        return w, b
    mass = np.clip(np.array([(1 - y).sum(), y.sum()]), 1.0, None)
    weight = len(y) / 2 * ((1 - y) / mass[0] + y / mass[1])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            miss = weight[at] * (1 / (1 + np.exp(-(x[at] @ w + b))) - y[at]) / len(at)
            slope, slope_b = x[at].T @ miss + 1e-5 * w, miss.sum()
            g, gb = g + slope**2, gb + slope_b**2
            w, b = w - 0.5 * slope / np.sqrt(g), b - 0.5 * slope_b / np.sqrt(gb)
    return w, b


def score(docs: DataFrame, scorer: Scorer | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, keep) of every row, from its whole text.

    A text that is null or has no words scores 0. Rows may repeat; other columns
    take no part; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = with_key(rows, "doc_id", "score double, keep boolean")
    if scorer is None:
        return docs.sparkSession.createDataFrame([], schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = scorer.weigh()
        for batch in text_slices(batches, "text"):
            scores = np.array([scorer.score(t, known) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array(scores >= 0.5)], schema.names
            )

    return rows.mapInArrow(apply, schema)

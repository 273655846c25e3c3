"""License scans: an exact set-similarity join of text blocks with notice templates.

A template is the set of its words; a block of text contains it if at least
``containment`` of these words occur in the block. Blocks are windows of 2 L
words, every L words, for L = 8, 16, 32, ..., and a template of up to L words
looks at blocks of its own L, so that a passage as long as the template lies
wholly in one block, whatever the lines and whatever the text's length.

Words of templates are numbered by their frequency over all documents, rarest
first; a block and a template are sorted lists of these numbers, and other words
of a block play no part. With ``need`` the words that must be common, a block is
compared with a template only if

* *length*: it has ``need`` of the numbered words,
* *prefix*: one of the template's first ``size - need + 1`` numbers is among the
  block's first likewise,
* *position*: what can still come after that number on both sides suffices.

None of these loses a match. Tasks give out blocks that hold a number of a
template's prefix; the join is then one of small rows with the broadcast prefix
index, and its candidates are verified by their intersection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, with_key
from tidemark.session import cut_lineage

# A-Z in lower case; everything of ASCII but digits and letters separates words.
_AS_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)
SHORTEST = 8  # words of the smallest block step
MOST_TEMPLATE_WORDS = 100_000  # of all templates: they are broadcast

# Sentences by which public licenses are stated.
TEMPLATES = (
    ("agpl", "GNU Affero General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("artistic", "This is free software, licensed under the Artistic License 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This work is free of known copyright restrictions and has been dedicated to the public domain"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words_of(text: str | None) -> list[bytes]:
    """Words: runs of digits, letters and all that is not ASCII; A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_AS_WORDS).split() if text else []


@dataclass(frozen=True)
class Template:
    label: str
    step: int  # its blocks come every so many words, twice as long
    need: int  # words that a block must share
    codes: tuple[int, ...]  # its distinct words by rank, rarest first

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.codes[: len(self.codes) - self.need + 1]


@dataclass(frozen=True)
class Index:
    """Numbered words (from 1, rarest first), templates and phrases in these numbers."""

    numbers: dict[bytes, int]
    templates: tuple[Template, ...]
    phrases: tuple[tuple[str, tuple[int, ...]], ...]


def index(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = (),
    containment: float = 0.9, text: str = "text",
) -> Index:
    """Number the words of templates by their frequency over all documents.

    ``phrases`` are (words, label) to be found as they stand. Templates and
    phrases without a word match nothing. Ties of frequency go by the word.
    """
    if not 0 < containment <= 1:
        raise ValueError("containment is a share above 0, up to 1")
    parts = [(label, words_of(t)) for label, t in templates]
    spoken = [(label, words_of(t)) for t, label in phrases]
    if sum(len(p) for _, p in [*parts, *spoken]) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words")
    known = sorted({w for _, p in [*parts, *spoken] for w in p})
    counts = dict(zip(known, repeat(0)))
    for r in frequencies(docs, known, text).collect():  # a row per word of the templates
        counts[bytes(r["word"])] = r["n"]
    ranked = sorted(known, key=lambda w: (counts[w], w))
    numbers = {w: i for i, w in enumerate(ranked, 1)}
    made = []
    for label, p in parts:
        if p:
            codes = sorted({numbers[w] for w in p})
            step = max(SHORTEST, 1 << (len(p) - 1).bit_length())
            made.append(Template(label, step, math.ceil(containment * len(codes) - 1e-9), tuple(codes)))
    return Index(numbers, tuple(made), tuple((label, tuple(numbers[w] for w in p)) for label, p in spoken if p))


def frequencies(docs: DataFrame, known: Sequence[bytes], text: str = "text") -> DataFrame:
    """(word, n): how often each known word occurs in all documents."""
    place = {w: i for i, w in enumerate(known)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place) + 1, np.int64)
        for batch in text_slices(batches, "text"):
            words = [w for t in batch.column("text").to_pylist() for w in words_of(t)]
            codes = np.fromiter(map(place.get, words, repeat(len(place))), np.int64, len(words))
            total += np.bincount(codes, minlength=len(place) + 1)
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([known[i] for i in seen], pa.binary()), pa.array(total[seen])], ["word", "n"]
        )

    rows = docs.select(F.col(text).alias("text"))
    return rows.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Scanner:
    """Phrases and candidate blocks of a slice of texts."""

    def __init__(self, known: Index):
        self.known = known
        self.steps = sorted({t.step for t in known.templates})
        self.opens, self.least = {}, {}
        for step in self.steps:
            own = [t for t in known.templates if t.step == step]
            self.opens[step] = np.zeros(len(known.numbers) + 1, bool)
            self.opens[step][[c for t in own for c in t.prefix]] = True
            self.least[step] = min(t.need for t in own)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, list, list]:
        """Words of each text, places of phrases (text, word, phrase), blocks per text."""
        words: list[bytes] = []
        starts, counts = [], []
        for t in texts:
            starts.append(len(words))
            words += words_of(t)
            counts.append(len(words) - starts[-1])
            words.append(b"")  # no phrase goes over the end of a text
        codes = np.fromiter(map(self.known.numbers.get, words, repeat(0)), np.int64, len(words))
        first = np.array(starts, np.int64)
        places = []
        for number, (_, phrase) in enumerate(self.known.phrases):
            at = np.flatnonzero(codes == phrase[0])
            for i, c in enumerate(phrase[1:], 1):
                at = at[codes[at + i] == c]  # a text's end follows every word
            owner = np.searchsorted(first, at, side="right") - 1
            places += zip(owner.tolist(), (at - first[owner]).tolist(), [number] * len(at))
        blocks: list[list] = [[] for _ in texts]
        for step in self.steps:
            at = np.flatnonzero(self.opens[step][codes])
            owner = np.searchsorted(first, at, side="right") - 1
            block = (at - first[owner]) // step
            both = np.unique(np.concatenate([np.stack([owner, block - i], axis=1) for i in (0, 1)]), axis=0)
            for o, b in both[both[:, 1] >= 0].tolist():
                start = starts[o] + b * step
                found = np.unique(codes[start : min(start + 2 * step, starts[o] + counts[o])])
                found = found[found > 0].tolist()
                if len(found) >= self.least[step]:
                    blocks[o].append({"step": step, "block": b, "codes": found})
        return np.array(counts, np.int64), places, blocks


_ROW = (
    "n_words bigint, places array<struct<word:bigint,phrase:int>>, "
    "blocks array<struct<step:int,block:bigint,codes:array<int>>>"
)


def scanned(docs: DataFrame, known: Index, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, row, n_words, places, blocks) of every row, written once; ``row`` numbers them."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Scanner(known)
        place = pa.list_(pa.struct([("word", pa.int64()), ("phrase", pa.int32())]))
        block = pa.list_(pa.struct([("step", pa.int32()), ("block", pa.int64()), ("codes", pa.list_(pa.int32()))]))
        for batch in text_slices(batches, "text"):
            counts, places, blocks = tool(batch.column("text").to_pylist())
            by_row: list[list] = [[] for _ in blocks]
            for owner, word, phrase in sorted(places):
                by_row[owner].append({"word": word, "phrase": phrase})
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts), pa.array(by_row, place), pa.array(blocks, block)],
                ["key", "n_words", "places", "blocks"],
            )

    found = rows.mapInArrow(apply, with_key(rows, "key", _ROW))
    return cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))


def contained(rows: DataFrame, known: Index) -> DataFrame:
    """(row, label, start, stop, containment): every block that contains a template.

    ``start`` and ``stop`` are the words of the block.
    """
    spark = rows.sparkSession
    prefixes = spark.createDataFrame(
        [
            (t.step, code, i, at, len(t.codes), t.need)
            for i, t in enumerate(known.templates) for at, code in enumerate(t.prefix)
        ],
        "step int, code int, template int, of_template int, size int, need int",
    )
    wholes = spark.createDataFrame(
        [(i, t.label, list(t.codes)) for i, t in enumerate(known.templates)],
        "template int, label string, whole array<int>",
    )
    blocks = rows.select("row", "n_words", F.explode("blocks").alias("b")).select("row", "n_words", "b.*")
    opened = blocks.select("*", F.size("codes").alias("held"), F.posexplode("codes").alias("of_block", "code"))
    # MOST_TEMPLATE_WORDS bounds both tables that are broadcast.
    after = F.least(F.col("size") - F.col("of_template"), F.col("held") - F.col("of_block"))
    candidates = (
        opened.join(F.broadcast(prefixes), ["step", "code"])
        .filter((F.col("held") >= F.col("need")) & (F.col("of_block") <= F.col("held") - F.col("need")))
        .filter(F.least("of_template", "of_block") + after >= F.col("need"))
        .groupBy("row", "step", "block", "template")
        .agg(*[F.first(c).alias(c) for c in ("n_words", "codes", "size", "need")])
    )
    shared = F.size(F.array_intersect("codes", "whole"))
    start = F.col("block") * F.col("step")
    return (
        candidates.join(F.broadcast(wholes), "template").withColumn("shared", shared).filter("shared >= need")
        .select(
            "row", "label", start.alias("start"), F.least(start + 2 * F.col("step"), "n_words").alias("stop"),
            (F.col("shared") / F.col("size")).alias("containment"),
        )
    )


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = (),
    containment: float = 0.9, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks) of every row.

    ``n_base`` counts the places of all phrases, which may overlap; first and
    last are the words where the first and the last one start (null without
    any). ``labels`` has those of phrases and of templates; both lists are
    distinct and sorted. ``score`` is the highest containment found, 1 for a
    phrase, 0 for nothing. ``blocks`` tells where templates were found (label,
    start, stop, containment), in order.

    Null texts count as empty. Rows may repeat and ids be null: every row is
    judged by itself. An empty table gives none; other columns take no part.
    """
    known = index(docs, templates, phrases, containment, text)
    rows = scanned(docs, known, key, text)
    block = F.struct("start", "stop", "label", "containment")
    hits = contained(rows, known).groupBy("row").agg(F.array_sort(F.collect_set(block)).alias("found"))
    names = F.array(*[F.lit(label) for label, _ in known.phrases]).cast("array<string>")
    of_phrases = F.transform("places", lambda p: F.get(names, p["phrase"]))
    found = F.coalesce("found", F.expr("cast(array() as array<struct<start:bigint,stop:bigint,label:string,containment:double>>)"))
    return (
        rows.join(hits, "row", "left")
        .withColumns({"found": found, "base_labels": F.array_sort(F.array_distinct(of_phrases))})
        .select(
            F.col("key").alias(key), "n_words", F.size("places").cast("bigint").alias("n_base"),
            F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
            "base_labels", F.array_sort(F.array_union("base_labels", "found.label")).alias("labels"),
            F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("found.containment"), F.lit(0.0))).alias("score"),
            F.col("found").alias("blocks"),
        )
    )

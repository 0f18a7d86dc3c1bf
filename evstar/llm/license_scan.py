"""License scan as an exact set-similarity join of text blocks with templates.

A template is a bag of words with a containment threshold ``t``; a text block
is any run of as many consecutive words as the template has (the whole text,
where that is shorter). A block belongs to a template when at least
``alpha = ceil(t * size)`` of the template's words, repeats included, are in
it. Every such block is found:

- words are ordered by the number of documents that hold them, rarest first
  (counted over all documents);
- prefix filter: a block that holds ``alpha`` words of a template holds one of
  its ``size - alpha + 1`` rarest, so only blocks around an occurrence of
  those are looked at, through an inverted index from word to templates;
- length filter: a block with fewer than ``alpha`` words of the template's
  vocabulary is left;
- positional filter: the template's words are matched in order, and a block is
  left as soon as what was matched and what remains are too few.

An ordered template (a phrase) must also stand in the block word by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts_of
from .decontaminate import merge_intervals, words_of

#: Words of templates that are broadcast at once; a larger set is handled in
#: blocks, one pass over the documents for each.
BLOCK_WORDS = 2_000_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    percent: int = 80  # containment threshold
    ordered: bool = False  # a phrase: its words in a row


# The phrases of the base labels, and notices of public licenses.
PHRASES = [
    Template("mit", "MIT License", 100, True),
    Template("apache", "Apache License", 100, True),
    Template("gpl", "General Public License", 100, True),
]
NOTICES = [
    Template("mit", "Released under the MIT License."),
    Template("apache", "Licensed under the Apache License, Version 2.0."),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
]
TEMPLATES = PHRASES + NOTICES

MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("template", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("stop", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
)
_MATCHES = pa.list_(
    pa.struct([("template", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("containment", pa.float64())])
)


def alpha(size: int, percent: int) -> int:
    """The words of a template that a block must hold."""
    return max(-(-size * percent // 100), 1)


class TemplateIndex:
    """The templates over word numbers that follow the global order, and the
    inverted index from the words of their prefixes."""

    def __init__(self, templates: list[tuple[int, Template]], frequency: dict[bytes, int]) -> None:
        bags = {n: Counter(words_of(t.text)) for n, t in templates}
        vocabulary = sorted({w for bag in bags.values() for w in bag}, key=lambda w: (frequency.get(w, 0), w))
        self.ids = {w: k for k, w in enumerate(vocabulary, 1)}
        self.is_prefix = np.zeros(len(vocabulary) + 1, bool)
        self.index: dict[int, list[int]] = {}
        self.order: dict[int, list[tuple[int, int]]] = {}  # (word, its how-manieth copy) by the global order
        self.alpha: dict[int, int] = {}
        self.phrase: dict[int, np.ndarray] = {}
        for n, t in templates:
            order = sorted((self.ids[w], k) for w, count in bags[n].items() for k in range(1, count + 1))
            if not order:
                continue
            self.order[n], self.alpha[n] = order, alpha(len(order), t.percent)
            for word in {w for w, _ in order[: len(order) - self.alpha[n] + 1]}:
                self.index.setdefault(word, []).append(n)
                self.is_prefix[word] = True
            if t.ordered:
                self.phrase[n] = np.array([self.ids[w] for w in words_of(t.text)], np.int64)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int, float]]:
        """``(template, start, stop, containment)`` of every place: a
        phrase's places one by one, other templates' blocks as maximal runs
        of starts, each with its greatest containment."""
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, len(words))
        at: dict[int, list[int]] = {}
        for p in np.flatnonzero(self.is_prefix[ids]).tolist():
            for n in self.index[int(ids[p])]:
                at.setdefault(n, []).append(p)
        out: list[tuple[int, int, int, float]] = []
        for n in sorted(at):
            width = min(len(self.order[n]), len(ids))
            starts, overlap = self._blocks(n, ids, at[n], width)
            if n in self.phrase:
                phrase = self.phrase[n]
                for s in starts.tolist():
                    if width == len(phrase) and np.array_equal(ids[s : s + width], phrase):
                        out.append((n, s, s + width, 1.0))
            elif len(starts):
                for run in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) > 1) + 1):
                    best = int(overlap[run].max()) / len(self.order[n])
                    out.append((n, int(starts[run[0]]), int(starts[run[-1]]) + width, best))
        return out

    def _blocks(self, n: int, ids: np.ndarray, found: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the blocks that hold enough of template ``n``, among
        those around the prefix words ``found``, and how much they hold."""
        order, need, last = self.order[n], self.alpha[n], len(ids) - width
        around = merge_intervals([(max(p - width + 1, 0), min(p, last) + 1) for p in found])
        starts = np.concatenate([np.arange(a, b) for a, b in around])
        own = np.zeros(len(self.is_prefix), bool)
        own[[w for w, _ in order]] = True
        upto = np.r_[0, np.cumsum(own[ids])]
        starts = starts[upto[starts + width] - upto[starts] >= need]  # length filter
        overlap = np.zeros(len(starts), np.int64)
        word, places = 0, np.empty(0, np.int64)
        for k, (w, copy) in enumerate(order):
            if not len(starts):
                break
            if w != word:
                word, places = w, np.flatnonzero(ids == w)
            overlap += np.searchsorted(places, starts + width) - np.searchsorted(places, starts) >= copy
            alive = overlap + (len(order) - k - 1) >= need  # positional filter
            starts, overlap = starts[alive], overlap[alive]
        return starts, overlap


def document_frequency(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each of ``words`` (a set of bounded size)."""
    ids = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(sorted(words))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(ids.value), np.int64)
        for batch in batches:
            for _, texts in texts_of(batch, "text"):
                for text in texts:
                    held = {ids.value.get(w, -1) for w in set(words_of(text))} - {-1}
                    counts[list(held)] += 1
        seen = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(counts[seen])], names=["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    by_number = dict(enumerate(sorted(words)))
    return {by_number[r["word"]]: r["n"] for r in counted.collect()}


def find_blocks(docs: DataFrame, templates: list[Template] = TEMPLATES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id`` with ``n_words`` and ``license_matches``: for every row the
    blocks of each template (by its place in ``templates``), as runs of words
    ``[start, stop)``.

    Null texts count as empty; a template without words matches nothing; rows
    that repeat give repeated results; other columns are ignored.
    """
    groups: list[list[tuple[int, Template]]] = [[]]
    size = 0
    for n, t in enumerate(templates):
        length = len(words_of(t.text))
        if groups[-1] and size + length > block_words:
            groups.append([])
            size = 0
        groups[-1].append((n, t))
        size += length
    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("license_matches", MATCHES)])
    carried = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("license_matches", MATCHES)])
    for g, group in enumerate(groups):
        frequency = document_frequency(docs, {w for _, t in group for w in words_of(t.text)})
        shared = docs.sparkSession.sparkContext.broadcast(TemplateIndex(group, frequency))
        last = g == len(groups) - 1

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last, first=g == 0) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                earlier = None if first else batch.column(2).to_pylist()
                n_words, matches = [], []
                for start, texts in texts_of(batch, "text"):
                    for k, text in enumerate(texts, start):
                        words = words_of(text)
                        found = [dict(zip(("template", "start", "stop", "containment"), m)) for m in index.matches(words)]
                        matches.append(found if first else earlier[k] + found)
                        n_words.append(len(words))
                second = pa.array(n_words, pa.int64()) if last else batch.column(1).cast(pa.string())
                names = ["doc_id", "n_words" if last else "text", "license_matches"]
                yield pa.record_batch([batch.column(0), second, pa.array(matches, _MATCHES)], names=names)

        rows = rows.mapInArrow(run, schema if last else carried)
    return rows


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base`` (places of phrases),
    ``first_word, last_word`` (smallest and largest start of these),
    ``base_labels, labels`` (distinct, sorted, comma-joined; of phrases, and of
    all templates), ``score`` (the greatest containment found, else 0) and
    ``blocks`` (what was found, with labels)."""
    found = find_blocks(docs, templates)
    names = F.array(*[F.lit(t.label) for t in templates])
    phrase = F.array(*[F.lit(t.ordered) for t in templates])
    places = F.filter("license_matches", lambda m: F.get(phrase, m["template"]))
    label = lambda m: F.get(names, m["template"])
    starts = F.transform(F.col("places"), lambda m: m["start"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, label))), ",")
    return found.withColumn("places", places).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.col("places")).alias("base_labels"),
        joined(F.col("license_matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("license_matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"),
        F.transform(
            "license_matches",
            lambda m: F.struct(label(m).alias("label"), m["start"].alias("start"), m["stop"].alias("stop"), m["containment"].alias("containment")),
        ).alias("blocks"),
    )

"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Paragraphs are vectors of word unigrams and bigrams.  A multinomial logistic regression over
the licence families and the class "unknown" is trained on variants of the templates and on
paragraphs of the corpus.  Its temperature and the least probability of a family are set on
rows kept out of training.

A paragraph ends at a blank line, so hard-wrapped notices are whole.  Inside it, alignment
finds the windows of words that hold a template's words in order, whatever the paragraph's
length, and sentences or lines that are a part of a template.  A window is a notice only if
the classifier predicts that template's family for it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import islice
from math import ceil
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import among_smallest, annotate, as_texts, table

#: Corpus documents and paragraphs of each that serve as unknown rows of the training set.
SAMPLE_DOCUMENTS, SAMPLE_PARAGRAPHS = 1_500, 6
#: Share of unknown validation rows that may pass, and of words in order with a template.
FALSE_ACCEPTANCE, AGREEMENT = 0.001, 0.7
#: Least words of a sentence or line that is only a part of a template.
PART_WORDS = 8
#: Cost, in matched words, of a word between two words of a template and of a template's word left out.
BETWEEN, LEFT_OUT = 0.2, 0.3
UNKNOWN = "unknown"

# Notices by which works state their licence, by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "bsd-3-clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc0-1.0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
}
# Sentences with the vocabulary of licences that grant none.
DECOYS = (
    "All rights reserved.", "The licensed version of the work is public.", "A general license is required to drive.",
    "The source code was released under pressure.", "He is free to use the software.", "Version 2.0 of the text.",
    "The foundation published the conditions of use.", "A copy of the file may be obtained at the office.",
    "Permission was granted to the person.", "This work is in the public domain of ideas.",
)

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_SENTENCE = re.compile(r"\S.*?(?:[.!?](?=\s)|$)", re.DOTALL)
_BREAK = re.compile(r"[.!?]\W*\s|\n")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(tokens: list[str]) -> list[str]:
    return [*tokens, *map(" ".join, zip(tokens, tokens[1:]))]


def paragraphs(text: str) -> list[tuple[int, int]]:
    """Code point spans of the paragraphs, which lines without any word separate."""
    out, at, first, last = [], 0, None, 0
    for line in text.split("\n"):
        if _WORD.search(line):
            if first is None:
                first = at + len(line) - len(line.lstrip())
            last = at + len(line.rstrip())
        elif first is not None:
            out.append((first, last))
            first = None
        at += len(line) + 1
    if first is not None:
        out.append((first, last))
    return out


class Template(NamedTuple):
    """A template's words, and what of them must be near each other before words are aligned."""

    family: str
    words: list[str]
    names: frozenset[str]
    least_names: int
    pairs: frozenset[tuple[str, str]]
    least_pairs: int


def _templates() -> list[Template]:
    """Names are the template's words that the fewest families use."""
    families = Counter(w for ts in TEMPLATES.values() for w in {w for t in ts for w in words(t)})
    out = []
    for family, texts in TEMPLATES.items():
        for tokens in map(words, texts):
            rarest = min(families[w] for w in tokens)
            names = frozenset(w for w in tokens if families[w] == rarest)
            pairs = frozenset(zip(tokens, tokens[1:]))
            out.append(Template(
                family, tokens, names, ceil(AGREEMENT * min(len(names), 4)), pairs, min(ceil(len(pairs) / 4), 4)
            ))
    return out


ALL_TEMPLATES = _templates()
#: Templates by name; a text without any of these words has no notice.
BY_NAME: dict[str, list[int]] = defaultdict(list)
for _k, _t in enumerate(ALL_TEMPLATES):
    for _w in sorted(_t.names):
        BY_NAME[_w].append(_k)


def _regions(tokens: list[str]) -> list[tuple[Template, int, int]]:
    """Stretches of words where enough names and word pairs of a template are near each other."""
    places: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(tokens):
        for k in BY_NAME.get(w, ()):
            places[k].append(i)
    out = []
    for k, at in places.items():
        t = ALL_TEMPLATES[k]
        reach, low, inside, spans = 2 * len(t.words), 0, Counter(), []
        for i in at:
            inside[tokens[i]] += 1
            while i - at[low] > reach:
                inside[tokens[at[low]]] -= 1
                if not inside[tokens[at[low]]]:
                    del inside[tokens[at[low]]]
                low += 1
            if len(inside) >= t.least_names:
                first, last = max(0, at[low] - reach), min(len(tokens), i + reach + 1)
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = last
                else:
                    spans.append([first, last])
        for first, last in spans:
            if len(t.pairs.intersection(zip(tokens[first:last], tokens[first + 1 : last]))) >= t.least_pairs:
                out.append((t, first, last))
    return out


def _windows(tokens: list[str], template: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(matched, first, last, template's first, template's last) of separate local alignments, best first."""
    size = len(template)
    before: list = [None] * size
    ends = []
    for i, x in enumerate(tokens):
        row: list = [None] * size
        best = None
        for k, y in enumerate(template):
            cell = None
            if x == y:
                d = before[k - 1] if k else None
                cell = (d[0] + 1, d[1] + 1, d[2], d[3]) if d else (1.0, 1, i, k)
                if best is None or cell[0] > best[0][0]:
                    best = (cell, k)
            up = before[k]
            if up and up[0] > BETWEEN and (cell is None or up[0] - BETWEEN > cell[0]):
                cell = (up[0] - BETWEEN, *up[1:])
            left = row[k - 1] if k else None
            if left and left[0] > LEFT_OUT and (cell is None or left[0] - LEFT_OUT > cell[0]):
                cell = (left[0] - LEFT_OUT, *left[1:])
            row[k] = cell
        if best:
            (score, matched, start, k), last = best
            ends.append((score, matched, start, i, k, last))
        before = row
    return [c[1:] for c in _apart(sorted(ends, key=lambda c: (-c[0], c[2])), 2, 3)]


def _apart(ranked: list[tuple], first: int, last: int) -> list[tuple]:
    """The entries that overlap none of those before them; fields give the ends of their spans."""
    starts: list[int] = []
    taken: list[tuple] = []
    for c in ranked:
        j = bisect_right(starts, c[last])
        if j and taken[j - 1][last] >= c[first]:
            continue
        starts.insert(j, c[first])
        taken.insert(j, c)
    kept = set(map(id, taken))
    return [c for c in ranked if id(c) in kept]


def _outside(text: str, marks: list[re.Match], first: int, last: int) -> int:
    """Words around a window in the sentences or lines it lies in, up to as many as it has."""
    most, n = last - first + 1, 0
    i = first
    while i > 0 and n < most and not _BREAK.search(text, marks[i - 1].end(), marks[i].start()):
        i, n = i - 1, n + 1
    i = last
    while i + 1 < len(marks) and n < most and not _BREAK.search(text, marks[i].end(), marks[i + 1].start()):
        i, n = i + 1, n + 1
    return n


def candidates(text: str) -> list[tuple[str, int, int, float, list[str]]]:
    """(family, start, end, agreement, words) of every window that follows a template.

    Either the window holds the template's words, or it makes up most of a sentence or line
    and lies in the template.  Windows may overlap; those with most words in order come first.
    """
    out = []
    if BY_NAME.keys().isdisjoint(words(text)):
        return out
    for first, last in paragraphs(text):
        if not _regions(words(text[first:last])):
            continue
        marks = list(_WORD.finditer(text, first, last))
        tokens = [m[0].lower() for m in marks]
        for t, low, high in _regions(tokens):
            for matched, a, b, u, v in _windows(tokens[low:high], t.words):
                a, b = low + a, low + b
                count = b - a + 1
                names = t.names.intersection(t.words[u : v + 1])
                if len(names.intersection(tokens[a : b + 1])) < AGREEMENT * len(names) or not names:
                    continue
                if matched >= AGREEMENT * len(t.words):
                    same = matched / len(t.words)
                elif count >= PART_WORDS and matched >= AGREEMENT * (count + _outside(text, marks, a, b)):
                    same = matched / (count + _outside(text, marks, a, b))
                else:
                    continue
                start, end = marks[a].start(), marks[b].end()
                while start > first and text[start - 1] in "([<\"'":
                    start -= 1
                while end < last and not text[end].isspace() and not text[end].isalnum():
                    end += 1
                out.append((matched, t.family, start, end, same, tokens[a : b + 1]))
    return [c[1:] for c in sorted(out, key=lambda c: (-c[0], -c[4], c[2], c[1]))]


def variants(tokens: list[str], rng: np.random.Generator, count: int) -> list[list[str]]:
    """A template's words with some dropped, cut off or added at the edges."""
    out = [tokens]
    for _ in range(count):
        kept = [t for t in tokens if rng.random() > 0.08] or tokens
        if len(kept) > 12 and rng.random() < 0.5:
            start = int(rng.integers(0, len(kept) // 3))
            kept = kept[start : start + max(8, len(kept) * 2 // 3)]
        if rng.random() < 0.3:
            kept = [*kept, *map(str, rng.integers(1990, 2030, int(rng.integers(1, 3))))]
        out.append(kept)
    return out


class Classifier:
    """Multinomial logistic regression over word n-grams, with a calibrated acceptance."""

    def __init__(self, unknown: list[list[str]], seed: int = 5, rounds: int = 60):
        rng = np.random.default_rng(seed)
        self.families = [*sorted(TEMPLATES), UNKNOWN]
        rows, labels = [], []
        for k, family in enumerate(self.families[:-1]):
            for template in TEMPLATES[family]:
                for v in variants(words(template), rng, 40):
                    rows.append(v)
                    labels.append(k)
        others = [words(d) for d in DECOYS for _ in range(20)] + [u for u in unknown if u]
        rows += others
        labels += [len(self.families) - 1] * len(others)
        held = rng.random(len(rows)) < 0.2
        seen = Counter(g for r, h in zip(rows, held) if not h for g in set(grams(r)))
        self.vocabulary = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n >= 2))}
        vectors = [self._row(r) for r in rows]
        self.weights = np.zeros((len(self.vocabulary) + 1, len(self.families)))
        self.temperature, self.least = 1.0, 0.5
        labels = np.array(labels)
        self._fit([v for v, h in zip(vectors, held) if not h], labels[~held], rng, rounds)
        self._calibrate([v for v, h in zip(vectors, held) if h], labels[held])

    def _row(self, tokens: list[str]) -> np.ndarray:
        known = self.vocabulary
        return np.unique(np.array([known[g] for g in grams(tokens) if g in known] + [len(known)], int))

    def _logits(self, row: np.ndarray) -> np.ndarray:
        return self.weights[row].sum(0) / np.sqrt(len(row))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max())
        return e / e.sum()

    def _fit(self, rows, labels, rng, rounds, rate: float = 0.5, ridge: float = 1e-4) -> None:
        """Stochastic gradient steps on the rows' log loss with a falling rate."""
        for turn in range(rounds):
            step = rate / (1 + turn / 5)
            for i in rng.permutation(len(rows)):
                row = rows[i]
                slope = self._softmax(self._logits(row))
                slope[labels[i]] -= 1
                self.weights[row] -= step * (slope / np.sqrt(len(row)) + ridge * self.weights[row])

    def _calibrate(self, rows, labels) -> None:
        if not rows:
            return
        logits = np.array([self._logits(r) for r in rows])
        loss = lambda t: -np.mean([np.log(self._softmax(z / t)[y] + 1e-12) for z, y in zip(logits, labels)])
        self.temperature = min(np.geomspace(0.25, 4, 17), key=loss)
        best = [self._softmax(z / self.temperature)[:-1].max() for z, y in zip(logits, labels) if y == len(self.families) - 1]
        if best:
            self.least = float(max(0.5, np.quantile(best, 1 - FALSE_ACCEPTANCE)))

    def predict(self, tokens: list[str]) -> tuple[str, float]:
        """The family, or unknown, and its calibrated probability."""
        p = self._softmax(self._logits(self._row(tokens)) / self.temperature)
        k = int(p[:-1].argmax())
        return (self.families[k], float(p[k])) if p[k] >= self.least else (UNKNOWN, float(p[-1]))


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of two word lists."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            above = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(above, row[j])
            before = above
    return row[-1]


def agreement(tokens: list[str], family: str) -> float:
    """Best share of words in order between the tokens and a template of the family."""
    return max(
        2 * _common(tokens, t) / (len(tokens) + len(t)) for t in map(words, TEMPLATES[family])
    )


def classifier(docs: DataFrame, text_col: str, sample_documents: int = SAMPLE_DOCUMENTS) -> Classifier:
    """Train on the templates and on sentences of a bounded sample of different documents.

    Sentences that follow a template are left out of the unknown rows.
    """
    sampled = docs.select(F.substring(text_col, 1, 20_000).alias("text")).where("text is not null")
    hashed = F.xxhash64("text")
    # candidates are about as many as are wanted, and copies are one
    near = sampled.where(among_smallest(sampled, hashed, sample_documents)).groupBy(hashed.alias("hash"))
    sampled = near.agg(F.min("text").alias("text")).orderBy("hash").limit(sample_documents).collect()
    unknown = []
    vocabulary = {w for family in TEMPLATES.values() for t in family for w in words(t)}
    for r in sampled:
        units = (m[0] for a, b in paragraphs(r["text"]) for m in _SENTENCE.finditer(r["text"][a:b]))
        for unit in islice(units, SAMPLE_PARAGRAPHS):
            tokens = words(unit)[:120]
            foreign = sum(t not in vocabulary for t in tokens) > 0.6 * len(tokens)
            if (foreign or all(agreement(tokens[:60], f) < 0.4 for f in TEMPLATES)) and not candidates(unit):
                unknown.append(tokens)
    return Classifier(unknown)


def scan(docs: DataFrame, text_col: str = "text", sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Append ``licences``: family, code point span, probability and template agreement.

    Every paragraph of every whole text is searched, and every window that follows a template
    is classified.  Null and empty texts have none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(classifier(docs, text_col, sample_documents)))
    fields = "licences array<struct<family:string,start:bigint,end:bigint,probability:double,agreement:double>>"

    def start():
        model = Classifier.__new__(Classifier)
        vars(model).update(shared.value)

        def work(column):
            out = []
            for text in as_texts(column):
                found = []
                for family, first, last, same, tokens in candidates(text):
                    predicted, probability = model.predict(tokens)
                    if predicted == family:
                        found.append((first, last, family, probability, same))
                out.append([
                    {"family": f, "start": a, "end": b, "probability": p, "agreement": g}
                    for a, b, f, p, g in sorted(_apart(found, 0, 1))
                ])
            return [out]

        return work

    return annotate(docs, [text_col], fields, start)


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Licence families and notice spans of every document of a directory."""
    docs = table(spark, directory, "documents").select("doc_id", "text")
    span = lambda s: F.concat_ws(":", s["family"], s["start"], s["end"])
    return scan(docs).select(
        "doc_id",
        F.size("licences").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda s: s["family"]))), ",").alias("families"),
        F.array_join(F.transform("licences", span), ",").alias("spans"),
    )

"""Licence scans: a trained paragraph classifier, an unknown class with calibrated probabilities, and template comparison.

A paragraph is a line. Lines above ``WINDOW_WORDS`` words are judged in overlapping windows, and lines above ``SHORT_WORDS``
words in short windows too, so whole texts are read and each notice inside a long line is found, a short one amid other text
as well. Neighbouring windows of one family are one notice, whose span is that of the windows; a line that is one window
gives its whole span. A notice of no known family counts where no window names a family, and a short window within a
notice of another family where it holds most of a template. Features are word unigrams and bigrams, lower-cased and without punctuation. A sparse multinomial
logistic regression is trained on varied copies of the templates below against lines of the corpus (a bounded sample: ``n_lines``
lines, drawn by hash from the whole texts of ``background_docs`` documents, the ids that hash lowest). Its vocabulary is the templates' n-grams, so a paragraph's
score takes the few known words of it.

Probabilities are calibrated by a temperature fitted on copies held back. A paragraph is a notice when its probability of
being no notice is below one half. Its family is confirmed when its calibrated probability is high enough and the
paragraph shares most n-grams with a template of that family; else the notice is ``unknown``, if it has five known n-grams.

Defined results: a null, empty or blank text has no paragraphs. Null ids get rows like others. Rows repeated get equal
results. An empty table gives an empty result (and background lines are then none). Other columns are not looked at.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

WINDOW_WORDS, WINDOW_STEP = 60, 30
SHORT_WORDS, SHORT_STEP = 20, 5
BACKGROUND_DOCS, BACKGROUND_LINES = 300, 3000
COPIES, ROUNDS, RATE, DECAY = 40, 250, 0.05, 2e-4
SURE, SHARED, LEAST_GRAMS = 0.6, 0.65, 5
OTHER, UNKNOWN = "none", "unknown"
#: The share of a template that is most of it; windows scored at once.
WHOLE, UNITS_AT_ONCE = 0.9, 1 << 15
SEED = 11
_BETWEEN_BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
_DROPPED = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c != ord("-"))

# fixed values: how notices of each family read
TEMPLATES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "reserved": [
        "All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted without the prior written permission of the publisher.",
    ],
}
#: Sentences with words of notices that are none.
NEAR_MISSES = [
    "She got her driving license in version of the test for any person over eighteen.",
    "The general public may use the work of this library free of charge.",
    "The conditions of the permit are subject to the terms of the source.",
    "The university of this state released a copy of the notice under the name of the author.",
    "Rights of the people are reserved to the states without restriction.",
]
#: Notices of families that have no template: they are notices, but of no known family.
FOREIGN = [
    "This work is licensed under the terms of the Harbour Community License, version 4.",
    "Released under the Lighthouse Public License.",
    "Licensed under the Oakfield Permissive License, Version 1.1.",
    "You may obtain a copy of the Riverbank License in the LICENSE file.",
]


def words_of(line: bytes) -> list[bytes]:
    return line.lower().translate(None, _DROPPED).split()


def grams_of(words: list[bytes]) -> set[bytes]:
    return {*words, *(a + b" " + b for a, b in zip(words, words[1:]))}


def windows(words: list[bytes], size: int = WINDOW_WORDS, step: int = WINDOW_STEP) -> list[list[bytes]]:
    return [words[a:b] for a, b in window_spans(len(words), size, step)]


def window_spans(n: int, size: int = WINDOW_WORDS, step: int = WINDOW_STEP) -> list[tuple[int, int]]:
    """The first word of each window and the one behind its last."""
    if n <= size:
        return [(0, n)]
    return [(i, min(i + size, n)) for i in range(0, n - (size - step), step)]


_TEMPLATE_GRAMS = {family: [grams_of(words_of(t.encode())) for t in texts] for family, texts in TEMPLATES.items()}


def shared(words: list[bytes], family: str) -> float:
    """The largest share of n-grams a paragraph has in common with a template, of the smaller of both; few are not enough."""
    own = grams_of(words)
    return max(len(own & t) / max(min(LEAST_GRAMS, len(t)), min(len(own), len(t))) for t in _TEMPLATE_GRAMS[family])


@dataclass
class Classifier:
    """Weights of n-grams by class (the last class is no notice) with a temperature."""

    classes: list[str]
    index: dict[bytes, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, units: list[list[bytes]]) -> np.ndarray:
        """One row per unit: the bias and the weights of the known n-grams in it, over the root of the number of all in it.

        A bigram is known only if its words are, so words that are not known cost one look-up.
        """
        get = self.index.get
        rows, columns = [], []
        for u, words in enumerate(units):
            found, last = set(), None
            for word in words:
                at = get(word)
                if at is not None:
                    found.add(at)
                    if last is not None and (pair := get(last + b" " + word)) is not None:
                        found.add(pair)
                    last = word
                else:
                    last = None
            columns += found
            rows += [u] * len(found)
        out = np.zeros((len(units), len(self.classes)))
        if rows:
            rows = np.array(rows)
            starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            sums = np.add.reduceat(self.weights[np.array(columns)], starts, axis=0)
            sizes = np.array([2 * len(units[u]) - 1 for u in rows[starts]])
            out[rows[starts]] = sums / np.sqrt(sizes)[:, None]
        return out + self.bias

    def probabilities(self, units: list[list[bytes]]) -> np.ndarray:
        return _softmax(self.logits(units) / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _varied(words: list[bytes], filler: list[bytes], rng: random.Random) -> list[bytes]:
    """A copy with some words left out or replaced, between words of other text."""
    kept = [rng.choice(filler) if rng.random() < 0.05 else w for w in words if rng.random() > 0.08 or len(words) < 6]
    start = rng.randrange(max(1, len(kept) - 12)) if len(kept) > 16 and rng.random() < 0.5 else 0
    kept = kept[start : start + rng.randrange(8, 60)]
    before, behind = ([rng.choice(filler) for _ in range(rng.choice((0, 0, 1, 3, 8)))] for _ in range(2))
    return before + kept + behind


def train(background: list[bytes], seed: int = SEED, copies: int = COPIES) -> Classifier:
    """Fit weights on two thirds of the varied copies, and the temperature on the rest."""
    rng = random.Random(seed)
    classes = [*TEMPLATES, UNKNOWN, OTHER]
    notices = {**TEMPLATES, UNKNOWN: FOREIGN}
    lines = [words_of(x) for x in background]
    lines = [x for x in lines if x and max(shared(x, family) for family in TEMPLATES) < 0.3]
    misses = [words_of(x.encode()) for x in NEAR_MISSES]
    filler = [w for x in lines[:500] for w in x] or [w for x in misses for w in x]
    units, targets = [], []
    for c, name in enumerate(classes[:-1]):
        for text in notices[name]:
            words = words_of(text.encode())
            units += [words] + [_varied(words, filler, rng) for _ in range(copies)]
            targets += [c] * (copies + 1)
    scattered = [rng.choice(misses + [words_of(t.encode()) for ts in TEMPLATES.values() for t in ts]) for _ in range(20 * copies)]
    scattered = [[rng.choice(filler) for _ in range(rng.randrange(20))] + [rng.choice(x)] for x in scattered]  # single words
    others = scattered + [w for x in lines for w in windows(x)] + [_varied(x, filler, rng) for x in misses for _ in range(copies)] + misses
    units += others
    targets += [len(classes) - 1] * len(others)
    known = sorted(set().union(*(t for ts in _TEMPLATE_GRAMS.values() for t in ts), *(grams_of(words_of(x.encode())) for x in FOREIGN)))
    model = Classifier(classes, {g: i for i, g in enumerate(known)}, np.eye(len(known), dtype=np.float32), np.zeros(1))
    y = np.array(targets)
    held = np.array([rng.random() < 1 / 3 for _ in units])
    x = _features(model, units)
    model.weights, model.bias = _regression(x[~held], y[~held], len(classes))
    logits = x[held] @ model.weights + model.bias
    grid = np.geomspace(0.25, 8, 41)
    loss = [-np.log(_softmax(logits / t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def _features(model: Classifier, units: list[list[bytes]]) -> np.ndarray:
    """Rows as :meth:`Classifier.logits` weighs them."""
    x = np.zeros((len(units), len(model.index)), np.float32)
    for u, words in enumerate(units):
        found = [model.index[g] for g in grams_of(words) if g in model.index]
        if found:
            x[u, found] = (2 * len(words) - 1) ** -0.5
    return x


def _regression(x: np.ndarray, y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by Adam over all rows; classes weigh alike."""
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    goal = np.eye(classes, dtype=np.float32)[y]
    weight = (1 / np.maximum(np.bincount(y, minlength=classes), 1))[y]
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    moments = [np.zeros_like(v) for v in (w, w, b, b)]
    for step in range(1, ROUNDS + 1):
        d = (_softmax(x @ w + b) - goal) * weight
        for v, g, i in ((w, x.T @ d + DECAY * np.sign(w) * 0.1 + DECAY * w, 0), (b, d.sum(axis=0), 2)):
            moments[i] += 0.1 * (g - moments[i])
            moments[i + 1] += 0.001 * (g * g - moments[i + 1])
            v -= RATE * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.999**step)) + 1e-8)
    return w, b


def judge_text(model: Classifier, text: str) -> list[dict]:
    """The notices of a text: family, line span in code points, and calibrated probability."""
    return judge_texts(model, [text])[0]


@dataclass
class _Hit:
    """A window taken for a notice: its words' places in the line."""

    first: int
    last: int
    wide: bool
    confirmed: bool
    sure: float
    family: str
    whole: bool  # it holds most of a template

    def meets(self, other: _Hit) -> bool:
        return self.first < other.last and other.first < self.last


def _notices(hits: list[_Hit]) -> list[_Hit]:
    """The notices of a line from its windows: one per run of neighbouring windows of a family."""
    named = [h for h in hits if h.confirmed and h.wide]
    named += [h for h in hits if h.confirmed and not h.wide and (h.whole or not any(h.meets(w) and w.family != h.family for w in named))]
    kept = named + [h for h in hits if not h.confirmed and not any(h.meets(c) for c in named)]
    out: list[_Hit] = []
    last: dict[str, _Hit] = {}
    for h in sorted(kept, key=lambda h: (h.first, h.last)):
        before = last.get(h.family)
        if before and h.first <= before.last:
            before.last, before.sure = max(before.last, h.last), max(before.sure, h.sure)
        else:
            last[h.family] = h
            out.append(h)
    return out


def _word_places(line: str) -> list[tuple[int, int]]:
    """Where in the line, in code points, the words of ``words_of`` are."""
    return [m.span() for m in _BETWEEN_BLANKS.finditer(line) if m[0].encode().translate(None, _DROPPED)]


def judge_texts(model: Classifier, texts: list[str]) -> list[list[dict]]:
    units, owners = [], []
    for t, text in enumerate(texts):
        for n, line in enumerate(text.encode().lower().translate(None, _DROPPED).split(b"\n")):
            words = line.split()
            if words:
                spans = [(a, b, True) for a, b in window_spans(len(words))]
                if len(words) > SHORT_WORDS:
                    spans += [(a, b, False) for a, b in window_spans(len(words), SHORT_WORDS, SHORT_STEP)]
                for a, b, wide in spans:
                    units.append(words[a:b])
                    owners.append((t, n, a, b, wide, len(words)))
    out: list[list[dict]] = [[] for _ in texts]
    if not units:
        return out
    p = np.concatenate([model.probabilities(units[i : i + UNITS_AT_ONCE]) for i in range(0, len(units), UNITS_AT_ONCE)])
    hits: dict[tuple[int, int, int], list[_Hit]] = {}
    for u in np.flatnonzero(p[:, -1] < 0.5):
        top = int(np.argmax(p[u, :-1]))
        name, sure = model.classes[top], float(p[u, top])
        confirmed = name != UNKNOWN and sure >= SURE and shared(units[u], name) >= SHARED
        own = grams_of(units[u])
        if not confirmed and len(own & model.index.keys()) < LEAST_GRAMS:
            continue
        t, n, a, b, wide, size = owners[u]
        whole = confirmed and any(len(own & g) >= WHOLE * len(g) for g in _TEMPLATE_GRAMS[name])
        hit = _Hit(a, b, wide, confirmed, sure if confirmed else float(1 - p[u, -1]), name if confirmed else UNKNOWN, whole)
        hits.setdefault((t, n, size), []).append(hit)
    starts: dict[int, tuple[list[str], list[int]]] = {}
    for (t, n, size), found in sorted(hits.items()):
        if t not in starts:
            lines = texts[t].split("\n")
            starts[t] = lines, [0, *accumulate(len(x) + 1 for x in lines)]
        lines, begins = starts[t]
        places = _word_places(lines[n])
        for h in _notices(found):
            line_whole = h.first == 0 and h.last == size <= WINDOW_WORDS
            start, stop = (0, len(lines[n])) if line_whole else (places[h.first][0], places[h.last - 1][1])
            out[t].append({"family": h.family, "start": begins[n] + start, "stop": begins[n] + stop, "probability": round(h.sure, 6)})
    return out


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of whole texts that hold a word, longer ones in windows of ``WINDOW_WORDS`` words."""
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found = []
            for line in text.split("\n"):
                words = line.encode().split()
                parts = [words[i : i + WINDOW_WORDS] for i in range(0, len(words), WINDOW_WORDS)]
                found += [line] if len(parts) == 1 else [b" ".join(p).decode() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["line"])


def background_lines(docs: DataFrame, id_col: str, text_col: str, n_docs: int, n_lines: int) -> list[bytes]:
    """Lines of the whole texts of the documents whose ids hash lowest, the ``n_lines`` different ones that hash lowest."""
    rows = common.two_columns(docs, id_col, text_col)
    ids = common.lowest(rows.select("id").distinct(), n_docs, "id")
    # an id may have many rows
    texts = common.lowest(rows.join(F.broadcast(ids), "id").withColumn("digest", common.text_digest(F.col("text"))), n_docs, "id", "digest")
    lines = common.lowest(cut(texts.select("text").mapInArrow(_windows, "line string").distinct()), n_lines, "line")
    return sorted(r["line"].encode() for r in lines.collect())


NOTICES = "array<struct<family: string, start: int, stop: int, probability: double>>"
_NOTICE_TYPE = pa.list_(
    pa.struct([("family", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())])
)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", background_docs: int = BACKGROUND_DOCS, n_lines: int = BACKGROUND_LINES
) -> DataFrame:
    """Per row of ``docs``: ``id`` and ``notices`` in the order of the text.

    The class of lines that are no notice is fitted on ``n_lines`` lines of ``background_docs`` documents, drawn by hash.
    """
    model = train(background_lines(docs, id_col, text_col, background_docs, n_lines))

    def of(texts: list[str]) -> dict[str, list]:
        return {"notices": judge_texts(model, texts)}

    rows = common.two_columns(docs, id_col, text_col)
    return rows.mapInArrow(common.per_text(of, {"notices": _NOTICE_TYPE}), f"id {common.id_type(docs, id_col)}, notices {NOTICES}")

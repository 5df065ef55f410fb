"""License scans: a trained paragraph classifier whose finds a template must confirm.

A paragraph is a line, or a run of lines that all hold words (so that hard-wrapped
texts are seen whole; comment marks are no words), or a stretch of 80 words (40
further on each time) of a longer one. Its words are runs of letters and digits, in lower case, digits
alike. Sparse 1- to 3-grams of words, hashed to slots, feed a multinomial
logistic regression over the licence families and an ``unknown`` class; only
n-grams of licence texts have weights. A family's probability must reach a
threshold calibrated on held-out paragraphs, and the paragraph must hold a
large enough share of the n-grams of one of the family's templates. Of several
families the most alike is taken, and what its template explains is set aside
before the rest is asked again. A run of lines does not repeat a family that one
of its lines gives.

Training uses the templates in many variants, and as unknown paragraphs a
bounded sample of the documents' own and mixtures of licence words.

Defined results: null, empty or wordless texts have no finds; rows with a null
id keep it; repeated rows each give their finds; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.text import LOWER, chunks, sequence_hashes, word_hashes, words

#: What the families' licence texts and notices say.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT license",
        "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
        "License: MIT",
        "The MIT License (MIT)",
        "Distributed under the MIT license",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise",
        "MIT License",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "This software is released under the Apache License 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "SPDX-License-Identifier: Apache-2.0",
        "License: Apache-2.0",
        "Apache License Version 2.0, January 2004",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements",
        "Distributed under the Apache 2.0 license",
        "Apache License 2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "Released under the GNU GPL version 2 or later",
        "Licensed under the GPL",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "License: GPL-3.0",
        "GNU General Public License version 3",
        "GNU General Public License v3.0 (GPLv3)",
        "Licensed under the GNU GPL v3",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details",
        "Licensed under the GNU General Public License",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 3",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "License: LGPL-3.0",
        "GNU Lesser General Public License version 2.1",
        "Licensed under the LGPL",
        "GNU Lesser General Public License",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "License: AGPL-3.0",
        "GNU Affero General Public License version 3",
        "Licensed under the AGPL",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "License: BSD-2-Clause",
        "Licensed under the BSD 2-Clause License",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "BSD-style license",
        "BSD License",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "License: MPL-2.0",
        "Mozilla Public License Version 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
        "License: CC BY 4.0",
        "Creative Commons Attribution 4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "License: CC BY-SA 4.0",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "License: CC BY-NC 4.0",
    ],
    "CC0": [
        "Dedicated to the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "SPDX-License-Identifier: CC0-1.0",
        "License: CC0-1.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
        "License: Unlicense",
        "Released under the Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ],
    "ISC": [
        "SPDX-License-Identifier: ISC",
        "License: ISC",
        "ISC License",
        "Licensed under the ISC license",
        "Released under the ISC license",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "EPL": [
        "SPDX-License-Identifier: EPL-2.0",
        "License: EPL-2.0",
        "Eclipse Public License version 2.0",
        "Licensed under the Eclipse Public License",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
        "Eclipse Public License",
    ],
    "Boost": [
        "SPDX-License-Identifier: BSL-1.0",
        "License: BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0",
        "Licensed under the Boost Software License",
    ],
    "Zlib": [
        "SPDX-License-Identifier: Zlib",
        "License: Zlib",
        "Licensed under the zlib license",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software",
    ],
    "proprietary": [
        "All rights reserved",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher",
    ],
}
FAMILIES = [*TEMPLATES]

SLOTS = 1 << 18
GRAMS = (1, 2, 3)
STRETCH, STEP = 80, 40
#: Least share of a template's n-grams that a find must hold.
CONFIRM = 0.7
#: Least share of right finds above the threshold among held-out paragraphs.
PRECISION = 0.98
#: Documents of the training sample, characters of each from a place drawn in it, and paragraphs, at most.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_PARAGRAPHS = 400, 20_000, 4_000
VARIANTS = 24

_PARTS = np.ones(256, bool)
_PARTS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_ALIKE = LOWER.copy()
_ALIKE[48:58] = 48

FINDS = ("doc_id long, paragraph int, first_word int, family string, probability double, "
         "template int, similarity double")


def _paragraphs(text: str) -> list[str]:
    """Lines of a text and runs of several lines, longer ones in overlapping stretches."""
    lines = text.split("\n")
    runs, run = [], []
    for line in [*lines, ""]:
        if any(c.isalnum() or c > "\x7f" for c in line):
            run.append(line)
            continue
        if len(run) > 1:
            runs.append(" ".join(run))
        run = []
    out = []
    for paragraph in lines + runs:
        parts = paragraph.split()
        out += [" ".join(parts[k:k + STRETCH]) for k in range(0, max(1, len(parts) - STEP), STEP)] if parts else []
    return out


def _slots(hashed: np.ndarray, n: int) -> np.ndarray:
    return (sequence_hashes(hashed, n) >> np.uint64(64 - 18)).astype(np.int64)


def grams_of(text: str) -> list[int]:
    """Slots of all n-grams of one paragraph."""
    data = _ALIKE[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = words(data, np.array([0, len(data)]), _PARTS)
    hashed = word_hashes(data, starts, ends)
    return [int(s) for n in GRAMS if len(hashed) >= n for s in _slots(hashed, n)]


@dataclass
class LicenseModel:
    #: for each slot the row of its weights, 0 where it has none
    row_of: np.ndarray
    #: weights by row and class (families in order, then unknown); row 0 is zero
    weights: np.ndarray
    bias: np.ndarray
    threshold: float
    templates: list[list[frozenset[int]]]


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _against_unknown(chance: np.ndarray) -> np.ndarray:
    """Each family's probability where it or the unknown class is the only choice."""
    return chance[:, :-1] / (chance[:, :-1] + chance[:, -1:] + 1e-300)


class _Sparse:
    """Counts of known n-grams, a row a text, with products by rows and by columns."""

    def __init__(self, texts: list[dict[int, int]], columns: int) -> None:
        self.shape = (len(texts), columns)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        column = np.array([c for t in texts for c in t], np.int64)
        value = np.array([n for t in texts for n in t.values()], np.float64)
        self._by_row = self._cut(row, column, value)
        order = np.argsort(column, kind="stable")
        self._by_column = self._cut(column[order], row[order], value[order])

    @staticmethod
    def _cut(key: np.ndarray, other: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, ...]:
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))[:len(key)]
        return key[starts], starts, other, value[:, None]

    def _product(self, cut: tuple[np.ndarray, ...], size: int, dense: np.ndarray) -> np.ndarray:
        keys, starts, other, value = cut
        out = np.zeros((size, dense.shape[1]))
        if len(keys):
            out[keys] = np.add.reduceat(dense[other] * value, starts)
        return out

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return self._product(self._by_row, self.shape[0], dense)

    def transposed_dot(self, dense: np.ndarray) -> np.ndarray:
        return self._product(self._by_column, self.shape[1], dense)


def _fit(texts: list[dict[int, int]], labels: list[int], columns: int, classes: int, steps: int = 300,
         rate: float = 0.5, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by gradient steps with momentum; equal texts of a class count as one
    row of more weight."""
    seen: dict[tuple, int] = {}
    for text, label in zip(texts, labels):
        key = (label, tuple(sorted(text.items())))
        seen[key] = seen.get(key, 0) + 1
    label, times = np.array([k for k, _ in seen]), np.array([*seen.values()], np.float64)
    share = np.bincount(label, times, minlength=classes)[label]
    weight = times / np.maximum(1, share) / classes
    target = np.eye(classes)[label]
    rows = _Sparse([dict(t) for _, t in seen], columns)
    w, b = np.zeros((columns, classes)), np.zeros(classes)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        gap = (_softmax(rows.dot(w) + b) - target) * weight[:, None]
        vw = 0.9 * vw - rate * (rows.transposed_dot(gap) + decay * w)
        vb = 0.9 * vb - rate * gap.sum(axis=0)
        w, b = w + vw, b + vb
    return w, b


def similarity(found: frozenset[int] | set[int], template: frozenset[int]) -> float:
    return len(template & found) / max(1, len(template))


def fit_licenses(paragraphs: list[str]) -> LicenseModel:
    """The classifier, from the templates and unlabelled paragraphs."""
    rng = random.Random(3)
    templates = [[frozenset(grams_of(t)) for t in TEMPLATES[f]] for f in FAMILIES]
    every = [t for own in templates for t in own]
    plain = [p for p, found in ((p, frozenset(grams_of(p))) for p in paragraphs)
             if not any(similarity(found, t) >= 0.5 for t in every)]
    spare = [w for p in plain[:500] for w in p.split()] or ["the", "of", "and", "to", "a", "in"]
    texts, labels = [], []
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            for v in range(VARIANTS):
                own = template.split()
                if v % 3 == 2 and len(own) > 8:
                    own = [w for w in own if rng.random() > 0.08]
                before = rng.sample(spare, min(len(spare), rng.choice([0, 0, 2, 8])))
                after = rng.sample(spare, min(len(spare), rng.choice([0, 0, 2, 8])))
                texts.append(" ".join(before + own + after))
                labels.append(k)
    vocabulary = [w for own in TEMPLATES.values() for t in own for w in t.split()]
    mixed = [" ".join(rng.choices(vocabulary if rng.random() < 0.3 else spare, k=1)[0]
                      for _ in range(rng.randint(3, 20))) for _ in range(300)]
    texts += plain + mixed
    labels += [len(FAMILIES)] * (len(plain) + len(mixed))

    known = sorted(frozenset().union(*every))
    row_of = np.zeros(SLOTS, np.int32)
    row_of[known] = np.arange(1, len(known) + 1)
    rows = []
    for text in texts:
        found = row_of[grams_of(text)]
        rows.append(dict(zip(*(x.tolist() for x in np.unique(found[found > 0], return_counts=True)))))
    labels = np.array(labels)
    held = np.arange(len(texts)) % 4 == 0
    w, b = _fit([rows[k] for k in np.flatnonzero(~held)], labels[~held].tolist(), len(known) + 1, len(FAMILIES) + 1)
    chance = _softmax(_Sparse([rows[k] for k in np.flatnonzero(held)], len(known) + 1).dot(w) + b)
    best = chance[:, :-1].argmax(axis=1)
    score = _against_unknown(chance)[np.arange(len(best)), best]
    order = np.argsort(-score, kind="stable")
    right = np.cumsum((best == labels[held])[order]) >= PRECISION * np.arange(1, len(order) + 1)
    threshold = float(score[order][np.flatnonzero(right)[-1]]) if right.any() else 1.0
    return LicenseModel(row_of, w, b, max(0.5, threshold), templates)


def train_licenses(docs: DataFrame) -> LicenseModel:
    """Trained on paragraphs of at most SAMPLE_DOCS documents, of any length."""
    parts = 1 << 30
    share = int(parts * min(1.0, 4 * SAMPLE_DOCS / max(1, docs.count())))
    spare = F.char_length("text") - SAMPLE_CHARS
    start = F.when(spare > 0, F.pmod(F.xxhash64("text"), spare) + 1).otherwise(1).cast("int")
    part = F.substr("text", start, F.lit(SAMPLE_CHARS)).alias("text")
    sample = (docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share) & F.col("text").isNotNull())
              .select("doc_id", part).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))
    found = [p for r in sample.collect() for p in _paragraphs(r.text)]
    random.Random(5).shuffle(found)
    return fit_licenses(found[:SAMPLE_PARAGRAPHS])


def _stretches(data: np.ndarray, starts: np.ndarray, first: np.ndarray,
               runs: bool = False) -> tuple[np.ndarray, ...]:
    """(row, line, first word in the row, begin, end) of every paragraph, in words of the chunk.

    Paragraphs are lines, or with ``runs`` the runs of more than one line that all hold words.
    """
    line_of = np.searchsorted(np.flatnonzero(data == 10), starts)
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    step_to = np.diff(line_of)
    fresh = np.append(True, ((step_to > 1) if runs else (step_to > 0)) | (row_of[1:] != row_of[:-1]))
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, len(starts)))
    if runs:
        several = line_of[begin] < line_of[begin + size - 1]
        begin, size = begin[several], size[several]
    # a paragraph of more than STRETCH words becomes several stretches
    count = np.maximum(1, -(-(size - STEP) // STEP))
    which = np.repeat(np.arange(len(begin)), count)
    step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    a = begin[which] + STEP * step
    b = np.minimum(a + STRETCH, (begin + size)[which])
    row = row_of[begin][which]
    return row, line_of[a] if runs else line_of[begin][which], a - first[row], a, b


def _families(m: LicenseModel, own: np.ndarray) -> Iterator[tuple[int, float, int, float]]:
    """(family, probability, template, similarity) of every family that the words of a paragraph hold."""
    grams = [(n, _slots(own, n)) for n in GRAMS if len(own) >= n]
    free, given = np.ones(len(own), bool), set()
    while True:
        # the n-grams of words that no family found so far explains
        left = [s[np.lib.stride_tricks.sliding_window_view(free, n).all(axis=1)] for n, s in grams]
        score = m.bias + m.weights[m.row_of[np.concatenate(left)]].sum(axis=0)
        chance = _against_unknown(_softmax(score[None]))[0]
        found = {int(x) for s in left for x in s}
        best = max(((similarity(found, t), chance[k], -k, -i) for k in np.flatnonzero(chance >= m.threshold)
                    for i, t in enumerate(m.templates[k])), default=(0.0,))
        if best[0] < CONFIRM:
            return
        alike, probability, k, top = best[0], best[1], int(-best[2]), -best[3]
        if k not in given:
            yield k, float(probability), top, alike
        given.add(k)
        before = free.copy()
        for n, s in grams:
            if n == GRAMS[-1]:  # shorter ones are shared by many notices
                for at in np.flatnonzero(np.isin(s, list(m.templates[k][top]))):
                    free[at:at + n] = False
        if (free == before).all():
            return


def _likely(m: LicenseModel, hashed: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which stretches of words some family is likely for."""
    scores = np.tile(m.bias, (len(a), 1))
    for n in GRAMS:
        weight_row = m.row_of[_slots(hashed, n)] if len(hashed) >= n else np.zeros(0, np.int32)
        at = np.flatnonzero(weight_row)
        # stretches overlap: a word lies in at most two of them
        last = np.searchsorted(a, at, "right") - 1
        for back in (0, 1):
            owner = last - back
            inside = owner >= 0
            inside[inside] = at[inside] + n <= b[owner[inside]]
            for c in range(scores.shape[1]):
                scores[:, c] += np.bincount(owner[inside], m.weights[weight_row[at[inside]], c], minlength=len(a))
    return (_against_unknown(_softmax(scores)) >= m.threshold).any(axis=1)


def _scan(model: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [c.split()[0] for c in FINDS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part, data, offs in chunks(batch, "text"):
                plain = _ALIKE[data]
                starts, ends, first = words(plain, offs, _PARTS)
                if not len(starts):
                    continue
                hashed = word_hashes(plain, starts, ends)
                lines_before = np.searchsorted(np.flatnonzero(data == 10), offs[:-1])
                rows, given = [], []
                for runs in (False, True):
                    row, line, place, a, b = _stretches(data, starts, first, runs)
                    earlier = [*given]
                    for k in np.flatnonzero(_likely(m, hashed, a, b)):
                        for family, probability, top, alike in _families(m, hashed[a[k]:b[k]]):
                            if any(f == family and x < b[k] and y > a[k] for f, x, y in earlier if runs):
                                continue
                            given.append((family, a[k], b[k]))
                            rows.append((part.column(0)[int(row[k])].as_py(), int(line[k] - lines_before[row[k]]),
                                         int(place[k]), FAMILIES[family], round(probability, 4), top,
                                         round(alike, 4)))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


def license_finds(spark: SparkSession, docs: DataFrame, model: LicenseModel) -> DataFrame:
    """One row for each paragraph that is a licence notice or text.

    paragraph is the line, from 0, where the paragraph or its stretch begins, first_word
    its first word in the document; template is the number of the most similar template.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan(spark.sparkContext.broadcast(model)), FINDS)

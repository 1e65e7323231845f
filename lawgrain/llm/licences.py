"""Licence scans: a trained paragraph classifier whose predictions templates confirm.

A paragraph is a line, or else a line joined with the next ones while they do not end a
sentence (joined lines count where none of them is a licence by itself), or else a window
inside a line: lines longer than a window are tiled twice, half a window apart, so a notice
of up to half a window stands whole in one, whatever runs on around it. A window counts only
where a template confirms it, and is cut to what it shares with that. Its word
bigrams and trigrams are hashed into a sparse logistic regression over licence families
and "unknown", trained on altered copies of the templates against paragraphs of a
bounded sample of documents and sentences that only speak of licences. A temperature,
fitted on held-out examples, calibrates the probabilities, that of unknown included.
A predicted family is confirmed if the paragraph and one of its templates share at
least `min_similarity` of the five-word shingles of the shorter.

Defined results: NULL or empty texts have no paragraphs; a repeated row gives repeated
results; of windows that overlap the longest match counts, then the more probable, then the
first; other columns are ignored; an empty table gives no rows. Offsets count code points, ends excluded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawgrain.llm.samples import least_distinct
from lawgrain.llm.texts import Texts, Words, mix, slices

# Notices and opening paragraphs of common licences (fixed texts).
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}

# Sentences about licences that are none.
UNLICENSED = (
    "He lost his driving license last year and has to apply for a new one.",
    "A license is required to sell food in the city.",
    "The license of the restaurant was renewed by the general public office.",
    "Please read the license before you install the program.",
    "All rights reserved. No part of this work may be copied without permission.",
    "She studied which version of the license the project should choose.",
    "The general public was not admitted to the source of the river.",
    "Permission to enter the building is granted to any person with a pass.",
)


@dataclass(frozen=True)
class LicenceParams:
    buckets: int = 1 << 18
    sample_docs: int = 300  # documents whose paragraphs serve as unknown examples
    sample_lines: int = 3000  # of their lines and pieces of lines
    piece_words: int = 24  # longer lines are cut into pieces of so many words,
    piece_chars: int = 400  # each of so many characters at most
    windows: tuple[int, ...] = (12, 24)  # words looked at together inside longer lines
    copies: int = 40  # altered copies of each template
    epochs: int = 250
    min_probability: float = 0.5
    shingle: int = 5
    min_similarity: float = 0.8


_END = np.zeros(256, bool)
_END[[ord(c) for c in ".:;!?"]] = True


def paragraph_of(words: Words, joined: bool) -> np.ndarray:
    """A number for each word that changes with its line, or joined lines, and its text."""
    if not len(words):
        return np.zeros(0, np.int64)
    newline = words.data == 10
    lines = np.concatenate(([0], np.cumsum(newline)))[words.start]
    full = np.concatenate(([0], np.cumsum(_END[words.data])))
    step = np.diff(lines)
    gap_ends = full[words.start[1:]] > full[words.end[:-1]]
    new = ((step > 0) & (gap_ends | (not joined))) | (step > 1) | (np.diff(words.text_of()) > 0)
    return np.concatenate(([0], np.cumsum(new)))


def grams(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of each n-gram that lies within one owner."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(size, n, np.uint64)
    for k in range(n):
        total = total * np.uint64(0xA0761D6478BD642F) + hashes[k : k + size]
    whole = np.flatnonzero(owner[:size] == owner[n - 1 :])
    return mix(total[whole]), owner[whole]


def _features(hashes: np.ndarray, owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, owner and value of each bigram and trigram.

    The values of an owner sum to the same whatever its length, so that a long text
    does not look like a licence by the number of its common phrases.
    """
    parts = [grams(hashes, owner, k) for k in (2, 3)]
    bucket = np.concatenate([p[0] for p in parts]) & np.uint64(buckets - 1)
    who = np.concatenate([p[1] for p in parts])
    total = np.bincount(who) if len(who) else np.zeros(1)
    return bucket, who, 20.0 / total[who] if len(who) else np.zeros(0)


def windows_of(lines: np.ndarray, width: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of lines longer than `width`, and a number that changes with each window there.

    A line is tiled from its first word, the first window shorter by `shift`.
    """
    sizes = np.bincount(lines) if len(lines) else np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    words = np.flatnonzero(sizes[lines] > width) if len(lines) else np.zeros(0, np.int64)
    tile = (words - first[lines[words]] + shift) // width
    new = (np.diff(lines[words]) != 0) | (np.diff(tile) != 0)
    return words, np.concatenate(([0], np.cumsum(new))) if len(words) else words


class Template:
    def __init__(self, text: str, shingle: int):
        words = Texts.of([text]).tokens()
        self.shingles = shingle_set(words.hashes(), shingle)


def shingle_set(hashes: np.ndarray, n: int) -> frozenset[int]:
    """Shingle hashes of a word sequence; the whole sequence where it is shorter."""
    found, _ = grams(hashes, np.zeros(len(hashes), np.int64), min(n, max(1, len(hashes))))
    return frozenset(found.tolist())


@dataclass
class Model:
    families: tuple[str, ...]
    weight: np.ndarray  # buckets x (families + unknown)
    used: np.ndarray  # buckets with a weight
    bias: np.ndarray
    temperature: float
    templates: list[tuple[int, frozenset[int]]]

    def predict(self, hashes: np.ndarray, owner: np.ndarray, least: float) -> list[tuple[int, int, int, float]]:
        """(first word, end, family, probability) of the paragraphs of a family."""
        found, score = self.logits(hashes, owner)
        if not len(found):
            return []
        p = self.probabilities(score)
        best, sure = p.argmax(axis=1), p.max(axis=1)
        hit = np.flatnonzero((best < len(self.families) - 1) & (sure >= least))
        first = np.searchsorted(owner, found[hit], "left")
        end = np.searchsorted(owner, found[hit], "right")
        return list(zip(first.tolist(), end.tolist(), best[hit].tolist(), sure[hit].tolist()))

    def logits(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paragraphs with any known n-gram, and their scores."""
        bucket, who, value = _features(hashes, owner, len(self.used))
        known = self.used[bucket]
        bucket, who, value = bucket[known], who[known], value[known]
        found, place = np.unique(who, return_inverse=True)
        score = np.zeros((len(found), len(self.bias)))
        np.add.at(score, place, self.weight[bucket] * value[:, None])
        return found, score / self.temperature + self.bias

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def matched(self, family: int, hashes: np.ndarray, shingle: int) -> tuple[int, int] | None:
        """First word and end of what a word sequence shares with a template of a family."""
        best = None
        for k, template in self.templates:
            # a template shorter than a shingle is one whole
            for n in range(1, shingle + 1) if k == family and len(template) == 1 else (shingle,):
                if k == family and len(hashes) >= n:
                    found, _ = grams(hashes, np.zeros(len(hashes), np.int64), n)
                    at = np.flatnonzero(np.isin(found, np.array(list(template), np.uint64)))
                    if len(at) and (best is None or at[-1] + n - at[0] > best[1] - best[0]):
                        best = int(at[0]), int(at[-1]) + n
        return best

    def similarity(self, family: int, hashes: np.ndarray, shingle: int) -> float:
        """Greatest share of the shorter side's shingles that both have."""
        best = 0.0
        for k, template in self.templates:
            if k == family:
                own = shingle_set(hashes, shingle)
                best = max(best, len(own & template) / max(1, min(len(own), len(template))))
        return best


def _examples(params: LicenceParams, unknown: list[str]) -> tuple[list[str], np.ndarray]:
    """Altered copies of the templates and unknown paragraphs, with family numbers."""
    rng = np.random.default_rng(7)
    texts, labels = [], []
    filler = " ".join(unknown[:200]).split() or ["text"]
    for k, templates in enumerate(TEMPLATES.values()):
        for template in templates:
            words = template.split()
            texts.append(template)
            labels.append(k)
            for _ in range(params.copies):
                keep = [w for w in words if rng.random() > 0.08]
                if len(words) > 16 and rng.random() < 0.5:
                    cut = int(rng.integers(0, len(words) // 2))
                    keep = words[cut : cut + int(rng.integers(12, len(words)))]
                if rng.random() < 0.5:
                    at = int(rng.integers(0, len(filler)))
                    keep = [*filler[at : at + 3], *keep]
                texts.append(" ".join(keep))
                labels.append(k)
    for text in (*UNLICENSED * 10, *unknown):
        texts.append(text)
        labels.append(len(TEMPLATES))
    return texts, np.array(labels)


def train(unknown: list[str], params: LicenceParams) -> Model:
    """Softmax regression by full gradients; temperature from every fifth example."""
    templates = [
        (k, Template(t, params.shingle).shingles) for k, ts in enumerate(TEMPLATES.values()) for t in ts
    ]
    width = len(TEMPLATES) + 1
    model = Model((*TEMPLATES, "unknown"), np.zeros((0, width)), np.zeros(0, bool), np.zeros(width), 1.0, templates)

    def is_licence(text: str) -> bool:
        own = shingle_set(Texts.of([text]).tokens().hashes(), params.shingle)
        return any(len(own & t) >= params.min_similarity * min(len(own), len(t)) for _, t in templates)

    texts, labels = _examples(params, [u for u in unknown if not is_licence(u)])
    words = Texts.of(texts).tokens()
    hashes, owner = words.hashes(), words.text_of()
    bucket, who, value = _features(hashes, owner, params.buckets)
    # only n-grams of altered templates can speak for a family
    used = np.zeros(params.buckets, bool)
    used[bucket[labels[who] < width - 1]] = True
    bucket, who, value = (x[used[bucket]] for x in (bucket, who, value[:, None]))
    features, column = np.unique(bucket, return_inverse=True)
    held = np.arange(len(texts)) % 5 == 4
    target = np.eye(width)[labels]
    share = np.where(held, 0.0, 1.0)
    # families and unknown weigh alike, however many examples each has
    share /= np.bincount(labels, share, width)[labels] * width
    weight, bias = np.zeros((len(features), width)), np.zeros(width)
    speed = np.zeros_like(weight)

    def scores() -> np.ndarray:
        z = np.zeros((len(texts), width))
        np.add.at(z, who, weight[column] * value)
        return z

    for _ in range(params.epochs):
        p = model.probabilities(scores() + bias)
        error = (p - target) * share[:, None]
        gradient = np.zeros_like(weight)
        np.add.at(gradient, column, error[who] * value)
        speed = 0.9 * speed + gradient + 1e-5 * weight
        weight -= 1.0 * speed
        bias -= 1.0 * error.sum(axis=0)
    z = scores()

    def loss(t: float) -> float:
        p = model.probabilities(z[held] / t + bias)
        return -np.log(p[np.arange(len(p)), labels[held]] + 1e-12).mean()

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    model.weight = np.zeros((params.buckets, width), np.float32)
    model.weight[features] = weight
    model.used, model.bias = used, bias
    return model


def unknown_paragraphs(docs: DataFrame, params: LicenceParams, text_col: str) -> list[str]:
    """Lines, long ones in pieces, from anywhere in some documents.

    The documents are the `sample_docs` distinct texts that hash lowest, and the lines the
    `sample_lines` distinct ones that hash lowest in their whole texts.
    """
    texts = docs.select(docs[text_col].cast("string").alias("text")).where("text IS NOT NULL")
    sample = least_distinct(texts, F.col("text"), params.sample_docs)
    split_lines = sample.select(F.explode(F.split("text", "\n")).alias("line"))
    words = F.split("line", " ").alias("words")
    size = F.lit(params.piece_words)
    starts = F.sequence(F.lit(1), F.size("words"), size)
    pieces = F.transform(starts, lambda at: F.substring(F.array_join(F.slice("words", at, size), " "), 1, params.piece_chars))
    lines = split_lines.select(words).select(F.explode(pieces).alias("line")).where(F.trim("line") != "")
    return [r["line"] for r in least_distinct(lines, F.col("line"), params.sample_lines).collect()]


_SCHEMA = (
    "doc_id long, line long, start long, end long, family string, probability double, similarity double, confirmed boolean"
)


def scan_licences(
    docs: DataFrame, params: LicenceParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per paragraph that is predicted to belong to a licence family."""
    params = params or LicenceParams()
    shared = docs.sparkSession.sparkContext.broadcast(train(unknown_paragraphs(docs, params, text_col), params))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = texts.tokens()
                if not len(words):
                    continue
                hashes, text = words.hashes(), words.text_of()
                lines = paragraph_of(words, False)
                taken = np.zeros(len(words), bool)
                hits = []
                for owner in (lines, paragraph_of(words, True)):
                    for a, b, family, p in model.predict(hashes, owner, params.min_probability):
                        if not taken[a:b].any():
                            taken[a:b] = True
                            hits.append((a, b, family, p))
                inside = []
                for width in params.windows:
                    for shift in (0, width // 2):
                        some, owner = windows_of(lines, width, shift)
                        for a, b, family, p in model.predict(hashes[some], owner, params.min_probability):
                            a, b = int(some[a]), int(some[b - 1]) + 1
                            if taken[a:b].any():
                                continue
                            # what stands half in the window is matched whole
                            line = np.searchsorted(lines, lines[a], "left"), np.searchsorted(lines, lines[a], "right")
                            a, b = max(a - width, int(line[0])), min(b + width, int(line[1]))
                            part_of = model.matched(family, hashes[a:b], params.shingle)
                            if part_of is not None:
                                a, b = a + part_of[0], a + part_of[1]
                                like = model.similarity(family, hashes[a:b], params.shingle)
                                if like >= params.min_similarity:
                                    inside.append((b - a, p, -a, a, b, family))
                for _, p, _, a, b, family in sorted(inside, reverse=True):  # longest first
                    if not taken[a:b].any():
                        taken[a:b] = True
                        hits.append((a, b, family, p))
                if not hits:
                    continue
                points = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
                out = []
                for a, b, family, p in sorted(hits):
                    t = text[a]
                    base = points[texts.offsets[t]]
                    like = model.similarity(family, hashes[a:b], params.shingle)
                    out.append(
                        (
                            part.column(0)[int(t)].as_py(),
                            int(lines[a] - lines[words.first_word[t]]),
                            int(points[words.start[a]] - base),
                            int(points[words.end[b - 1]] - base),
                            model.families[family],
                            p,
                            like,
                            like >= params.min_similarity,
                        )
                    )
                types = [pa.int64()] * 4 + [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), types)],
                    names=[c.split()[0] for c in _SCHEMA.split(", ")],
                )

    return rows.mapInArrow(run, _SCHEMA)

"""Licence scans: a trained paragraph classifier whose findings templates confirm.

Paragraphs are the lines of a text, and runs of short lines (wrapped text) joined. A sparse logistic
regression over hashed word uni- and bigrams gives each paragraph a family, or none. It is trained
here on the templates (whole, cut, with words lost or foreign words around) against paragraphs of
the corpus (a bounded sample, `SAMPLE_DOCS` documents are expected) and shuffled template words. Probabilities are
calibrated by a temperature on held-out examples, and so are the bounds from which a paragraph is
licence-like and from which its family counts; in between it is `unknown`. A family is reported only if the paragraph shares enough word pairs with
one of the family's templates; otherwise a licence-like paragraph is `unknown` as well.

Defined results: null, empty and blank texts have no licences; repeated rows are scanned each; every
document gives a row; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import WordCache, by_batch, keyed_text, with_fields

NONE, UNKNOWN = "none", "unknown"
# Notices of public licences: fixed values.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for full license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
}
# Fixed values end.
FEATURES = 1 << 15
SAMPLE_DOCS = 400
SAMPLE_PARAGRAPHS = 4000
EXAMPLES = 60
WRAPPED = 100
SHARED_PAIRS = 0.6
AT_ONCE = 200_000
_EDGES = ".,;:()[]{}\"'`*#<>|!?/\\"


def _word_hashes(words: list[str]) -> list[int]:
    """Hashes without punctuation at the ends; 0 for words that are punctuation only."""
    stripped = [w.strip(_EDGES) for w in words]
    return [(xxhash.xxh64_intdigest(w.encode()) >> 1) | 1 if w else 0 for w in stripped]


_WORDS = WordCache(_word_hashes)


def paragraphs(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the lines with text, and of runs of short lines."""
    spans, run = [], []
    for m in re.finditer(r"[^\n]+", text or ""):
        if not m.group().strip():
            run = _end_run(spans, run)
            continue
        spans.append(m.span())
        if run and m.start() != run[-1][1] + 1 or m.end() - m.start() > WRAPPED:
            run = _end_run(spans, run)
        if m.end() - m.start() <= WRAPPED:
            run.append(m.span())
    _end_run(spans, run)
    return sorted(spans)


def _end_run(spans: list, run: list) -> list:
    if len(run) > 1:
        spans.append((run[0][0], run[-1][1]))
    return []


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, words and then pairs of each, and where each text begins."""
    hashes = [_WORDS.values_of(t.lower().split()) for t in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    words = np.array([x for h in hashes for x in h], np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    real = words > 0
    words, owner = words[real], owner[real]
    with np.errstate(over="ignore"):
        pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    together = owner[1:] == owner[:-1]
    keys = np.concatenate((words, pairs[together]))
    owners = np.concatenate((owner, owner[1:][together]))
    order = np.argsort(owners, kind="stable")
    with np.errstate(over="ignore"):
        mixed = (keys[order] * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(64 - 15)
    return mixed.astype(np.int64), np.searchsorted(owners[order], np.arange(len(texts) + 1))


def _pairs(text: str) -> set[tuple[int, int]]:
    words = [h for h in _WORDS.values_of(text.lower().split()) if h]
    return set(zip(words, words[1:]))


_TEMPLATE_PAIRS = {family: [_pairs(t) for t in own] for family, own in TEMPLATES.items()}


def similarity(text: str, family: str) -> float:
    """Share of a template's word pairs in the paragraph or, for parts of a long notice, of the
    paragraph's pairs in the template; the best template counts."""
    own = _pairs(text)
    best = 0.0
    for template in _TEMPLATE_PAIRS[family]:
        both = len(own & template)
        best = max(best, both / len(template), both / len(own) if len(own) >= 6 else 0.0)
    return best


@dataclass
class Classifier:
    families: list[str]
    weights: np.ndarray  # (FEATURES, families)
    bias: np.ndarray
    temperature: float = 1.0
    likely: float = 0.5  # from here on a paragraph is licence-like
    sure: float = 0.5  # and from here on its family counts

    def logits(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sizes = np.diff(bounds)
        result = np.repeat(self.bias[None, :], len(sizes), axis=0)
        filled = np.nonzero(sizes)[0]
        at = 0
        while at < len(filled):
            # Whole paragraphs, about AT_ONCE features at a time.
            upto = max(at + 1, int(np.searchsorted(bounds[filled + 1], bounds[filled[at]] + AT_ONCE, "right")))
            chosen = filled[at:upto]
            low, high = bounds[chosen[0]], bounds[chosen[-1] + 1]
            sums = np.add.reduceat(self.weights[features[low:high]], bounds[chosen] - low, axis=0)
            result[chosen] += sums / np.sqrt(sizes[chosen])[:, None]
            at = upto
        return result

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return _softmax(self.logits(*_features(texts)) / self.temperature)

    def scan(self, texts: list[str | None]) -> list[list[dict]]:
        """Confirmed and unknown licences of each text."""
        spans = [(row, s, e) for row, t in enumerate(texts) for s, e in paragraphs(t)]
        found: list[list[dict]] = [[] for _ in texts]
        none = self.families.index(NONE)
        step = 20_000
        for at in range(0, len(spans), step):
            part = spans[at : at + step]
            shares = self.probabilities([texts[row][s:e] for row, s, e in part])
            best = np.delete(shares, none, axis=1).max(axis=1)
            for i in np.nonzero(best >= self.likely)[0].tolist():
                row, s, e = part[i]
                family, probability = self._verdict(shares[i], none)
                like = similarity(texts[row][s:e], family)
                if like < SHARED_PAIRS or probability < self.sure:
                    family = UNKNOWN
                found[row].append({"start": s, "end": e, "family": family, "probability": probability, "similarity": like})
        return [_without_repeats(own) for own in found]

    def _verdict(self, shares: np.ndarray, none: int) -> tuple[str, float]:
        order = np.argsort(-shares, kind="stable")
        best = order[0] if order[0] != none else order[1]
        return self.families[best], float(shares[best])


def _without_repeats(found: list[dict]) -> list[dict]:
    """Of lines and the wrapped paragraph around them, the lines if one has a family."""

    def inside(a: dict, b: dict) -> bool:
        return a is not b and b["start"] <= a["start"] and a["end"] <= b["end"]

    known = [x for x in found if x["family"] != UNKNOWN]
    kept = [x for x in found if not any(inside(y, x) for y in known)]
    return [x for x in kept if not any(inside(x, y) and y["family"] != UNKNOWN for y in kept)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(negatives: list[str], rng: np.random.Generator) -> tuple[list[str], list[str]]:
    foreign = " ".join(negatives).split() or ["word"]
    texts, labels = list(negatives), [NONE] * len(negatives)

    def around(n: int) -> list[str]:
        return [foreign[i] for i in rng.integers(0, len(foreign), n)]

    for family, templates in TEMPLATES.items():
        for template in templates:
            words = template.split()
            for _ in range(EXAMPLES):
                own = list(words)
                if len(own) > 14 and rng.random() < 0.5:
                    size = int(rng.integers(12, len(own) + 1))
                    first = int(rng.integers(0, len(own) - size + 1))
                    own = own[first : first + size]
                if rng.random() < 0.5:
                    own = [w for w in own if rng.random() > 0.08] or own
                if rng.random() < 0.5:
                    own = around(int(rng.integers(0, 9))) + own + around(int(rng.integers(0, 9)))
                texts.append(" ".join(own))
                labels.append(family)
            for _ in range(EXAMPLES // 6):
                mixed = [w for w in words if rng.random() < 0.5] + around(10)
                texts.append(" ".join(mixed[i] for i in rng.permutation(len(mixed))))
                labels.append(NONE)
    return texts, labels


def _train(texts: list[str], labels: list[str]) -> Classifier:
    """Softmax regression by Adagrad; one example in five is held out for calibration."""
    families = [NONE, *TEMPLATES]
    target = np.array([families.index(x) for x in labels])
    features, bounds = _features(texts)
    model = Classifier(families, np.zeros((FEATURES, len(families)), np.float32), np.zeros(len(families), np.float32))
    held = np.arange(len(texts)) % 5 == 4
    squares, bias_squares = np.full(model.weights.shape, 1e-4, np.float32), np.full(len(families), 1e-4, np.float32)
    rng = np.random.default_rng(11)
    for _ in range(6):
        for rows in np.array_split(rng.permutation(np.nonzero(~held)[0]), max(1, len(texts) // 64)):
            sizes = bounds[rows + 1] - bounds[rows]
            own = np.concatenate([features[bounds[r] : bounds[r + 1]] for r in rows.tolist()])
            ends = np.concatenate(([0], np.cumsum(sizes)))
            error = _softmax(model.logits(own, ends))
            error[np.arange(len(rows)), target[rows]] -= 1
            error /= len(rows)
            scaled = np.repeat(error / np.sqrt(np.maximum(sizes, 1))[:, None], sizes, axis=0)
            order = np.argsort(own, kind="stable")
            if len(own):
                distinct, first = np.unique(own[order], return_index=True)
                gradient = np.add.reduceat(scaled[order], first, axis=0) + 1e-5 * model.weights[distinct]
                squares[distinct] += gradient * gradient
                model.weights[distinct] -= 0.5 * gradient / np.sqrt(squares[distinct])
            total = error.sum(axis=0)
            bias_squares += total * total
            model.bias -= (0.1 * total / np.sqrt(bias_squares)).astype(np.float32)
    logits = model.logits(features, bounds)[held]
    answers = target[held]
    losses = []
    grid = np.geomspace(0.25, 8, 31)
    for t in grid:
        losses.append(-np.log(_softmax(logits / t)[np.arange(len(answers)), answers] + 1e-12).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    shares = _softmax(logits / model.temperature)
    best = shares.argmax(axis=1)
    family = shares[:, 1:].max(axis=1)
    none = family[answers == 0]
    model.likely = float(np.clip(np.quantile(none, 0.999), 0.5, 0.9)) if len(none) else 0.5
    for bound in np.linspace(0.5, 0.9, 9):
        taken = (best != 0) & (family >= bound)
        model.sure = float(bound)
        if (best[taken] == answers[taken]).mean() >= 0.98 if taken.any() else True:
            break
    return model


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> Classifier:
    read = keyed_text(docs, key, text).filter("text is not null")
    total = read.count()
    share = int(min(1.0, sample / max(1, total)) * (1 << 30))
    place = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(5)), F.lit(1 << 30))
    chosen = read.withColumn("place", place).filter(F.col("place") < share).select("place", F.explode(F.split("text", "\n")).alias("line"))
    lines = chosen.filter("trim(line) <> ''").orderBy(F.xxhash64("place", "line")).limit(SAMPLE_PARAGRAPHS)
    negatives = [r["line"] for r in lines.collect()]
    # Notices stand in the corpus too: what looks like a template is no counter-example.
    negatives = [t for t in negatives if all(similarity(t, f) < 0.3 for f in TEMPLATES)]
    return _train(*_examples(negatives, np.random.default_rng(3)))


def scan(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, licences (array of start, end, family, probability, similarity)."""
    read = keyed_text(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    item = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())]
    )

    def scanned(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.scan(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(item))], names=["key", "licences"])

    more = "licences array<struct<start: int, end: int, family: string, probability: double, similarity: double>>"
    return by_batch(read, scanned, with_fields(read, "key", more=more)).withColumnRenamed("key", key)

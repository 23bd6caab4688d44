"""License scans: a trained paragraph classifier whose predictions templates confirm.

A paragraph is a line of the text (a notice broken over lines is also tried as two
or three lines together).  Its features are the words and word pairs that the
notice templates have, and the share of its words that they do not have.  A
multinomial logistic regression over these sparse features knows the licence
families and "none".  It learns from the templates, varied by rule, and from a
bounded sample of corpus lines as "none" (``NONE_DOCUMENTS`` documents chosen by
hash, at most ``NONE_LINES`` lines).  Its probabilities are tempered on rows kept
apart, and the family threshold is set so that of the "none" rows kept apart at
most ``FALSE_ALARMS`` pass.

A predicted family is confirmed when one of its templates has ``CONFIRM`` of its
word pairs in the paragraph.  A paragraph that looks like a licence but is under
the threshold, or that no template confirms, is "unknown".  A paragraph with no
word pair of any template is "none".

Defined results: null text has no paragraphs; offsets count code points, ends are
exclusive; a null doc_id stays null; repeated rows give repeated results; an empty
table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole_text

NONE_DOCUMENTS = 400
NONE_LINES = 4000
VARIANTS = 24  # of each template
FALSE_ALARMS = 0.001
CONFIRM = 0.8
JOINED_LINES = 3
ROUNDS, RATE, RIDGE = 400, 2.0, 1e-4

# Usual notices by family (fixed values).
TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Distributed under the terms of the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v2 or later.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0.",
    ],
}
FAMILIES = [*TEMPLATES, "none"]
NONE = len(TEMPLATES)

_WORD = re.compile(r"[a-z0-9]+")


def line_words(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def _grams(words: list[str]) -> list[str]:
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


@dataclass
class Model:
    """Feature numbers, weights (features + oov share + bias, by family), threshold, template pairs."""

    features: dict[str, int]
    weights: np.ndarray
    threshold: float = 0.5
    pairs: dict[int, list[frozenset[tuple[str, str]]]] = field(default_factory=dict)

    def row(self, words: list[str]) -> tuple[list[int], float]:
        """Feature numbers present (each once) and the share of unknown words."""
        found = {self.features[g] for g in _grams(words) if g in self.features}
        outside = sum(w not in self.features for w in words)
        return sorted(found), outside / len(words) if words else 1.0

    def logits(self, words: list[str]) -> np.ndarray:
        found, outside = self.row(words)
        return self.weights[found].sum(axis=0) / np.sqrt(len(found) + 1) + outside * self.weights[-2] + self.weights[-1]

    def judge(self, line: str) -> tuple[str, float]:
        """(family, "unknown" or "none"; probability of a licence family)."""
        words = line_words(line)
        if not any(f"{a} {b}" in self.features for a, b in zip(words, words[1:])):
            return "none", 0.0
        z = self.logits(words)
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p[:NONE].argmax())
        if p[NONE] >= 0.5 and p[best] < self.threshold:
            return "none", float(1 - p[NONE])
        there = set(zip(words, words[1:]))
        same = max(len(t & there) / len(t) for t in self.pairs[best])
        sure = p[best] >= self.threshold and same >= CONFIRM
        return (FAMILIES[best] if sure else "unknown"), float(p[best])


def template_features() -> tuple[dict[str, int], dict[int, list[frozenset]]]:
    grams: dict[str, int] = {}
    pairs: dict[int, list[frozenset]] = {}
    for k, family in enumerate(TEMPLATES):
        for text in TEMPLATES[family]:
            words = line_words(text)
            for g in _grams(words):
                grams.setdefault(g, len(grams))
            pairs.setdefault(k, []).append(frozenset(zip(words, words[1:])))
    return grams, pairs


def _varied(words: list[str], rng: random.Random, filler: list[str]) -> list[str]:
    """A template with a few words lost and strange words around it."""
    kept = [w for w in words if rng.random() > 0.08] or words
    around = [rng.choice(filler) for _ in range(rng.randrange(0, 7))] if filler else []
    cut = rng.randrange(len(around) + 1)
    return [*around[:cut], *kept, *around[cut:]]


def train(none_lines: list[str]) -> Model:
    """Fit, temper and set the threshold; the same lines always give the same model."""
    rng = random.Random(5)
    features, pairs = template_features()
    model = Model(features, np.zeros((len(features) + 2, len(FAMILIES))), pairs=pairs)
    every = [t for family in pairs.values() for t in family]
    nones = []
    for line in none_lines:
        words = line_words(line)
        there = set(zip(words, words[1:]))
        if words and all(len(t & there) < 0.5 * len(t) for t in every):  # notices in the sample are not "none"
            nones.append(words)
    filler = sorted({w for words in nones for w in words if w not in features})[:5000]
    rows, label = list(nones), [NONE] * len(nones)
    common = sorted(w for w in features if " " not in w)
    for _ in range(200):  # loose licence words are no licence
        rows.append([rng.choice(common if rng.random() < 0.5 or not filler else filler) for _ in range(rng.randrange(3, 20))])
        label.append(NONE)
    for k, family in enumerate(TEMPLATES):
        for text in TEMPLATES[family]:
            for i in range(VARIANTS):
                rows.append(line_words(text) if i % 4 == 0 else _varied(line_words(text), rng, filler))
                label.append(k)
    x = np.zeros((len(rows), len(features) + 2), np.float32)
    for i, words in enumerate(rows):
        found, outside = model.row(words)
        x[i, found] = 1 / np.sqrt(len(found) + 1)
        x[i, -2:] = outside, 1
    y = np.array(label)
    apart = np.arange(len(rows)) % 5 == 0
    weight = (1 / np.bincount(y[~apart], minlength=len(FAMILIES)).clip(1))[y[~apart]]
    model.weights = _descend(x[~apart], y[~apart], weight / weight.sum()).astype(float)
    z, truth = x[apart] @ model.weights, y[apart]
    model.weights *= min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=lambda t: -_log_likelihood(t * z, truth))
    p = _softmax(x[apart] @ model.weights)
    alarms = np.sort(p[truth == NONE][:, :NONE].max(axis=1))[::-1] if (truth == NONE).any() else np.zeros(1)
    model.threshold = max(0.5, float(alarms[int(FALSE_ALARMS * len(alarms))]) + 1e-6)
    return model


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _log_likelihood(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).sum())


def _descend(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Accelerated gradient descent of the weighted logistic loss with a ridge."""
    truth = np.eye(len(FAMILIES), dtype=np.float32)[y]
    w = ahead = np.zeros((x.shape[1], len(FAMILIES)), np.float32)
    for i in range(ROUNDS):
        slope = x.T @ ((_softmax(x @ ahead) - truth) * weight[:, None]).astype(np.float32) + RIDGE * ahead
        new = ahead - RATE * slope
        ahead, w = new + i / (i + 3) * (new - w), new
    return w


def none_sample(texts: DataFrame) -> list[str]:
    """Lines of about ``NONE_DOCUMENTS`` documents chosen by hash, at most ``NONE_LINES``."""
    step = max(1, texts.count() // NONE_DOCUMENTS)
    lines = (
        texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
        .select(F.explode(F.split("text", "\n")).alias("line"))
        .where("length(line) BETWEEN 1 AND 2000")
        .distinct()
    )
    return [r.line for r in lines.orderBy(F.xxhash64("line"), "line").limit(NONE_LINES).collect()]


def text_licenses(text: str, model: Model) -> tuple[int, list[tuple[int, int, str, float]]]:
    """Number of paragraphs, and (start, end, family or "unknown", probability) of the licence-like ones."""
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, line))
        at += len(line) + 1
    found: list[tuple[int, int, str, float]] = []
    for i, (start, line) in enumerate(lines):
        if found and start < found[-1][1]:
            continue
        family, p = model.judge(line)
        end = start + len(line)
        if family == "unknown":
            for n in range(2, JOINED_LINES + 1):
                last = lines[i + n - 1 : i + n]
                if last:
                    joined, q = model.judge(" ".join(x for _, x in lines[i : i + n]))
                    if joined not in ("none", "unknown"):
                        family, p, end = joined, q, last[0][0] + len(last[0][1])
                        break
        if family != "none":
            found.append((start, end, family, p))
    return sum(bool(x.strip()) for _, x in lines), found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_paragraphs, n_licensed, n_unknown, families, spans, best_probability.

    ``families`` lists the confirmed families, sorted; ``spans`` is family:start:end of
    every licence-like paragraph in order.
    """
    texts = docs.select(docs[id_col].cast("bigint").alias("doc_id"), whole_text(docs, text_col).alias("text"))
    model = train(none_sample(texts))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [text_licenses(t, model) for t in b.column("text").to_pylist()]
            sure = [[f for f in found if f[2] != "unknown"] for _, found in out]
            columns = [
                b.column("doc_id"),
                pa.array([n for n, _ in out], pa.int64()),
                pa.array([len(s) for s in sure], pa.int64()),
                pa.array([len(found) - len(s) for (_, found), s in zip(out, sure)], pa.int64()),
                pa.array([",".join(sorted({f[2] for f in s})) for s in sure], pa.string()),
                pa.array([",".join(f"{f[2]}:{f[0]}:{f[1]}" for f in found) for _, found in out], pa.string()),
                pa.array([max((f[3] for f in found), default=0.0) for _, found in out], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, NAMES)

    return texts.mapInArrow(
        scan,
        "doc_id BIGINT, n_paragraphs BIGINT, n_licensed BIGINT, n_unknown BIGINT, families STRING, spans STRING, "
        "best_probability DOUBLE",
    )


NAMES = ["doc_id", "n_paragraphs", "n_licensed", "n_unknown", "families", "spans", "best_probability"]

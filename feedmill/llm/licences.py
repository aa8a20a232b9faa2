"""Licence scans by a trained paragraph classifier.

A text is cut into paragraphs at blank lines. Around each word that is a sign of a template,
the stretch that holds most of the template's words is a candidate, across line breaks.
Word n-grams of a stretch are hashed to a sparse vector; a multinomial logistic regression
gives the probability of every licence family and of none. It is trained on variations of
the families' template sentences against paragraphs drawn from the corpus. Probabilities
are calibrated on held-out variations and paragraphs by one temperature, and a stretch whose
best probability stays below the limit is unknown. A prediction counts only if the stretch
compares well with a template of that family, in words. A paragraph may state any number of
families.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedmill.llm.pieces import in_slices
from feedmill.llm.tables import text_of

# Sentences by which licences are stated, by SPDX family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License.",
        "AGPL",
        "AGPLv3",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License.",
        "Apache-2.0",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "BSD License.",
        "BSD-2-Clause",
        "BSD-3-Clause",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "CC-BY-NC-4.0",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "CC-BY-SA-4.0",
    ),
    "CC0": (
        "This work is dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "CC0",
        "Released into the public domain.",
        "Dedicated to the public domain.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "GNU General Public License.",
        "GPL",
        "GPLv2",
        "GPLv3",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "GNU Lesser General Public License.",
        "LGPL",
        "LGPLv2",
        "LGPLv2.1",
        "LGPLv3",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "MIT License.",
        "Licensed under MIT.",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License.",
        "MPL",
        "MPLv2",
        "MPLv2.0",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    ),
}
NONE = "none"
# Words of templates that any text has; none of them is a sign.
COMMON = frozenset(
    "a and any all as associated at author be binary by can charge compliance conditions copying copyright documentation except extent file files "
    "following for form forms foundation free general granted hereby in international into is it law library license licensed may met modification modify not "
    "obtaining of or permitted person possible program provided public published redistribute related released software source strictly subject "
    "terms that the this to under use v version with without work you code are has copy identifier".split())
# What variations of a template may begin with.
OPENINGS = ("", "This file is ", "The text is ", "This document is ", "Copyright 2020 The authors. ", "(c) 2019 Example Corp. ", "Note: ")
FEATURES = 1 << 15
# Paragraphs of the corpus that training takes at most, as examples of no licence.
SAMPLE_PARAGRAPHS = 4000
VARIATIONS = 120
# Least calibrated probability, and least share of a template's words, of an accepted family.
CERTAIN = 0.6
LIKENESS = 0.6
# Words of the corpus's paragraphs in an example. Findings of one family that are nearer are one.
WINDOW_WORDS = 32
_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
_BLANK = re.compile(r"\n[^A-Za-z0-9\n]*(?=\n)")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def signs_of(family: str, template: set[str], templates: dict[str, list[set[str]]]) -> set[str]:
    """The template's words, of those that not any text has, that the fewest other families use."""
    others = {w: sum(any(w in t for t in own) for name, own in templates.items() if name != family) for w in template - COMMON - set("0123456789")}
    return {w for w, n in others.items() if n == min(others.values()) and not re.fullmatch("[0-9.]+", w)}


def features(words: list[str], size: int = FEATURES) -> np.ndarray:
    """Sorted distinct buckets of the words, word pairs and word triples."""
    found = {zlib.crc32(" ".join(words[k:k + n]).encode()) % size for n in (1, 2, 3) for k in range(len(words) - n + 1)}
    return np.array(sorted(found), dtype=np.int64)


class LicenceModel:
    """Weights of the families (and of none), temperature, and the templates' words."""

    def __init__(self, families: list[str], size: int = FEATURES):
        self.families, self.size, self.temperature = families, size, 1.0
        self.weights = np.zeros((size, len(families)), dtype=np.float32)
        self.bias = np.zeros(len(families), dtype=np.float32)
        self.templates = {f: [set(words_of(t)) for t in TEMPLATES.get(f, ())] for f in families}
        # A stretch is looked at closely around a word that is a sign of a template.
        self.by_sign: dict[str, list[tuple[str, set[str]]]] = {}
        for family, own in self.templates.items():
            for template in own:
                for sign in signs_of(family, template, self.templates):
                    self.by_sign.setdefault(sign, []).append((family, template))
        self.signs = set(self.by_sign)

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.tile(self.bias, (len(rows), 1))
        for k, row in enumerate(rows):
            if len(row):
                out[k] += self.weights[row].sum(axis=0) / np.sqrt(len(row))
        return out

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        x = self.logits(rows) / self.temperature
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def train(self, rows: list[np.ndarray], truth: np.ndarray, epochs: int = 12, rate: float = 0.5, seed: int = 3) -> None:
        """Stochastic gradient descent with steps that shrink with a feature's use."""
        rng = np.random.default_rng(seed)
        used = np.full(self.size, 1e-3, dtype=np.float64)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                p = self.probabilities([rows[k]])[0]
                p[truth[k]] -= 1
                row = rows[k]
                if len(row):
                    scale = 1 / np.sqrt(len(row))
                    used[row] += (p * p).sum() * scale * scale
                    self.weights[row] -= (rate * scale / np.sqrt(used[row]))[:, None] * p[None, :] * 0.3
                self.bias -= 0.02 * p

    def calibrate(self, rows: list[np.ndarray], truth: np.ndarray) -> None:
        """The temperature with the least cross entropy on examples not trained on."""
        x = self.logits(rows)
        best = (np.inf, 1.0)
        for t in np.geomspace(0.2, 10, 60):
            y = x / t
            y = y - y.max(axis=1, keepdims=True)
            loss = float((np.log(np.exp(y).sum(axis=1)) - y[np.arange(len(truth)), truth]).mean())
            best = min(best, (loss, float(t)))
        self.temperature = best[1]

    def scan(self, text: str, certain: float = CERTAIN, likeness: float = LIKENESS) -> list[tuple[str, int, int, float, float]]:
        """family, start, end, probability and likeness of every statement of a licence."""
        out = []
        at = 0
        for blank in [*_BLANK.finditer(text), None]:
            start, end = at, blank.start() if blank else len(text)
            at = blank.end() if blank else end
            lower = text[start:end].lower()
            if any(sign in lower for sign in self.signs):
                out += self._statements(text, start, end, certain, likeness)
        return out

    def _statements(self, text: str, start: int, end: int, certain: float, likeness: float) -> list[tuple[str, int, int, float, float]]:
        """``scan`` of one paragraph."""
        places = [m.span() for m in _WORD.finditer(text, start, end)]
        words = [text[a:b].lower() for a, b in places]
        found: dict[tuple[int, int, str], tuple[int, float, float]] = {}
        known: dict[tuple[str, ...], np.ndarray] = {}
        for at, word in enumerate(words):
            for family, template in self.by_sign.get(word, ()):
                stretch = _stretch(words, at, template)
                own = template & set(words[stretch[0]:stretch[1]])
                # Of a short form no word may lack.
                if len(own) < (len(template) if len(template) < 5 else likeness * len(template)):
                    continue
                piece = tuple(words[stretch[0]:stretch[1]])
                if piece not in known:
                    known[piece] = self.probabilities([features(list(piece), self.size)])[0]
                k = int(known[piece].argmax())
                if self.families[k] == family and known[piece][k] >= certain:
                    found[(*stretch, family)] = max(found.get((*stretch, family), (0, 0.0, 0.0)), (len(own), len(own) / len(template), float(known[piece][k])))
        # Where stretches of two families overlap, the one with more words of its template stands.
        taken: list[tuple[int, int, str, float, float]] = []
        held = np.zeros(len(words), dtype=np.int64)
        number = {f: k + 1 for k, f in enumerate(self.families)}
        for (a, b, family), (_, like, chance) in sorted(found.items(), key=lambda x: (x[1][0], x[1][1:], x[0]), reverse=True):
            if np.isin(held[a:b], (0, number[family])).all():
                held[a:b] = number[family]
                taken.append((a, b, family, chance, like))
        out: list[list] = []
        for a, b, family, chance, like in sorted(taken):
            if out and out[-1][0] == family and a - out[-1][2] < WINDOW_WORDS:
                out[-1] = [family, out[-1][1], max(b, out[-1][2]), *max((chance, like), tuple(out[-1][3:]))]
            else:
                out.append([family, a, b, chance, like])
        return [(family, places[a][0], places[b - 1][1], chance, like) for family, a, b, chance, like in out]


def _stretch(words: list[str], at: int, template: set[str]) -> tuple[int, int]:
    """The shortest stretch around word ``at`` with most of the template's words, of at most
    half as many words again."""
    most = len(template) + len(template) // 2 + 1
    near = [k for k in range(max(0, at - most + 1), min(len(words), at + most)) if words[k] in template]
    best = (1, -1, at)
    for j, first in enumerate(near):
        if first > at:
            break
        seen: set[str] = set()
        for last in near[j:]:
            if last - first >= most:
                break
            if words[last] not in seen:
                seen.add(words[last])
                if last >= at:
                    best = max(best, (len(seen), first - last - 1, first))
    return best[2], best[2] - best[1]


def variations(template: str, count: int, rng: np.random.Generator, fill: list[list[str]]) -> list[list[str]]:
    """Word lists around a template: with openings, with words of other text before and
    after it, with a word left out or its version changed."""
    out = []
    for _ in range(count):
        words = words_of(OPENINGS[rng.integers(len(OPENINGS))] + template)
        if len(words) > 6 and rng.random() < 0.3:
            words.pop(int(rng.integers(len(words))))
        if fill and rng.random() < 0.5:
            before, after = (fill[int(rng.integers(len(fill)))] for _ in range(2))
            words = before[:int(rng.integers(0, 10))] + words + after[:int(rng.integers(0, 10))]
        out.append(words[:2 * WINDOW_WORDS])
    return out


def train_model(docs: DataFrame, *, text_col: str = "text", sample: int = SAMPLE_PARAGRAPHS, seed: int = 13) -> LicenceModel:
    """Train on the templates and on at most ``sample`` paragraphs of the corpus.

    The paragraphs are those of the texts with the smallest hash, the first 400 characters
    of each text's middle line; those with any template's signs are left out, as they may
    state a licence.
    """
    rng = np.random.default_rng(seed)
    lines = F.split(F.col(text_col), "\n")
    middle = F.substring(F.get(lines, (F.size(lines) / 2).cast("int")), 1, 400)
    # Few more than the sample pass the hash, so that no task sends the driver a sample of its own.
    keep = min(1_000_000, 1 + (2 * sample + 100) * 1_000_000 // max(1, docs.count()))
    chosen = docs.where(F.length(text_col) > 0).select(middle.alias("p"), F.xxhash64(text_col).alias("k"))
    chosen = chosen.where((F.length("p") > 0) & (F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < keep)).distinct()
    rows = chosen.orderBy("k", "p").limit(sample).collect()
    families = [*sorted(TEMPLATES), NONE]
    model = LicenceModel(families)
    plain = [w for r in rows if (w := words_of(r["p"])) and not (model.signs & set(w))]
    examples: list[tuple[np.ndarray, int]] = []
    for k, family in enumerate(families[:-1]):
        for template in TEMPLATES[family]:
            examples += [(features(v), k) for v in variations(template, VARIATIONS, rng, plain)]
    none = len(families) - 1
    examples += [(features(w[:WINDOW_WORDS]), none) for w in plain]
    # Sentences that use the words of licences without stating one.
    vocabulary = sorted({w for own in model.templates.values() for t in own for w in t})
    for _ in range(10 * VARIATIONS):
        some = [vocabulary[int(rng.integers(len(vocabulary)))] for _ in range(int(rng.integers(1, 5)))]
        if any(t <= set(some) for own in model.templates.values() for t in own):
            continue
        around = plain[int(rng.integers(len(plain)))][:16] if plain else []
        examples.append((features([*around, *some]), none))
    order = rng.permutation(len(examples))
    held = len(order) // 5
    rows_of = lambda part: ([examples[k][0] for k in part], np.array([examples[k][1] for k in part]))
    model.train(*rows_of(order[held:]))
    model.calibrate(*rows_of(order[:held]))
    return model


def scan_licences(docs: DataFrame, model: LicenceModel, *, id_col: str = "doc_id", text_col: str = "text",
                  certain: float = CERTAIN, likeness: float = LIKENESS) -> DataFrame:
    """One row a document: doc_id, families (distinct, in order), findings (family, start,
    end of the statement in code points, probability, likeness).

    Null and empty texts have none; repeated rows and rows with a null id are kept; other
    columns are ignored. Texts of any length are scanned whole, paragraph by paragraph.
    """
    kind = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("likeness", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in in_slices(batch.column(1).to_pylist()):
                found = [model.scan(t, certain, likeness) for t in texts]
                ids = batch.column(0).slice(row, len(texts))
                row += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([sorted({f[0] for f in x}) for x in found], pa.list_(pa.string())),
                     pa.array([[dict(zip(("family", "start", "end", "probability", "likeness"), f, strict=True)) for f in x] for x in found], kind)],
                    names=["doc_id", "families", "findings"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id long, families array<string>, findings array<struct<family:string,start:long,end:long,probability:double,likeness:double>>")

"""Licence families of paragraphs.

A softmax regression over hashed word n-grams is trained on varied notices of each family, and on paragraphs of the
corpus that resemble none of them. A temperature fitted on held-out examples makes its probabilities honest; a
paragraph is `unknown` below the probability that at most `false_share` of held-out background paragraphs reach. What
passes is compared with the family's templates: the share of a template's words that the paragraph has in order, how
closely they stand together, and that the words which tell the licence and its version from others are all there.
Lines are judged one by one, and once more joined up to the next line without words, since notices are wrapped over
lines and stand behind comment marks.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import U64, mix, spans, text_or_empty, utf8
from skyloom.llm.words import runs, word_hashes

# Notices by which authors apply a licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("This program is licensed under the GNU Affero General Public License, version 3.", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "SPDX-License-Identifier: Apache-2.0"),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "Dedicated to the public domain under CC0 1.0."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.", "under the terms of the GNU Lesser General Public License", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003"),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "Licensed under the Eclipse Public License 2.0."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Licensed under the ISC License."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."),
}
FAMILIES = tuple(TEMPLATES)
RESULT = "doc_id long, n_paragraphs long, n_licensed long, n_unknown long, family string, probability double, similarity double, start long, stop long, families array<string>"
# Words of notices that name no licence.
_GENERIC = frozenset("a an and any are as at available by code copy dedicated distributed either form free in is it later licence license licensed made of only or program released software source subject terms the these this to under use v version work library file files project".split())
_APART = np.zeros(256, bool)
_APART[[b for b in range(128) if not chr(b).isalnum()]] = True
_LINE = re.compile(r"[^\n]+")


@dataclass(frozen=True)
class Licenses:
    """max_background bounds the paragraphs of the corpus that the model is fitted on, twice that at most, and max_chars each of them; scanning reads every text whole. window: words of a paragraph that are judged at once, half of them shared with the next window. min_tight: share of the words between the first and the last matched one that match. title: templates of so many words at most are titles, of which every naming word counts."""

    bits: int = 16
    window: int = 64
    variants: int = 120
    max_background: int = 4000
    max_chars: int = 4000
    rounds: int = 150
    ridge: float = 1e-4
    false_share: float = 1e-3
    min_similarity: float = 0.75
    min_tight: float = 0.8
    title: int = 16
    seed: int = 3


@dataclass(frozen=True)
class Model:
    """weights: a row for each hashed n-gram, a column for each family and the last for none. threshold: probabilities below are unknown."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _windows(data: np.ndarray, offsets: np.ndarray, p: Licenses, joined: bool = False):
    """Word starts, ends and hashes; and for each window its first and last word and its row. A window lies in one line; with joined, in one run of several lines that have words."""
    s, e, row = runs(data, offsets, _APART)
    if not len(s):
        z = np.zeros(0, np.int64)
        return s, e, np.zeros(0, np.uint64), z, z, z
    line = np.concatenate([[0], np.cumsum(data == 10)])[s]
    new = np.concatenate([[True], (line[1:] - line[:-1] > int(joined)) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(s)))
    if joined:
        several = line[first] != line[first + count - 1]
        first, count = first[several], count[several]
    half = p.window // 2
    parts = np.maximum(1, -(-(count - half) // half))
    w0 = np.repeat(first, parts) + half * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    w1 = np.minimum(w0 + p.window, np.repeat(first + count, parts))
    return s, e, word_hashes(data, s, e), w0, w1, row[w0]


def _features(h: np.ndarray, w0: np.ndarray, w1: np.ndarray, p: Licenses) -> tuple[np.ndarray, np.ndarray]:
    """(window, n-gram) pairs of 1 to 3 words."""
    n = w1 - w0
    own = np.repeat(np.arange(len(n)), n)
    at = np.repeat(w0, n) + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    out_w, out_f = [], []
    with np.errstate(over="ignore"):
        name = mix(h)
        for k in range(3):
            if k:
                name = mix(name[:-1] * U64(0x9E3779B97F4A7C15) + h[k:])
            ok = at + k < w1[own]
            out_w.append(own[ok])
            out_f.append((name[at[ok]] >> U64(64 - p.bits)).astype(np.int64))
    return np.concatenate(out_w), np.concatenate(out_f)


def _logits(m: Model, h: np.ndarray, w0: np.ndarray, w1: np.ndarray, p: Licenses) -> np.ndarray:
    w, f = _features(h, w0, w1, p)
    z = np.stack([np.bincount(w, m.weights[f, c], len(w0)) for c in range(len(m.bias))], axis=1)
    return z / np.sqrt(np.maximum(1, np.bincount(w, minlength=len(w0))))[:, None] + m.bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def similarity(words: list[str], family: str, either: bool = False) -> float:
    """Share of a template's words that stand in the paragraph in the same order, for the best template; either: of the shorter one's words, so that a piece of a notice is like it."""
    best = 0.0
    for t in TEMPLATES[family]:
        want = re.findall(r"[a-z0-9]+", t.lower())
        row = [0] * (len(words) + 1)
        for x in want:
            before = 0
            for j, y in enumerate(words, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        best = max(best, row[-1] / max(1, min(len(want), len(words)) if either else len(want)))
    return best


def _tokens(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def matched(words: list[str], want: list[str]) -> tuple[int, int, int]:
    """The longest common subsequence of a paragraph and a template: its length, and the shortest range of the paragraph's words that holds it."""
    row = [(0, 0)] * (len(words) + 1)  # length and start, the later the better
    for x in want:
        before = row[0]
        for j, y in enumerate(words, 1):
            here = row[j]
            row[j] = max(here, row[j - 1], (before[0] + 1, before[1] if before[0] else j - 1) if x == y else here)
            before = here
    length, start = max(row)
    return length, start, next(j for j, r in enumerate(row) if r == (length, start))


@lru_cache(maxsize=1)
def _telling() -> dict[str, list[tuple[list[str], list[str]]]]:
    """Of each family the templates' words, and those that a notice must have: of a title its naming words, of a longer text its numbers and what sets it apart from a template of another family that is much like it."""
    whole = {f: [_tokens(t) for t in ts] for f, ts in TEMPLATES.items()}
    out: dict[str, list[tuple[list[str], list[str]]]] = {}
    for f, templates in whole.items():
        out[f] = []
        for t in templates:
            if len(t) <= Licenses.title:
                must = [w for w in t if w not in _GENERIC]
            else:
                apart = {w for g, others in whole.items() if g != f for u in others if matched(u, t)[0] >= 0.75 * len(t) for w in t if w not in u}
                must = [w for w in t if w in apart or any(c.isdigit() for c in w)]
            out[f].append((t, must))
    return out


def _in_order(words: list[str], want: list[str]) -> bool:
    rest = iter(words)
    return all(w in rest for w in want)


def confirmed(words: list[str], family: str, p: Licenses) -> tuple[float, bool]:
    """The best similarity of a paragraph to a template of the family, and whether one of them confirms it.

    A template confirms if enough of its words stand in the paragraph, closely together, with all that tell it from
    others. Between the naming words of a title no other names may stand, and a version that follows must be the family's.
    """
    best, sure, major = 0.0, 0.0, re.findall(r"\d+", family.partition("-")[2])[:1]
    for t, must in _telling()[family]:
        n, start, stop = matched(words, t)
        share = n / len(t)
        span = words[start:stop]
        good = share >= p.min_similarity and _in_order(span, must)
        if good and len(t) <= p.title:
            named = [w for w in span if w not in _GENERIC]
            good = named == must
        elif good:
            good = n >= p.min_tight * len(span)
        if good and major and not any(c.isdigit() for w in must for c in w):
            after = next((w for w in words[stop : stop + 6] if w not in _GENERIC), "")
            good = not after.isdigit() or after == major[0]
        best, sure = max(best, share), max(sure, share * good)
    return (sure, True) if sure else (best, False)


def _varied(rng: np.random.Generator, filler: list[str], p: Licenses) -> tuple[list[str], list[int]]:
    texts, labels = [], []
    for c, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            for k in range(p.variants // len(TEMPLATES[family])):
                words = template.split()
                if k and len(words) > 8:
                    words = [w for w in words if rng.random() > 0.06]
                around = [filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 12))] if k and filler else []
                cut = int(rng.integers(0, len(around) + 1))
                texts.append(" ".join([*around[:cut], *words, *around[cut:]]))
                labels.append(c)
    return texts, labels


def _arrays(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])


def background_paragraphs(docs: DataFrame, p: Licenses, text_col: str = "text") -> list[str]:
    """At most window words of a random line of each of about max_background distinct texts, drawn by hash from all; short lines of fewer than 20 characters don't count."""
    text = docs.select(text_or_empty(text_col).alias("text")).where("length(text) > 0").select(F.xxhash64("text").alias("h"), "text")
    distinct = text.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, p.max_background / max(1, distinct))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x)) > 0)
    drawn = text.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(share * (1 << 30))).withColumn("lines", lines)
    drawn = drawn.select("h", F.filter(F.split(F.get("lines", F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.size("lines"), F.lit(1))).cast("int")), r"\s+"), lambda w: w != "").alias("words"))
    at = F.pmod(F.xxhash64("h", F.lit(2)), F.greatest(F.size("words") - p.window + 1, F.lit(1))).cast("int")
    part = F.substring(F.array_join(F.slice("words", at + 1, p.window), " "), 1, p.max_chars)
    rows = drawn.select("h", part.alias("part")).groupBy("h").agg(F.first("part").alias("part")).where("length(part) > 20")  # of equal texts one
    return [r.part for r in rows.orderBy("h").limit(2 * p.max_background).collect()]


def train(docs: DataFrame, p: Licenses = Licenses(), text_col: str = "text") -> Model:
    """Fit on varied notices and on paragraphs of about max_background texts. Without texts, background is the notices' words in random order."""
    background = background_paragraphs(docs, p, text_col)
    rng = np.random.default_rng(p.seed)
    pool = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]  # of all families: the words of one notice in another order would speak for it
    scrambled = [" ".join(pool[i] for i in rng.integers(0, len(pool), int(rng.integers(2, 8)))) for _ in range(6 * sum(len(ts) for ts in TEMPLATES.values()))]
    filler = [w for t in background[:200] for w in t.split()]
    background = [t for t in background if max(similarity(re.findall(r"[a-z0-9]+", t.lower())[: p.window], f, either=True) for f in FAMILIES) < 0.5] + scrambled
    texts, labels = _varied(rng, filler, p)
    y = np.array(labels + [len(FAMILIES)] * len(background))
    data, off = _arrays(texts + background)
    _, _, h, w0, w1, row = _windows(data, off, p)
    y = y[row]
    held = rng.random(len(y)) < 0.25
    classes = len(FAMILIES) + 1
    w, f = _features(h, w0, w1, p)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(w, minlength=len(y))))
    used, slot = np.unique(f, return_inverse=True)
    weights, bias = np.zeros((len(used), classes)), np.zeros(classes)
    target = np.eye(classes)[y] * 1.0
    share = np.where(held, 0.0, 1.0 / np.bincount(y[~held], minlength=classes)[y].clip(1)) / classes
    m1, m2 = [np.zeros_like(weights), np.zeros_like(bias)], [np.zeros_like(weights), np.zeros_like(bias)]

    def logits():
        return np.stack([np.bincount(w, weights[slot, c], len(y)) for c in range(classes)], axis=1) * scale[:, None] + bias

    for r in range(p.rounds):
        pull = (_softmax(logits()) - target) * share[:, None]
        grads = [np.stack([np.bincount(slot, (pull[:, c] * scale)[w], len(used)) for c in range(classes)], axis=1) + p.ridge * weights, pull.sum(axis=0)]
        for k, g in enumerate(grads):
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.99 * m2[k] + 0.01 * g * g
        steps = [0.2 * (a / (1 - 0.9 ** (r + 1))) / (np.sqrt(b / (1 - 0.99 ** (r + 1))) + 1e-9) for a, b in zip(m1, m2, strict=True)]
        weights, bias = weights - steps[0], bias - steps[1]
    z, t = logits()[held], y[held]
    loss = lambda temp: -np.log(_softmax(z / temp)[np.arange(len(t)), t].clip(1e-12)).mean()
    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    none = _softmax(z / temperature)[t == len(FAMILIES), :-1].max(axis=1)
    threshold = max(0.5, float(np.quantile(none, 1 - p.false_share))) if len(none) else 0.5
    full = np.zeros((1 << p.bits, classes), np.float32)
    full[used] = weights
    return Model(full, bias, float(temperature), min(threshold, 0.99))


def _judged(m: Model, raw: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray, w0: np.ndarray, w1: np.ndarray, row: np.ndarray, p: Licenses):
    """(row, start, stop, family, probability, similarity) of the licence-like windows; the family is None where it isn't confirmed."""
    if not len(w0):
        return
    q = _softmax(_logits(m, h, w0, w1, p) / m.temperature)
    top = q[:, :-1].argmax(axis=1)
    for k in np.flatnonzero(q[:, -1] < 0.5).tolist():
        prob, family = float(q[k, top[k]]), FAMILIES[top[k]]
        a, z = int(s[w0[k]]), int(e[w1[k] - 1])
        alike, sure = confirmed(_tokens(raw[a:z].tobytes().decode(errors="replace")), family, p)
        yield int(row[k]), a, z, family if sure and prob >= m.threshold else None, prob, alike


def scan(docs: DataFrame, model: Model, p: Licenses = Licenses(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """RESULT for every row: the likeliest confirmed family and its place in characters, and all confirmed families.

    n_paragraphs counts windows of single lines. n_licensed counts these, and joined ones without a confirmed line of
    their family. n_unknown counts windows that the model finds licence-like but that are below the threshold or unlike
    every template of their family, unless a window of the other kind over the same words is counted. Null, empty and wordless texts have no paragraphs and null families; repeated rows and
    null ids stay as they are.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size is a parameter

    def run(batches):
        m = held.value
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        for b in batches:
            data, off = utf8(b.column(1))
            for i, j in spans(off, 1 << 20):
                raw, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                s, e, h, w0, w1, row = _windows(raw, o, p)
                rows = [[0, 0, 0, None, None, None, None, None, []] for _ in range(j - i)]
                for r, n in enumerate(np.bincount(row, minlength=j - i).tolist()):
                    rows[r][0] = n
                flagged: list[tuple[int, int, int, str | None]] = []  # windows of single lines, in order
                sure: list[tuple[int, int]] = []  # confirmed joined windows

                def note(r, a, z, family, prob, alike):
                    out = rows[r]  # noqa: B023
                    out[1] += 1
                    if family not in out[8]:
                        out[8].append(family)
                    if out[3] is None or (prob, alike) > (out[4], out[5]):
                        chars = lambda x: int(((raw[o[r] : x] & 0xC0) != 0x80).sum())  # noqa: B023, E731
                        out[3:8] = [family, prob, alike, chars(a), chars(z)]

                for r, a, z, family, prob, alike in _judged(m, raw, s, e, h, w0, w1, row, p):
                    if family:
                        note(r, a, z, family, prob, alike)
                    flagged.append((a, z, r, family))
                _, _, _, j0, j1, jrow = _windows(raw, o, p, joined=True)
                begins = [x[0] for x in flagged]
                for r, a, z, family, prob, alike in _judged(m, raw, s, e, h, j0, j1, jrow, p):
                    inside = [x for x in flagged[bisect_left(begins, a) : bisect_left(begins, z)] if x[1] <= z]
                    if family:
                        sure.append((a, z))
                        if family not in [x[3] for x in inside]:
                            note(r, a, z, family, prob, alike)
                    elif not inside:
                        rows[r][2] += 1
                for a, z, r, family in flagged:
                    if not family and not any(x <= a and z <= y for x, y in sure):
                        rows[r][2] += 1
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.record_batch([b.column(0).slice(i, j - i), *cols], ["doc_id", "n_paragraphs", "n_licensed", "n_unknown", "family", "probability", "similarity", "start", "stop", "families"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, RESULT)

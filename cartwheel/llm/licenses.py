"""Licence scan with a trained paragraph classifier.

Texts are cut into paragraphs (lines; long ones into overlapping windows). A multinomial
logistic regression over hashed word 1- to 3-grams gives each a licence family or the
class "unknown". It is trained here: positives are variations of the family templates,
negatives are paragraphs of a bounded sample of the corpus (the SAMPLE_DOCS documents
with the smallest row hash). A temperature fitted on held-back variations calibrates the
probabilities; a paragraph below MIN_PROBABILITY is unknown. A prediction counts only if
the paragraph also agrees with a template of its family word pair by word pair.

A notice may be wrapped over lines. So each block (lines up to a line without words) is
read as one word sequence too: every stretch of it that agrees with a template and is
not inside one paragraph is classified as well; of stretches that overlap, the one that
agrees best with a template of its family stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import Memo, Shared, map_batches, mix64, word_hash

DIM = 1 << 14
PARAGRAPH_WORDS, STRIDE = 24, 12
SLACK = 8  # words that a wrapped statement may hold besides its template's
SAMPLE_DOCS, VARIATIONS = 300, 60
SAMPLE_CHARS = 100_000  # of a document that may train
MIN_PROBABILITY, MIN_AGREEMENT = 0.5, 0.6
UNKNOWN = "unknown"
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*|©")

# Fixed list: statements by which the licence families are recognised
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "This project is released under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "This project is licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPL version 2 or any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Content is available under the Creative Commons Attribution License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC-SA 4.0",
        "Licensed under CC BY-NC-ND 4.0",
    ],
    "public-domain": [
        "Released under CC0 1.0",
        "This work is dedicated to the public domain",
        "To the extent possible under law the author has waived all copyright and related rights to this work",
        "This is free and unencumbered software released into the public domain",
    ],
    "proprietary": [
        "All rights reserved",
        "Copyright, all rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher",
        "Unauthorized copying or distribution of this document is strictly prohibited",
    ],
}
FAMILIES = sorted(TEMPLATES)


def _pairs(ws: list[str]) -> set:
    return set(zip(ws, ws[1:])) or {(w,) for w in ws} or {()}


PAIRS = {f: [_pairs(WORD.findall(t.lower())) for t in ts] for f, ts in TEMPLATES.items()}
SIZES = {f: [len(WORD.findall(t.lower())) for t in ts] for f, ts in TEMPLATES.items()}
HOLDERS: dict[tuple, list[tuple[str, int]]] = {}  # pair -> the templates that hold it
for _f, _ts in PAIRS.items():
    for _k, _t in enumerate(_ts):
        for _p in _t:
            HOLDERS.setdefault(_p, []).append((_f, _k))
KNOWN = frozenset(HOLDERS)


def blocks(text: str) -> list[tuple[list[str], list[tuple[int, int]]]]:
    """(words, paragraphs as word ranges) of the blocks. Paragraphs are the lines, long
    lines in overlapping windows; a line without words (blank, or only comment marks, which
    are no words) ends a block."""
    out, words, units = [], [], []
    for line in text.split("\n"):
        ws = WORD.findall(line.lower())
        if not ws:
            if words:
                out.append((words, units))
                words, units = [], []
            continue
        at, n = len(words), len(ws)
        if n <= PARAGRAPH_WORDS:
            units.append((at, at + n))
        else:
            units += [(at + i, at + min(n, i + PARAGRAPH_WORDS)) for i in range(0, n - STRIDE, STRIDE)]
        words += ws
    return out + [(words, units)] * bool(words)


def paragraphs(text: str) -> list[list[str]]:
    """Word lists of the lines, long lines in overlapping windows; lines without words
    are left out."""
    return [ws[a:b] for ws, units in blocks(text) for a, b in units]


def stretches(ws: list[str], family: str, k: int) -> list[tuple[float, int, int]]:
    """(agreement, start, end) of the stretches of at most SLACK words more than template k
    of the family that agree with it; of overlapping ones the best, then the shortest."""
    pairs, reach = PAIRS[family][k], SIZES[family][k] + SLACK - 1
    hits = [(i, p) for i, p in enumerate(zip(ws, ws[1:])) if p in pairs]
    least, seen, hi, out = MIN_AGREEMENT * len(pairs), Counter(), 0, []
    for lo, (start, pair) in enumerate(hits):
        while hi < len(hits) and hits[hi][0] < start + reach:
            seen[hits[hi][1]] += 1
            hi += 1
        if len(seen) >= least:
            first = {}
            for i, p in hits[lo:hi]:
                first.setdefault(p, i)
            new = (len(seen) / len(pairs), start, max(first.values()) + 2)
            if not out or out[-1][2] <= start:
                out.append(new)
            elif (new[0], new[1] - new[2]) > (out[-1][0], out[-1][1] - out[-1][2]):
                out[-1] = new
        seen[pair] -= 1
        if not seen[pair]:
            del seen[pair]
    return out


def wrapped(ws: list[str], units: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches of a block that agree with a template and lie in no single paragraph."""
    if len(units) < 2:
        return []
    held = Counter(t for p in KNOWN.intersection(zip(ws, ws[1:])) for t in HOLDERS[p])
    found = {(a, b) for (f, k), n in held.items() if n >= MIN_AGREEMENT * len(PAIRS[f][k]) for _, a, b in stretches(ws, f, k)}
    if not found:
        return []
    ends = [0] * (len(ws) + 1)  # by word: the furthest end of a paragraph that begins there or before
    for a, b in units:
        ends[a] = max(ends[a], b)
    ends = list(accumulate(ends, max))
    return sorted((a, b) for a, b in found if b > ends[a])


def grams(paras: list[list[str]], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """(hashed 1- to 3-grams of all paragraphs, owner of each)."""
    sizes = np.array([len(p) for p in paras], np.int64)
    h = np.fromiter((memo[w] for p in paras for w in p), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(paras)), sizes)
    ids, owners, run = [], [], np.zeros(len(h), np.uint64)
    for n in (1, 2, 3):
        run = mix64(run[: len(h) - n + 1] + h[n - 1 :] + np.uint64(n)) if len(h) >= n else run[:0]
        same = owner[n - 1 :] == owner[: max(0, len(h) - n + 1)]
        ids.append((run[same] >> np.uint64(50)).astype(np.int64)), owners.append(owner[n - 1 :][same])
    return np.concatenate(ids), np.concatenate(owners)


class Model:
    """Weights (terms x classes; the last class is unknown), temperature, template pairs."""

    def __init__(self, negatives: list[list[str]], seed: int = 3):
        rng = np.random.default_rng(seed)
        paras, y = [], []
        filler = [w for p in negatives for w in p] or ["the", "of", "and"]
        for k, family in enumerate(FAMILIES):
            for t in TEMPLATES[family]:
                ws = WORD.findall(t.lower())
                paras.append(ws), y.append(k)
                for _ in range(VARIATIONS):
                    v = [w for w in ws if rng.random() > 0.08] if len(ws) > 4 else list(ws)
                    pad = [filler[int(rng.integers(len(filler)))] for _ in range(int(rng.integers(0, 17)))]
                    cut = int(rng.integers(len(pad) + 1))
                    paras.append(pad[:cut] + v + pad[cut:]), y.append(k)
        clean = [p for p in negatives if all(self.agreement(p, f) < MIN_AGREEMENT for f in FAMILIES)]
        paras += clean
        y += [len(FAMILIES)] * len(clean)
        y = np.array(y)
        back = rng.random(len(y)) < 0.2  # held back to calibrate
        self.w = np.zeros((DIM, len(FAMILIES) + 1), np.float32)
        self.bias = np.zeros(len(FAMILIES) + 1, np.float32)
        self.temperature = 1.0
        memo = Memo(word_hash)
        self._fit([p for p, b in zip(paras, back) if not b], y[~back], memo, rng)
        rest = [p for p, b in zip(paras, back) if b]
        if rest:
            logits = self.logits(*grams(rest, memo), len(rest))
            loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(rest)), y[back]] + 1e-12).mean()
            self.temperature = float(min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss))

    def _fit(self, paras, y, memo, rng, epochs: int = 15, batch: int = 128, rate: float = 0.3) -> None:
        g = np.full_like(self.w, 1e-3)
        ids, owner = grams(paras, memo)
        order = np.argsort(owner, kind="stable")
        ids, ends = ids[order], np.cumsum(np.bincount(owner, minlength=len(paras)))
        starts = ends - np.bincount(owner, minlength=len(paras))
        for _ in range(epochs):
            turn = rng.permutation(len(paras))
            for lo in range(0, len(turn), batch):
                pick = turn[lo : lo + batch]
                own = np.concatenate([ids[starts[i] : ends[i]] for i in pick])
                at = np.repeat(np.arange(len(pick)), ends[pick] - starts[pick])
                err = _softmax(self.logits(own, at, len(pick)))
                err[np.arange(len(pick)), y[pick]] -= 1
                used, where = np.unique(own, return_inverse=True)
                size = np.maximum(1, np.bincount(at, minlength=len(pick)))
                grad = np.stack([np.bincount(where, (err[:, k] / np.sqrt(size))[at], len(used)) for k in range(err.shape[1])], axis=1) / len(pick)
                grad += 1e-5 * self.w[used]
                g[used] += grad * grad
                self.w[used] -= rate * grad / np.sqrt(g[used])
                self.bias -= 0.05 * err.mean(axis=0)

    def logits(self, ids: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        size = np.sqrt(np.maximum(1, np.bincount(owner, minlength=rows)))
        return np.stack([np.bincount(owner, self.w[ids, k], rows) for k in range(self.w.shape[1])], axis=1) / size[:, None] + self.bias

    def agreement(self, para: list[str], family: str) -> float:
        """Largest share of a template's word pairs that the paragraph holds."""
        own = _pairs(para)
        return max(len(t & own) / len(t) for t in PAIRS[family])

    def classify(self, paras: list[list[str]], memo: Memo) -> list[tuple[int, int, float, float]]:
        """(paragraph, family, probability, agreement) of the confirmed paragraphs."""
        if not paras:
            return []
        prob = _softmax(self.logits(*grams(paras, memo), len(paras)) / self.temperature)
        best = prob.argmax(axis=1)
        likely = np.flatnonzero((best < len(FAMILIES)) & (prob.max(axis=1) >= MIN_PROBABILITY))
        agree = [self.agreement(paras[i], FAMILIES[best[i]]) for i in likely]
        return [(int(i), int(best[i]), float(prob[i, best[i]]), a) for i, a in zip(likely, agree) if a >= MIN_AGREEMENT]


def _plain(text: str) -> list[list[str]]:
    """The paragraphs that hold no part of a wrapped statement."""
    out = []
    for ws, units in blocks(text):
        stated = bytearray(len(ws))
        for a, b in wrapped(ws, units):
            stated[a:b] = b"\1" * (b - a)
        out += [ws[a:b] for a, b in units if not any(stated[a:b])]
    return out


def _best(found: list[tuple[float, bool, float, int, int, int, int]]) -> list[tuple[int, int, float]]:
    """(paragraph, family, probability) of the statements of a text, in order. ``found``:
    (agreement, is wrapped, probability, family, start, end, paragraph). Of wrapped ones
    that overlap another, the best in agreement stays, a paragraph before a stretch;
    paragraphs do not rule out each other."""
    if not any(f[1] for f in found):
        return [(k, family, p) for _, _, p, family, _, _, k in found]
    taken, out = {}, []
    for _, joined, p, family, a, b, k in sorted(found, key=lambda f: (-f[0], f[1], -f[2])):
        rivals = {taken[i] for i in range(a, b) if i in taken}
        if True in rivals or (joined and rivals):
            continue
        taken.update(dict.fromkeys(range(a, b), joined))
        out.append((k, family, p))
    return sorted(out)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _core(para: list[str], family: str, start: int, end: int) -> tuple[int, int]:
    """The word range of a paragraph's statement; all of it if its words lie far apart."""
    found = max((s for k in range(len(PAIRS[family])) for s in stretches(para, family, k)), default=None)
    return (start + found[1], start + found[2]) if found else (start, end)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The classifier, with negatives from SAMPLE_DOCS different documents of the corpus of
    at most SAMPLE_CHARS characters (longer ones only do not train)."""
    rows = docs.filter(F.length(text_col) <= SAMPLE_CHARS).select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("t"))
    least = rows.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    found = [] if least is None else [(r["h"], r["t"]) for r in rows.filter(F.col("h") <= least).dropDuplicates(["h"]).toLocalIterator()]
    return Model([p for _, t in sorted(found) for p in _plain(t)])


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_paragraphs``, ``licenses``: array of (paragraph,
    family, probability) of the paragraphs that state a licence; for a statement over
    several paragraphs, the one it begins in.

    Null and empty texts have no paragraphs. Whole texts are read. Repeated rows repeat,
    null ids stay null, other columns are ignored.
    """
    shared = Shared(docs.sparkSession, model or train(docs, id_col, text_col))

    def run(batches):
        own, memo = shared.get(), Memo(word_hash)
        for b in batches:
            counts = []
            group, owner = [], []
            texts = b.column(1).to_pylist()
            found = [[] for _ in texts]
            words = 0
            for i, t in enumerate(texts):
                at = k = 0
                for ws, units in blocks(t) if t else ():
                    within = [(a, e, False, k + j) for j, (a, e) in enumerate(units)]
                    over = [(a, e, True, k + bisect_right(units, (a, len(ws))) - 1) for a, e in wrapped(ws, units)]
                    for a, e, joined, n in within + over:
                        group.append(ws[a:e])
                        owner.append((i, joined, at + a, at + e, n))
                        words += e - a
                    at, k = at + len(ws), k + len(units)
                counts.append(k)
                if words > 200_000 or i == len(texts) - 1:
                    for j, family, p, agree in own.classify(group, memo):
                        d, joined, a, e, n = owner[j]
                        a, e = (a, e) if joined else _core(group[j], FAMILIES[family], a, e)
                        found[d].append((agree, joined, p, family, a, e, n))
                    group, owner, words = [], [], 0
            found = [[{"paragraph": k, "family": FAMILIES[f], "probability": p} for k, f, p in _best(x)] for x in found]
            memo.trim()
            yield {"_id": b.column(0), "n_paragraphs": counts, "licenses": found}

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {id_type}, n_paragraphs bigint, licenses array<struct<paragraph: int, family: string, probability: double>>"
    return map_batches(docs.select(id_col, text_col), run, schema).withColumnRenamed("_id", id_col)

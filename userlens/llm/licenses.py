"""Licence scans: a paragraph classifier, confirmed by comparison with templates.

Paragraphs are the lines of a text and, as notices are wrapped, runs of consecutive lines with words (a line
without words ends a run) none of which is a licence paragraph alone; of overlapping runs that qualify the
best covered counts, then the shortest. A multinomial logistic regression over sparse word n-grams (1 to
3 words, A-Z lower-cased, words being runs of ASCII letters, digits and bytes beyond ASCII) gives
each paragraph a probability per licence family and for ``unknown``. Features are the n-grams of
the templates; a paragraph without any of them is unknown without further work, so nearly all of
a corpus is left after one lookup of its words in a small set.

Training, on the driver: variants of each family's templates (words dropped, swapped in or cut off,
other text around), against unknown paragraphs from a bounded sample of the corpus
(``SAMPLE_ROWS`` documents, the first by hash of their id) and word mixtures of several families. The
probabilities are calibrated on a held-out part: one temperature for all logits, by likelihood.

A prediction counts where its calibrated probability reaches ``MIN_PROBABILITY`` and the paragraph
holds at least ``MIN_COVER`` of the n-grams of one of the family's templates; else it is unknown.

Defined results: a null or empty text has no paragraphs; a null id stays; repeated rows are
scanned each; an empty corpus leaves the mixtures as the only unknown examples; an empty table
gives an empty table; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .shared import hash_share

SAMPLE_ROWS = 500
SAMPLE_CHARS = 8000
VARIANTS = 60
GRAMS = 3
MIN_PROBABILITY = 0.6
MIN_COVER = 0.6
UNKNOWN = "unknown"

# The usual notices of public licences.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
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
    "all-rights-reserved": ["All rights reserved."],
}
FAMILIES = [UNKNOWN, *TEMPLATES]


class LicenseModel(NamedTuple):
    """``grams`` are ascending hashes, ``weights`` [grams, families], ``bias`` [families] (divided by the
    temperature); ``owner`` and ``sizes`` tell which grams each template has and how many."""

    grams: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    templates: np.ndarray  # [templates, grams], of bool
    family: np.ndarray  # [templates]
    length: np.ndarray  # [grams], in words
    words: np.ndarray  # [templates], of words


_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _line_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[tv.Words, np.ndarray]:
    """Words, and the number of each word's line (lines of different texts differ)."""
    solid = np.where(_WORD[raw], tv._LOWER[raw], np.uint8(32))
    w = tv.words_of(solid, offsets)
    breaks = np.zeros(len(raw) + 1, dtype=np.int64)
    breaks[:-1] += raw == 10
    starts = offsets[:-1]
    first = np.zeros(len(raw) + 1, dtype=np.int64)
    np.add.at(first, starts, 1)
    return w, (np.cumsum(breaks) + np.cumsum(first))[w.start]


def _line_grams(w: tv.Words, line: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the n-grams inside lines whose first word ``keep`` has."""
    h = w.hashes()
    at, out = [], []
    for n in range(1, GRAMS + 1):
        if len(h) < n:
            break
        inside = line[n - 1:] == line[:len(line) - n + 1]
        if keep is not None:
            inside &= keep[:len(inside)]
        i = np.flatnonzero(inside)
        g = tv.gram_hashes(h, n)[i] if n > 1 else h[i]
        at.append(i)
        out.append(tv.mix(g + np.uint64(n)))
    return (np.concatenate(at), np.concatenate(out)) if at else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _features(texts: list[str], grams: np.ndarray) -> np.ndarray:
    """[texts, grams]: 1 where a text, as one paragraph, has the n-gram."""
    out = np.zeros((len(texts), len(grams)), dtype=np.float32)
    for k, text in enumerate(texts):
        raw, offsets = tv.texts_of(pa.array([text.replace("\n", " ")]))
        _, g = _line_grams(*_line_words(raw, offsets))
        i = np.searchsorted(grams, g).clip(max=len(grams) - 1)
        out[k, i[grams[i] == g]] = 1
    return out


def _variants(rng: np.random.Generator, filler: list[str]) -> tuple[list[str], list[int]]:
    texts, labels = [], []
    every = [(FAMILIES.index(f), t) for f, ts in TEMPLATES.items() for t in ts]
    pool = sorted({w for _, t in every for w in t.split()})
    for label, t in every:
        words = t.split()
        for k in range(VARIANTS):
            v = list(words)
            if k % 3 and len(v) > 4:
                for _ in range(int(rng.integers(1, 1 + max(1, len(v) // 8)))):
                    i = int(rng.integers(len(v)))
                    v[i:i + 1] = [] if rng.random() < 0.5 else [pool[rng.integers(len(pool))]]
            if k % 4 == 1:
                v = [*rng.permutation(filler)[:int(rng.integers(1, 12))], *v, *rng.permutation(filler)[:int(rng.integers(1, 12))]]
            texts.append(" ".join(v))
            labels.append(label)
    for _ in range(4 * VARIANTS):  # words of many templates, of no family
        texts.append(" ".join(rng.permutation(pool)[:int(rng.integers(1, 14))]))
        labels.append(0)
    return texts, labels


def fit(unknown: list[str], steps: int = 300, rate: float = 0.1, l2: float = 1e-3, seed: int = 11) -> LicenseModel:
    """Full-batch Adam on four fifths of the examples, one temperature on the rest."""
    rng = np.random.default_rng(seed)
    every = [(FAMILIES.index(f), t) for f, ts in TEMPLATES.items() for t in ts]
    raw, offsets = tv.texts_of(pa.array([t for _, t in every]))
    w, line = _line_words(raw, offsets)
    at, each = _line_grams(w, line)
    grams, spot = np.unique(each, return_index=True)
    n_words = len(w.start)
    ends = np.cumsum([(line[n - 1:] == line[:n_words - n + 1]).sum() for n in range(1, GRAMS + 1)])
    length = np.searchsorted(ends, spot, side="right") + 1
    templates = _features([t for _, t in every], grams) > 0
    # A paragraph that holds most of a template isn't unknown, whoever wrote it.
    features = _features(unknown, grams)
    clear = (features @ templates.T.astype(np.float32) < 0.5 * templates.sum(axis=1)).all(axis=1) if len(unknown) else np.zeros(0, bool)
    unknown = [t for t, c in zip(unknown, clear, strict=True) if c]
    filler = sorted({w for t in unknown for w in t.split()})[:2000] or ["lorem", "ipsum", "dolor", "sit", "amet"]
    texts, labels = _variants(rng, filler)
    x = np.concatenate([_features(texts, grams), features[clear][:len(texts)]]) if len(unknown) else _features(texts, grams)
    y = np.array(labels + [0] * (len(x) - len(labels)))
    order = rng.permutation(len(x))
    test, train = order[::5], np.setdiff1d(order, order[::5])
    k = len(FAMILIES)
    theta = np.zeros((len(grams) + 1, k))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    a, gold = np.hstack([x[train], np.ones((len(train), 1))]), np.eye(k)[y[train]]
    for it in range(1, steps + 1):
        grad = a.T @ (gold - _softmax(a @ theta)) / len(train) - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta += rate * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.999 ** it)) + 1e-8)
    logits = np.hstack([x[test], np.ones((len(test), 1))]) @ theta
    loss = [(-np.log(_softmax(logits / t)[np.arange(len(test)), y[test]] + 1e-12).mean(), t) for t in np.geomspace(0.2, 5.0, 60)]
    theta /= min(loss)[1]
    return LicenseModel(grams, theta[:-1], theta[-1], templates, np.array([f for f, _ in every]), length, w.counts)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> LicenseModel:
    picked = (hash_share(docs.select("doc_id", "text"), "doc_id", rows)
              .filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= chars)).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows).select("text").collect())
    lines = sorted({line for r in picked for line in r["text"].split("\n") if line.strip()})
    return fit(lines)


class Found(NamedTuple):
    doc: np.ndarray
    line: np.ndarray  # in its document, from 0
    family: np.ndarray
    probability: np.ndarray
    cover: np.ndarray


def _scored(row: np.ndarray, col: np.ndarray, n: int, model: LicenseModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(family, its probability, its cover) of n paragraphs with the n-grams (row, col)."""
    logits = np.tile(model.bias, (n, 1))
    np.add.at(logits, row, model.weights[col])
    p = _softmax(logits)
    family = p.argmax(axis=1)
    part = _covers(row, col, n, model)
    cover = np.where(model.family[None, :] == family[:, None], part, 0.0).max(axis=1)
    return family, p[np.arange(n), family], cover


def _covers(row: np.ndarray, col: np.ndarray, n: int, model: LicenseModel) -> np.ndarray:
    """[paragraphs, templates]: the share of each template's n-grams that a paragraph has."""
    shared = np.zeros((n, len(model.family)))
    np.add.at(shared, row, model.templates[:, col].T)
    return shared / model.templates.sum(axis=1)


def _template_grams(w: tv.Words, group: np.ndarray, keep: np.ndarray, model: LicenseModel) -> tuple[np.ndarray, np.ndarray]:
    """(word index, number of the n-gram) of the templates' n-grams inside groups of words."""
    at, g = _line_grams(w, group, keep)
    j = np.searchsorted(model.grams, g).clip(max=len(model.grams) - 1)
    ok = model.grams[j] == g
    return at[ok], j[ok]


def _wrapped(at: np.ndarray, col: np.ndarray, first: np.ndarray, length: np.ndarray, model: LicenseModel) -> list[tuple[int, int, float, float]]:
    """(first line, family, probability, cover) of the notices in one run of lines: ``first`` words of the
    lines and of what follows, (``at``, ``col``) the run's n-grams."""
    order = np.argsort(at, kind="stable")
    at, col = at[order], col[order]
    end = at + length[col] - 1  # an n-gram may end on a later line than it starts
    low, high = np.searchsorted(at, first[:-1]), np.searchsorted(at, first[1:])
    longest = 2 * int(model.words.max())
    n = len(first) - 1
    found = []
    for i in range(n):
        for j in range(i + 1, n):
            # Whole lines inside a notice are of its words.
            if first[j] - first[i + 1] > longest:
                break
            if high[j] == low[j] and high[i] == low[i]:
                continue
            inside = np.unique(col[low[i]:high[j]][end[low[i]:high[j]] < first[j + 1]])
            family, p, cover = (x[0] for x in _scored(np.zeros(len(inside), np.int64), inside, 1, model))
            if family > 0 and p >= MIN_PROBABILITY and cover >= MIN_COVER:
                found.append((-cover, j - i, i, -p, int(family)))
    out, used = [], np.zeros(n, dtype=bool)
    for cover, more, i, p, family in sorted(found):
        if not used[i:i + more + 1].any():
            used[i:i + more + 1] = True
            out.append((i, family, -float(p), -float(cover)))
    return out


def classify(raw: np.ndarray, offsets: np.ndarray, model: LicenseModel) -> Found:
    """The paragraphs with a confirmed family."""
    w, line = _line_words(raw, offsets)
    none = Found(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64, np.float64)))
    if not len(w.start):
        return none
    h = tv.mix(w.hashes() + np.uint64(1))
    i = np.searchsorted(model.grams, h).clip(max=len(model.grams) - 1)
    hit = model.grams[i] == h
    # Only lines with a template word in them are looked at further.
    of_line = np.cumsum(np.concatenate([[0], line[1:] != line[:-1]]))
    some = np.bincount(of_line, weights=hit)[of_line] > 0
    if not some.any():
        return none
    at, j = _template_grams(w, of_line, hit & some, model)
    lines, which = np.unique(of_line[at], return_inverse=True)
    pairs = np.unique(which * len(model.grams) + j)
    family, best, cover = _scored(pairs // len(model.grams), pairs % len(model.grams), len(lines), model)
    keep = (family > 0) & (best >= MIN_PROBABILITY) & (cover >= MIN_COVER)
    lines, family, best, cover = lines[keep], family[keep], best[keep], cover[keep]

    # Runs of other lines: only those that cover a template as a whole can have a notice in them.
    start = np.flatnonzero(np.concatenate([[True], of_line[1:] != of_line[:-1]]))
    bounds = np.append(start, len(of_line))
    alone = np.zeros(len(start), dtype=bool)
    alone[lines] = True
    apart = (np.diff(line[start]) != 1) | (np.diff(w.doc[start]) != 0) | alone[1:] | alone[:-1]
    run = np.concatenate([[0], np.cumsum(apart)])
    at, j = _template_grams(w, run[of_line], hit, model)
    runs, which = np.unique(run[of_line[at]], return_inverse=True)
    pairs = np.unique(which * len(model.grams) + j)
    may = (_covers(pairs // len(model.grams), pairs % len(model.grams), len(runs), model) >= MIN_COVER).any(axis=1)
    more = []
    for r in np.flatnonzero(may):
        a, b = np.searchsorted(run, runs[r]), np.searchsorted(run, runs[r], side="right")
        if b - a > 1:
            mine = which == r
            more += [(a + k, *x) for k, *x in _wrapped(at[mine], j[mine], bounds[a:b + 1], model.length, model)]
    if more:
        extra = [np.array(x) for x in zip(*more, strict=True)]
        lines, family, best, cover = (np.concatenate([x, y]) for x, y in zip((lines, family, best, cover), extra, strict=True))
        order = np.argsort(lines, kind="stable")
        lines, family, best, cover = lines[order], family[order], best[order], cover[order]
    first = start[lines]
    doc = w.doc[first]
    newlines = np.cumsum(np.concatenate([[0], raw == 10]))
    number = newlines[w.start[first]] - newlines[offsets[doc]]
    return Found(doc, number, family, best, cover)


def scan(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_paragraphs (licence paragraphs), families (sorted, distinct),
    license (the family of the best paragraph, or unknown), probability, cover (of that paragraph), lines
    (places of the licence paragraphs)."""
    names = ["doc_id", "n_paragraphs", "families", "license", "probability", "cover", "lines"]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_paragraphs", T.LongType()), T.StructField("families", T.ArrayType(T.StringType())),
                           T.StructField("license", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("cover", T.DoubleType()), T.StructField("lines", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tv.texts_of(batch.column(1))
            for a, b in tv.slices(offsets):
                o = offsets[a:b + 1]
                f = classify(raw[o[0]:o[-1]], o - o[0], model)
                n = b - a
                rows: list[list] = [[0] * n, [[] for _ in range(n)], [UNKNOWN] * n, [0.0] * n, [0.0] * n, [[] for _ in range(n)]]
                for d, line, fam, p, c in zip(*(x.tolist() for x in f), strict=True):
                    rows[0][d] += 1
                    rows[1][d] = sorted({*rows[1][d], FAMILIES[fam]})
                    rows[5][d].append(line)
                    if (c, p) > (rows[4][d], rows[3][d]):
                        rows[2][d], rows[3][d], rows[4][d] = FAMILIES[fam], p, c
                kinds = (pa.int64(), pa.list_(pa.string()), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), *(pa.array(r, t) for r, t in zip(rows, kinds, strict=True))], names=names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)

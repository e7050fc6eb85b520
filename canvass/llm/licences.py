"""License scans: a classifier of paragraphs, confirmed by comparison with templates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.arrays import ALNUM, LOWER, Rolling, mix, pieces, word_hashes, words
from canvass.llm.store import documents, small_batches

# How licence families are commonly named and granted.
TEMPLATES = [
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "This project is released under the Apache License 2.0."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "Licensed under the GPL version 2 or later."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "Released under the LGPL version 3."),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("AGPL", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "Released under the AGPL version 3."),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "Licensed under the Mozilla Public License 2.0."),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("CC BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC BY", "Licensed under CC BY 4.0."),
    ("CC BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC BY-ND", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC BY-ND", "Licensed under CC BY-ND 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"),
    ("CC0", "Dedicated to the public domain under CC0."),
    ("Reserved", "All rights reserved. No part of this publication may be reproduced without permission."),
    ("Reserved", "Copyright 2020 Example Company. All rights reserved."),
]
# Sentences about licences that grant none.
NEAR_MISSES = [
    "The driver had no license and was fined.",
    "Her fishing license expired in the spring.",
    "The band released a new album under a small label.",
    "She studied physics at MIT before moving to Berlin.",
    "The general public was not allowed to enter the park.",
    "This version of the story differs from the first.",
    "Please read the terms and conditions of the contest.",
    "The Apache helicopter landed near the river.",
    "All rights and duties of members are listed below.",
    "The company renewed its license to operate the mine.",
]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *dict.fromkeys(family for family, _ in TEMPLATES)]
SLOTS = 1 << 15
SCALE = 4.0


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of the words, pairs and triples of each paragraph, and the paragraph of each."""
    h = word_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slots, owners = [h], [owner]
    for size in (2, 3):
        grams = Rolling(h, 0x9E3779B97F4A7C15).grams(size)
        whole = owner[: len(grams)] == owner[size - 1 :] if len(grams) else np.zeros(0, bool)
        slots.append(grams[whole])
        owners.append(owner[: len(grams)][whole])
    return (mix(np.concatenate(slots)) >> np.uint64(49)).astype(np.int64), np.concatenate(owners)


def _paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a part, the first word of each line with words, each line's document, and where runs of such lines begin."""
    starts, ends, first = words(data, offsets, ALNUM)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    line = np.append(0, np.cumsum(data == 10))[starts] if len(starts) else np.zeros(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    run = np.ones(len(at), bool)
    run[1:] = (line[at[1:]] != line[at[:-1]] + 1) | (doc[at[1:]] != doc[at[:-1]])
    return starts, ends, np.append(at, len(starts)), doc[at], np.flatnonzero(run)


@dataclass
class Classifier:
    """Weights of a multinomial logistic regression over hashed word n-grams, and its temperature."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def chances(self, slots: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Probability of each family for each paragraph; a paragraph counts by the mean of its n-grams."""
        order = np.argsort(owner, kind="stable")
        size = np.maximum(np.bincount(owner, minlength=n), 1)
        total = np.zeros((n, len(FAMILIES)), np.float32)
        begin = np.flatnonzero(np.diff(owner[order], prepend=-1))
        if len(begin):
            total[owner[order][begin]] = np.add.reduceat(self.weights[slots[order]], begin, axis=0)
        return _softmax((SCALE * total / np.sqrt(size)[:, None] + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _as_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    offsets = np.cumsum([0, *map(len, raw)])
    return _features(data, *words(data, offsets, ALNUM))


def train(others: list[str], variants: int = 16, rounds: int = 120, seed: int = 1) -> Classifier:
    """Fit on variants of the templates, the near misses and ``others``, paragraphs taken to be no licence.

    Variants lose words and gain some of ``others`` before or after. Every fifth row is
    held out for the temperature, so that probabilities are those seen on rows not learnt from.
    """
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    noise = " ".join(others).split() or ["a"]
    for family, text in TEMPLATES:
        all_words = text.split()
        for k in range(variants):
            kept = [w for w in all_words if k == 0 or rng.random() > 0.08]
            extra = [noise[i] for i in rng.integers(0, len(noise), int(rng.integers(0, 7)) * (k % 3 > 0))]
            texts.append(" ".join([*extra, *kept] if k % 2 else [*kept, *extra]))
            labels.append(FAMILIES.index(family))
    texts += NEAR_MISSES * (variants // 4) + others
    y = np.array(labels + [0] * (len(texts) - len(labels)))
    slots, owner = _as_features(texts)
    held = np.arange(len(texts)) % 5 == 0
    size = np.sqrt(np.maximum(np.bincount(owner, minlength=len(texts)), 1))
    value = (SCALE / size[owner]).astype(np.float32)
    used, column = np.unique(slots, return_inverse=True)
    weights, bias = np.zeros((len(used), len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
    counted = np.bincount(y[~held], minlength=len(FAMILIES))
    share = np.where(held, 0, 1 / np.maximum(counted, 1)[y] / len(FAMILIES))[:, None]
    step, g_w, g_b = 0.5, np.zeros_like(weights), np.zeros_like(bias)
    learn = ~held[owner]
    order = np.argsort(column[learn], kind="stable")
    row, val = owner[learn][order], value[learn][order, None]
    begin = np.flatnonzero(np.diff(column[learn][order], prepend=-1))
    seen = column[learn][order][begin]
    rows_at = np.flatnonzero(np.diff(owner, prepend=-1))
    by_row = np.argsort(owner, kind="stable")
    rows_at = np.flatnonzero(np.diff(owner[by_row], prepend=-1))

    def logits() -> np.ndarray:
        out = np.tile(bias, (len(texts), 1))
        if len(rows_at):
            out[owner[by_row][rows_at]] += np.add.reduceat(weights[column[by_row]] * value[by_row, None], rows_at, axis=0)
        return out

    for _ in range(rounds):
        error = ((_softmax(logits()) - np.eye(len(FAMILIES))[y]) * share).astype(np.float32)
        slope = np.zeros_like(weights)
        slope[seen] = np.add.reduceat(error[row] * val, begin, axis=0)
        slope += 1e-5 * weights
        g_w += slope**2
        g_b += error.sum(0) ** 2
        weights -= step * slope / (np.sqrt(g_w) + 1e-8)
        bias -= step * error.sum(0) / (np.sqrt(g_b) + 1e-8)
    final = logits()[held]
    loss = lambda t: -np.log(_softmax(final / t)[np.arange(len(final)), y[held]] + 1e-12).mean()
    full = np.zeros((SLOTS, len(FAMILIES)), np.float32)
    full[used] = weights
    return Classifier(full, bias, float(min(np.geomspace(0.25, 4, 33), key=loss)))


def _ordered_share(template: list[bytes], found: list[bytes]) -> float:
    """How much of a template stands in a paragraph, in order: longest common subsequence of words."""
    row = [0] * (len(found) + 1)
    for word in template:
        last = 0
        for j, other in enumerate(found, 1):
            last, row[j] = row[j], last + 1 if word == other else max(row[j], row[j - 1])
    return row[-1] / max(len(template), 1)


_BLANKED = np.where(ALNUM, LOWER, 32).astype(np.uint8).tobytes()
_TEMPLATE_WORDS = {f: [t.encode().translate(_BLANKED).split() for g, t in TEMPLATES if g == f] for f in FAMILIES}


def best_template(family: str, paragraph: bytes) -> float:
    """The largest ordered share of one of the family's templates; words in any order bound it from above."""
    found = paragraph.translate(_BLANKED).split()
    there, best = set(found), 0.0
    for template in _TEMPLATE_WORDS[family]:
        if sum(w in there for w in template) > best * len(template):
            best = max(best, _ordered_share(template, found))
    return best


_LONGEST = max(len(t) for ts in _TEMPLATE_WORDS.values() for t in ts)


@cache
def _vocabulary() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the templates' words in order, and how often each stands in each template."""
    templates = [t for ts in _TEMPLATE_WORDS.values() for t in ts]
    data = np.frombuffer(b" ".join(w for t in templates for w in t), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]), ALNUM)
    known, at = np.unique(word_hashes(data, starts, ends), return_inverse=True)
    times = np.zeros((len(known), len(templates)), np.float32)
    np.add.at(times, (at, np.repeat(np.arange(len(templates)), [len(t) for t in templates])), 1)
    return known, times


def _wrapped(h: np.ndarray, first: np.ndarray, runs: np.ndarray, confirm: float) -> list[tuple[int, int]]:
    """Windows of two and more lines, half open, in which a template may stand that is parted over lines.

    Only runs that hold ``confirm`` of a template's words in any order are looked at, as nothing
    else can be confirmed. From each of their lines a window goes on line by line until a template that
    begins in the first line has ended.
    """
    known, times = _vocabulary()
    ends = np.append(runs[1:], len(first) - 1)
    many = np.flatnonzero(ends - runs > 1)
    there = np.zeros((len(runs), len(known)), np.float32)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = np.flatnonzero(known[at] == h)
    there[np.searchsorted(first[runs], hit, "right") - 1, at[hit]] = 1
    may = many[(there[many] @ times >= confirm * times.sum(0) - 1e-3).any(axis=1)] if len(many) else many
    found = []
    for k in may:
        for s in range(runs[k], ends[k] - 1):
            for e in range(s + 2, ends[k] + 1):
                found.append((s, e))
                if first[e] - first[s + 1] >= _LONGEST:
                    break
    return found


def _no_licence(text: str, least: float = 0.6) -> bool:
    there = set(text.encode().translate(_BLANKED).split())
    close = [f for f in FAMILIES[1:] if any(sum(w in there for w in t) >= least * len(t) for t in _TEMPLATE_WORDS[f])]
    return all(best_template(f, text.encode()) < least for f in close)


def background(docs: DataFrame, text_col: str, rows: int) -> list[str]:
    """At most ``rows`` paragraphs of the corpus, the first by hash, none close to a template."""
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).where("length(trim(line)) between 1 and 2000")
    taken = [r["line"] for r in lines.orderBy(F.xxhash64("line"), "line").limit(rows).collect()]
    return [t for t in taken if _no_licence(t)]


def scan_licences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 1000, least: float = 0.5, confirm: float = 0.8
) -> DataFrame:
    """Licence families named in each document.

    Every line with a word is a paragraph, and so is what stands on several lines without an
    empty one between. The classifier learns from the templates and from
    at most ``sample`` paragraphs of the corpus as the unknown class (lines of 1 to 2,000 characters with the least hashes,
    as often as they occur); it is then sent to all tasks and has one size. A paragraph belongs to its likeliest family if that is not
    unknown and has probability ``least``; it is confirmed if ``confirm`` of the words of one of the
    family's templates stand in it in order.

    Returns ``(id_col, n_paragraphs, found)``, one row for each input row; ``found`` lists
    ``(paragraph, family, probability, similarity, confirmed)`` of the paragraphs with a
    family, ``paragraph`` counted from 0 among lines with a word. A notice wrapped over lines is listed at its
    first line if it is confirmed and no line of it is by itself; ``n_paragraphs`` counts lines. Null and empty texts have no paragraphs.
    A notice inside a line of thousands of other words is part of one long paragraph, and may be too small a share of it to
    be predicted.
    """
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(train(background(texts, "text", sample)))
    kind = texts.schema["id"].dataType.simpleString()
    entry = "struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch, data, offsets in pieces(batches):
            low = LOWER[data]
            starts, ends, first, doc, runs = _paragraphs(low, offsets)
            chance = model.chances(*_features(low, starts, ends, first), len(doc)) if len(doc) else np.zeros((0, len(FAMILIES)))
            family = chance.argmax(axis=1)
            number = np.arange(len(doc)) - np.searchsorted(doc, doc)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            raw = low.tobytes()
            for k in np.flatnonzero((family > 0) & (chance.max(axis=1) >= least)):
                share = best_template(FAMILIES[family[k]], raw[starts[first[k]] : ends[first[k + 1] - 1]])
                found[doc[k]].append(
                    {"paragraph": int(number[k]), "family": FAMILIES[family[k]], "probability": float(chance[k, family[k]]), "similarity": share, "confirmed": share >= confirm, "lines": 1}
                )
            windows = _wrapped(word_hashes(low, starts, ends), first, runs, confirm) if len(doc) else []
            if windows:
                each = np.concatenate([np.arange(first[s], first[e]) for s, e in windows])
                begin = np.cumsum([0, *(first[e] - first[s] for s, e in windows)])
                chance = model.chances(*_features(low, starts[each], ends[each], begin), len(windows))
                family = chance.argmax(axis=1)
            for k in np.flatnonzero((family > 0) & (chance.max(axis=1) >= least)) if windows else ():
                (s, e), name = windows[k], FAMILIES[family[k]]
                own = found[doc[s]]
                if any(x["confirmed"] and x["family"] == name and x["paragraph"] < number[s] + e - s and x["paragraph"] + x["lines"] > number[s] for x in own):
                    continue
                share = best_template(name, raw[starts[first[s]] : ends[first[e] - 1]])
                if share >= confirm:
                    own.append({"paragraph": int(number[s]), "family": name, "probability": float(chance[k, family[k]]), "similarity": share, "confirmed": True, "lines": int(e - s)})
            for own in found:
                own.sort(key=lambda x: x["paragraph"])
                for x in own:
                    del x["lines"]
            shape = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.bincount(doc, minlength=batch.num_rows), pa.int64()), pa.array(found, pa.list_(shape))],
                names=["id", "n_paragraphs", "found"],
            )

    return texts.mapInArrow(rows, f"id {kind}, n_paragraphs long, found array<{entry}>").withColumnRenamed("id", id_col)


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    sure = F.filter("found", lambda x: x["confirmed"])
    return scan_licences(documents(spark, sf_dir)).select(
        "doc_id",
        "n_paragraphs",
        F.size("found").cast("long").alias("n_predicted"),
        F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
    )

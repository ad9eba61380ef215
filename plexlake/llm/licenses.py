"""Licence notices in texts: a paragraph classifier, confirmed by comparison with templates.

Paragraphs are runs of lines that hold more than comment marks and white space, so a notice is met whole
however it was wrapped. Their words and word pairs, as far as they occur in any template or rival notice, feed a sparse
logistic regression over the licence families and an unknown class. It is trained on templates with
words dropped and other prose around them, and for the unknown class on a bounded sample of the
corpus's own paragraphs. A third of the samples is kept back to calibrate the probabilities. A
prediction counts when its probability suffices and enough of a template's word pairs are there. A
notice spans the lines that bear it: of all runs of a paragraph's lines, however long it is, the one
most like the template, so prose above and below stays outside. These lines are classified, and
again with a few words on either side: where a template names no family, or a denial stands before it, these
must not make the notice unknown. The unknown class also learns from notices of neighbouring families and from denials, whose words are
features too, and a template that names a family and version counts only where that name stands whole, so
families that nothing was trained on do not pass for their neighbours.
A paragraph can bear several notices.

Defined results: NULL and empty texts hold no notice; repeated rows are answered each; a corpus too
small to sample leaves the unknown class with the built-in sentences. Positions count code
points from 0, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.llm import words
from plexlake.llm.stage import keep

# Well-known notices; fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
        "Apache License Version 2.0, January 2004",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
}
# What names a family and its version: a template that holds such words counts only where all of them stand.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("the Apache License", "Apache License Version 2.0"),
    "bsd": ("the BSD",),
    "cc-by-4.0": ("CC BY 4.0", "Attribution 4.0"),
    "cc-by-nc-4.0": ("BY-NC 4.0", "Attribution-NonCommercial 4.0"),
    "cc-by-sa-4.0": ("BY-SA 4.0", "Attribution-ShareAlike 4.0"),
    "gpl-3.0": ("the GNU General Public License", "version 3"),
    "mit": ("the MIT License",),
    "mpl-2.0": ("the Mozilla Public License", "v. 2.0"),
}
# Notices of neighbours, which share most words with a template; fixed values.
RIVALS = (
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License",
    "This work is licensed under the GNU General Public License, version 2.",
    "Licensed under the Eclipse Public License, Version 2.0.",
    "Licensed under the Apache License, Version 1.1.",
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License; you may not use this file except in compliance with the License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "Licensed under CC BY-ND 4.0.",
    "Licensed under CC BY-NC-SA 4.0.",
    "Licensed under CC BY 3.0.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
)
UNKNOWN = "unknown"
CONTEXT_WORDS = 12  # on either side of a notice, within its paragraph
# Sentences that share words with notices and are none.
NEAR_MISSES = (
    "He lost his driving license and had to obtain a new copy of it.",
    "The software is free and you can use it under these conditions.",
    "A public version of this work was released by the foundation.",
    "All rights reserved. Terms and conditions apply.",
    "The above notice was included in all copies of the file.",
    "version 2.0 of the file was released in January 2004",
)
WORD_BYTES = words.byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))
NOTICE = "array<struct<start:int,end:int,family:string,probability:double,overlap:double>>"


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 400  # documents whose paragraphs teach the unknown class, at most
    sample_paragraphs: int = 3000
    variants: int = 40  # of every template
    ridge: float = 1e-3
    steps: int = 250
    probability: float = 0.5
    overlap: float = 0.6  # share of a template's word pairs that must be in the lines


@dataclass(frozen=True)
class Grams:
    """Words in order with their lines, paragraphs and hashes; ``pair`` joins each word to the next one."""

    starts: np.ndarray
    line: np.ndarray
    paragraph: np.ndarray
    single: np.ndarray
    pair: np.ndarray
    together: np.ndarray  # words that have a next one in their paragraph


def _grams(data: np.ndarray, offsets: np.ndarray) -> Grams:
    starts, ends = words.word_spans(data, offsets, WORD_BYTES)
    single = words.span_hashes(data, starts, ends, lower=True)
    text = np.searchsorted(offsets, starts, side="right")
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    first = np.ones(len(starts), bool)
    first[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    stay = ~(first & np.isin(single, _MARKERS))
    starts, single, text, line = starts[stay], single[stay], text[stay], line[stay]
    new = (text[1:] != text[:-1]) | (line[1:] > line[:-1] + 1)  # a line without words lies between
    paragraph = np.concatenate([[0], np.cumsum(new)])[: len(starts)]
    pair = np.zeros(len(single), np.uint64)
    pair[:-1] = words.mix(single[:-1] * np.uint64(3) + single[1:] * np.uint64(0x9E3779B97F4A7C15))
    return Grams(starts, line, paragraph, single, pair, np.flatnonzero(~new) if len(starts) else np.zeros(0, np.int64))


def _hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return words.span_hashes(data, np.array([0]), np.array([len(data)]), lower=True)[0]


_MARKERS = np.array([_hash(w) for w in ("dnl", "rem")], np.uint64)  # comment marks made of letters; others hold no word
_DENIALS = np.array([_hash(w) for w in ("not", "never", "longer")], np.uint64)


def _read(text: str) -> Grams:
    data = np.frombuffer(text.replace("\n", " ").encode(), np.uint8)
    return _grams(data, np.array([0, len(data)]))


def _of_text(text: str) -> np.ndarray:
    grams = _read(text)
    return np.concatenate([grams.single, grams.pair[grams.together]])


def _pairs(text: str) -> np.ndarray:
    grams = _read(text)
    return np.unique(grams.pair[grams.together])


@dataclass(frozen=True)
class Model:
    vocabulary: np.ndarray
    weights: np.ndarray  # (features + intercept) x classes
    temperature: float
    families: tuple[str, ...]


def _variants(rng: np.random.Generator, text: str, n: int, prose: list[list[str]]) -> list[str]:
    out = [text]
    for _ in range(n):
        kept = [w for w in text.split() if rng.random() > 0.1]
        before, behind = (prose[rng.integers(len(prose))] for _ in range(2))
        i, j = rng.integers(0, 20, 2)
        out.append(" ".join([*before[len(before) - min(i, len(before)) :], *kept, *behind[:j]]))
    return out


def _denied(text: str) -> list[str]:
    """A short notice turned into its contrary."""
    say = lambda word: re.sub(r"(?i)\b(licensed|released)\b", rf"{word} \1", text)
    return [say(word) for word in ("not", "is not", "never", "no longer")] if say("") != text else []


def _needs(family: str, template: str) -> np.ndarray:
    """Word pairs of the family's identifiers that the template holds."""
    own = _pairs(template)
    held = [p for p in map(_pairs, IDENTIFIERS[family]) if np.isin(p, own).all()]
    return np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)


def sample_paragraphs(docs: DataFrame, settings: Settings) -> list[str]:
    """At most ``sample_paragraphs`` lines of ``sample_docs`` documents, chosen by hashes."""
    ids = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).orderBy(F.xxhash64("doc_id")).limit(settings.sample_docs)
    chosen = keep(ids, "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = texts.join(F.broadcast(chosen), "doc_id", "left_semi").select(F.explode(F.split("text", "\n")).alias("line"))
    rows = lines.where("trim(line) <> ''").orderBy(F.xxhash64("line"), "line").limit(settings.sample_paragraphs).collect()
    return [r["line"] for r in rows]


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    rng = np.random.Generator(np.random.PCG64(4))
    known = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    templates = [_pairs(t) for _, t in known]
    lines = list(NEAR_MISSES)
    for line in sample_paragraphs(docs, settings):
        found = _pairs(line)
        shared = [int(np.isin(found, t).sum()) for t in templates]
        if not any(n == len(t) or n >= max(3, len(found) / 2) for n, t in zip(shared, templates)):  # neither a notice nor a line of one is unknown
            lines.append(line)
    prose = [line.split() for line in lines]
    families = (*TEMPLATES, UNKNOWN)
    samples = [(v, families.index(f)) for f, t in known for v in _variants(rng, t, settings.variants, prose)]
    others = [*NEAR_MISSES, *RIVALS, *(d for _, t in known for d in _denied(t))]
    samples += [(v, len(families) - 1) for t in others for v in _variants(rng, t, settings.variants, prose)]
    samples += [(line, len(families) - 1) for line in lines]
    vocabulary = np.unique(np.concatenate([_of_text(t) for t in (*(t for _, t in known), *others)]))
    x = np.zeros((len(samples), len(vocabulary) + 1), np.float32)
    x[:, -1] = 1
    for row, (text, _) in zip(x, samples):
        row[:-1] = np.isin(vocabulary, _of_text(text))
    y = np.eye(len(families), dtype=np.float32)[[k for _, k in samples]]
    back = rng.random(len(samples)) < 1 / 3
    weights = _descend(x[~back], y[~back], settings)
    scores = x[back] @ weights
    grid = np.geomspace(0.25, 8, 41)
    losses = [-np.log(np.maximum((_softmax(scores / t) * y[back]).sum(axis=1), 1e-12)).mean() for t in grid]
    return Model(vocabulary, weights, float(grid[int(np.argmin(losses))]), families)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _descend(x: np.ndarray, y: np.ndarray, settings: Settings) -> np.ndarray:
    """Accelerated gradient descent; curvature per feature keeps steps of one safe."""
    weights = np.zeros((x.shape[1], y.shape[1]), np.float32)
    seen = weights
    curve = (0.5 * (x * x.sum(axis=1, keepdims=True)).mean(axis=0) + settings.ridge)[:, None]
    for step in range(settings.steps):
        gradient = x.T @ (_softmax(x @ seen) - y) / len(x) + settings.ridge * seen
        new = seen - gradient / curve
        seen = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


def _bearing(line: np.ndarray, pair: np.ndarray, template: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """(first line, last line, overlap) of runs of lines that bear a template; words of one paragraph.

    Of all runs that hold enough of it those that resemble it most are taken, so lines around that add
    little stay outside. Runs end where they have more lines than the template has words.
    """
    upto = np.concatenate([[0], np.cumsum(np.bincount(line))])
    at = np.flatnonzero(np.isin(pair, template))
    froms, tos, hashes = line[at], line[at + 1], pair[at].tolist()
    found = []
    for start in np.unique(froms).tolist():
        seen: set[int] = set()
        for k in range(int(np.searchsorted(froms, start)), len(at)):
            end = int(tos[k])
            if end - start > len(template):
                break
            seen.add(hashes[k])
            if len(seen) >= least * len(template):
                alike = len(seen) / (len(template) + int(upto[end + 1] - upto[start]) - 1)
                found.append((-alike, end - start, start, end, len(seen) / len(template)))
    taken: list[tuple[int, int, float]] = []
    for _, _, start, end, overlap in sorted(found):
        if all(end < a or start > b for a, b, _ in taken):
            taken.append((start, end, overlap))
    return taken


def _merged(notices: list[dict]) -> list[dict]:
    """Notices of one family that share lines are one."""
    out: list[dict] = []
    for n in sorted(notices, key=lambda n: (n["family"], n["start"], n["end"])):
        if out and out[-1]["family"] == n["family"] and n["start"] < out[-1]["end"]:
            out[-1] = {**out[-1], **{k: max(out[-1][k], n[k]) for k in ("end", "probability", "overlap")}}
        else:
            out.append(n)
    return sorted(out, key=lambda n: (n["start"], n["end"], n["family"]))


def _scan(model: Model, settings: Settings):
    known = [(f, _pairs(t)) for f, texts in TEMPLATES.items() for t in texts]
    needs = [_needs(f, t) for f, texts in TEMPLATES.items() for t in texts]
    sizes = np.array([len(t) for _, t in known])
    holds = np.stack([np.isin(model.vocabulary, t) for _, t in known], axis=1)
    sieve = np.zeros(1 << 20, bool)
    borne = model.vocabulary[holds.any(axis=1)]
    sieve[(borne & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def classify(present: np.ndarray) -> tuple[str, float]:
        scores = model.weights[:-1][np.isin(model.vocabulary, present)].sum(axis=0, dtype=np.float64) + model.weights[-1]
        chances = _softmax(scores[None] / model.temperature)[0]
        return model.families[int(chances.argmax())], float(chances.max())

    def notices_of(data: np.ndarray, begin: int, close: int, grams: Grams, words_at: slice, which: np.ndarray, borders: np.ndarray) -> list[dict]:
        """The notices of one paragraph; ``which`` templates may be there."""
        out = []
        line, single, pair = grams.line[words_at], grams.single[words_at], grams.pair[words_at][:-1]
        low = int(line[0])
        for k in which.tolist():
            family, template = known[k]
            for first, last, overlap in _bearing(line - low, pair, template, settings.overlap):
                inside = slice(*np.searchsorted(line - low, [first, last + 1]))
                here = pair[inside.start : inside.stop - 1]
                if not np.isin(needs[k], here).all():
                    continue
                best, chance = classify(np.concatenate([single[inside], here]))
                around = slice(max(inside.start - CONTEXT_WORDS, 0), inside.stop + CONTEXT_WORDS)
                beside, _ = classify(np.concatenate([single[around], pair[around.start : around.stop - 1]]))
                # a notice that names itself is in doubt only where it is denied
                doubt = not len(needs[k]) or np.isin(single[max(inside.start - 6, 0) : inside.start], _DENIALS).any()
                if best == family and chance >= settings.probability and not (doubt and beside == UNKNOWN):
                    a, b = max(int(borders[low + first]), begin), min(int(borders[low + last + 1]), close)
                    text = data[a:b].tobytes().decode().rstrip("\n")
                    start = len(data[begin:a].tobytes().decode())
                    out.append({"start": start, "end": start + len(text), "family": family, "probability": chance, "overlap": overlap})
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in words.text_slices(batch.column(1)):
                grams = _grams(data, offsets)
                found = grams.pair[grams.together]
                maybe = sieve[(found & np.uint64(0xFFFFF)).astype(np.int64)]
                at = np.minimum(np.searchsorted(model.vocabulary, found[maybe]), len(model.vocabulary) - 1)
                hit = model.vocabulary[at] == found[maybe]
                once = np.unique(grams.paragraph[grams.together][maybe][hit] << 32 | at[hit])
                rows, row = np.unique(once >> 32, return_inverse=True)
                here = holds[once & 0xFFFFFFFF]
                enough = [np.bincount(row, here[:, k], len(rows)) >= settings.overlap * n for k, n in enumerate(sizes)] if len(rows) else []
                notices: list[list[dict]] = [[] for _ in range(last - first)]
                borders = np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]])
                for r in np.flatnonzero(np.any(enough, axis=0)).tolist() if len(rows) else []:
                    span = slice(*np.searchsorted(grams.paragraph, [rows[r], rows[r] + 1]))
                    doc = int(np.searchsorted(offsets, grams.starts[span.start], side="right")) - 1
                    which = np.flatnonzero([e[r] for e in enough])
                    notices[doc] += notices_of(data, int(offsets[doc]), int(offsets[doc + 1]), grams, span, which, borders)
                kind = pa.list_(
                    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64())])
                )
                begins = grams.starts[np.flatnonzero(np.diff(grams.paragraph, prepend=-1))]
                n_paragraphs = np.diff(np.searchsorted(begins, offsets))
                yield pa.record_batch(
                    [batch.column(0).slice(first, last - first), pa.array(n_paragraphs.astype(np.int64)), pa.array([_merged(n) for n in notices], kind)],
                    names=["doc_id", "n_paragraphs", "notices"],
                )

    return scan


def find_licenses(docs: DataFrame, model: Model | None = None, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_paragraphs, notices) of every row of ``docs``."""
    model = train(docs, settings) if model is None else model
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(model, settings), f"doc_id long, n_paragraphs long, notices {NOTICE}")

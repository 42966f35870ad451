"""Licence scan: a trained paragraph classifier with a calibrated unknown class, confirmed by templates.

Runs of non-blank lines are the paragraphs of a text, so a notice may be wrapped;
one of more than ``PIECE`` words is read in overlapping pieces, so no place is
left out. What lies within ``AROUND`` words of a cut is judged in the other
piece, where the words after or before it are known. A piece becomes a sparse vector
of the word 1- to 3-grams known from training and of the share of its words
that are not. Softmax regression gives a probability for each licence family
and for "unknown".

Training rows are made here: notices of the families, with words dropped and
with words of the corpus before and after; for "unknown", everyday sentences
about licences and paragraphs of at most ``SAMPLE_ROWS`` documents (those with
the smallest hash of their id) that hold none of the words of ``MARKS``. Every
fourth row is kept out of the fit and sets a temperature, by likelihood, so that the probabilities
are calibrated. A prediction counts when its probability reaches ``sure`` and
the paragraph holds at least ``like`` of the words of one of the family's
notices, in order (longest common subsequence).

A paragraph may name several licences: every shortest stretch of a piece that
holds ``like`` of a notice is classified, with ``AROUND`` words on both sides,
and the whole piece where none of them is confirmed. Shorter stretches go
first; the words of a confirmed one are taken out of the others, which then need
``like`` of their notice, or ``REST`` of it and a word that the first family's
notices do not have: the words of an LGPL notice do not name the GPL too.

Null and empty texts: no paragraphs. Repeated rows each give a row, an empty
table none (an empty corpus trains on the made rows alone).
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import ceil
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import map_batches

SAMPLE_ROWS = 500
PIECE, OVERLAP = 60, 30
LENGTHS = (12, 24, PIECE)
N = 3
SURE, LIKE = 0.6, 0.75
AROUND, REST = 2, 0.5
UNKNOWN = "unknown"
_WORDS = re.compile(r"[^\W_]+(?:[.-][0-9]+)*")

#: Notices by which the public licences are named.
NOTICES = {
    "mit": (
        "Released under the MIT License.", "This project is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files", "Distributed under the terms of the MIT licence", "SPDX-License-Identifier: MIT"),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache 2.0 license",
        "You may not use this file except in compliance with the License", "SPDX-License-Identifier: Apache-2.0"),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation", "Released under the GPL version 2",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL version 3",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1"),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL version 3",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation"),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met", "Released under the BSD License", "Licensed under the 3-clause BSD license",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0."),
    "cc-by": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc0": ("Released under CC0 1.0 Universal.", "Dedicated to the public domain under CC0"),
    "all-rights-reserved": ("All rights reserved.", "Copyright 2020 by the authors. All rights reserved."),
}
#: Sentences that speak of licences or share words with notices, but name none.
DECOYS = (
    "He lost his driving license last year.", "The license of the restaurant was released in public.",
    "All seats were reserved.", "The rights of all people", "A version of the work was released under pressure.",
    "The public library is free of charge", "You may not use this door", "The general was under fire.",
    "Software for the source of the file", "Licensed drivers only.", "This work is public.", "under the terms of the contract",
)
MARKS = frozenset("license licence licensed rights reserved permission copyright spdx redistribution".split())


def words_of(line: str) -> list[str]:
    return _WORDS.findall(line.lower())


def pieces_of(text: str | None) -> Iterator[tuple[int, list[str], tuple[int, int]]]:
    """(paragraph number, words, start and end of those not next to a cut) of every piece with a word."""
    number, words, start = 0, [], 0
    for line in (text or "").split("\n"):
        if line.strip():
            words += words_of(line)
            at = 0
            while len(words) - at > PIECE:
                yield number, words[at : at + PIECE], (start, PIECE - AROUND)
                at, start = at + PIECE - OVERLAP, AROUND
            words = words[at:]
        elif words:
            yield number, words, (start, len(words))
            number, words, start = number + 1, [], 0
    if words:
        yield number, words, (start, len(words))


_WANTED = {family: [words_of(n) for n in notices] for family, notices in NOTICES.items()}
_SPOKEN = frozenset(w for notices in _WANTED.values() for wanted in notices for w in wanted)


@lru_cache
def needs_of(like: float) -> list[tuple[float, str, list[str], frozenset[str], float]]:
    """(distinct words needed, family, words, distinct words, words that may be missing) of the notices, shortest need first."""
    out = []
    for family, notices in _WANTED.items():
        for wanted in notices:
            distinct, spare = frozenset(wanted), (1 - like) * len(wanted) + 1e-9
            out.append((len(distinct) - spare, family, wanted, distinct, spare))
    return sorted(out, key=itemgetter(0))


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, N + 1) for i in range(len(words) - n + 1)}


class Classifier:
    """Softmax regression over known n-grams, a constant and the share of strange words."""

    def __init__(self, names: list[str], vocabulary: dict[str, int], weights: np.ndarray, temperature: float):
        self.names, self.vocabulary, self.weights, self.temperature = names, vocabulary, weights, temperature
        self.known = {g for g in vocabulary if " " not in g}

    def row(self, words: list[str]) -> tuple[list[int], float]:
        columns, strange, run = set(), 0, 0
        for i, w in enumerate(words):
            if w in self.known:  # only a run of known words can be a known n-gram
                run += 1
                columns.add(self.vocabulary[w])
                for n in range(2, min(run, N) + 1):
                    columns.add(self.vocabulary.get(" ".join(words[i + 1 - n : i + 1]), -1))
            else:
                strange, run = strange + 1, 0
        columns.discard(-1)
        return sorted(columns), strange / len(words)

    def logits(self, columns: list[int], strange: float) -> np.ndarray:
        z = self.weights[-2] + self.weights[-1] * strange + np.add.reduce(self.weights.take(columns, axis=0))
        return (z - z.max()) / self.temperature

    def scores(self, words: list[str]) -> np.ndarray:
        p = np.exp(self.logits(*self.row(words)))
        return p / p.sum()

    def predict(self, words: list[str]) -> tuple[str, float]:
        columns, strange = self.row(words)
        if (1 - strange) * len(words) < 1.5:  # a notice has two known words at least
            return UNKNOWN, 1.0
        z = self.logits(columns, strange)
        return self.names[int(z.argmax())], float(1 / np.exp(z).sum())


def training_rows(paragraphs: list[list[str]], seed: int = 11) -> list[tuple[list[str], str]]:
    """Made rows of every family, then the unknown ones."""
    rng = random.Random(seed)
    around = [w for p in paragraphs for w in p] or [w for d in DECOYS for w in words_of(d)]
    rows = []
    others = {family: {w for other in NOTICES if other != family for n in _WANTED[other] for w in n} for family in NOTICES}
    for family in sorted(NOTICES):
        for words in _WANTED[family]:
            for k in range(24):
                # words of no other family stay: without "affero" the notice is the GPL's
                kept = [w for w in words if k < 4 or w not in others[family] or rng.random() > 0.08] or words
                before, after = (rng.choices(around, k=rng.choice((0, 0, 3, 10))) for _ in range(2))
                rows.append(((before + kept + after)[:PIECE], family))
    decoys = [words_of(d) for d in DECOYS]
    for k in range(16 * len(decoys)):
        rows.append((decoys[k % len(decoys)] + rng.choices(around, k=rng.choice((0, 5, 15))), UNKNOWN))
    notices = [words_of(n) for family in NOTICES.values() for n in family]
    for _ in range(200):  # words of notices without their order
        rows.append((rng.sample(rng.choice(notices), k=2) + rng.choices(around, k=8), UNKNOWN))
    return rows + [(p, UNKNOWN) for p in paragraphs]


def fit(paragraphs: list[list[str]], steps: int = 250, rate: float = 0.05, penalty: float = 1e-4) -> Classifier:
    rows = training_rows(paragraphs)
    names = sorted(NOTICES) + [UNKNOWN]
    known = sorted({g for notices in NOTICES.values() for n in notices for g in grams(words_of(n))})
    vocabulary = {g: i for i, g in enumerate(known)}
    model = Classifier(names, vocabulary, np.zeros((len(known) + 2, len(names))), 1.0)
    table = np.zeros((len(rows), len(known) + 2))
    truth = np.zeros((len(rows), len(names)))
    for i, (words, family) in enumerate(rows):
        columns, strange = model.row(words)
        table[i, columns] = 1.0
        table[i, -2:] = 1.0, strange
        truth[i, names.index(family)] = 1.0
    # the weights' order: n-grams, constant, share of strange words
    kept_out = np.arange(len(rows)) % 4 == 3
    x, y = table[~kept_out], truth[~kept_out]
    w, m, v = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, steps + 1):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - y) / len(x) + 2 * penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    z = table[kept_out] @ w

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float(-(truth[kept_out] * (s - np.log(np.exp(s).sum(axis=1, keepdims=True)))).sum())

    model.temperature = min(np.geomspace(0.25, 4.0, 33).tolist(), key=loss)
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """The classifier, with unknown paragraphs from a bounded sample: pieces of three lengths from ten places a text."""
    sample = docs.where(F.col(text_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(sample_rows)

    def pick(batch: dict[str, list]) -> dict[str, object]:
        out = []
        for text in batch["text"]:
            pieces = [p for _, p, _ in pieces_of(text) if not MARKS & set(p)]
            chosen = pieces[:: max(1, len(pieces) // 10)][:10]
            out += [" ".join(p[: LENGTHS[k % len(LENGTHS)]]) for k, p in enumerate(chosen)]  # as long as a notice, or longer
        return {"piece": out}

    taken = map_batches(sample.select(F.col(text_col).alias("text")), pick, "piece string").orderBy("piece").collect()
    return fit([r.piece.split(" ") for r in taken])


def shared(words: list[str], wanted: list[str], enough: int | None = None) -> tuple[int, int]:
    """Length of the longest common subsequence and the number of words read, at most until it has ``enough``."""
    line = [0] * (len(wanted) + 1)
    for read, w in enumerate(words, start=1):
        last = 0
        for j, x in enumerate(wanted, start=1):
            last, line[j] = line[j], last + 1 if w == x else max(line[j], line[j - 1])
        if line[-1] == enough:
            return enough, read
    return line[-1], len(words)


def likeness(words: list[str], family: str) -> float:
    """Largest share of a notice's words that occur in the paragraph in order."""
    return max(shared(words, wanted)[0] / len(wanted) for wanted in _WANTED[family])


def stretches(words: list[str], wanted: list[str], like: float) -> list[tuple[int, int]]:
    """(start, end) of every stretch that holds ``like`` of the wanted words in order and no shorter one that does."""
    enough, inside = max(1, ceil(like * len(wanted) - 1e-9)), set(wanted)
    ends: dict[int, int] = {}
    for start, w in enumerate(words):
        if w in inside:
            found, read = shared(words[start:], wanted, enough)
            if found < enough:
                break  # later starts hold less
            ends[start + read] = start
    return [(start, end) for end, start in ends.items()]


def families_of(
    model: Classifier, words: list[str], inner: tuple[int, int], sure: float, like: float,
) -> list[tuple[str, float, float, bool]]:
    """(family, probability, likeness, confirmed) of every family that a piece is predicted to name in its ``inner`` words."""
    out: dict[str, tuple[float, float, bool]] = {}
    present, needs = _SPOKEN.intersection(words), needs_of(like)
    open_ = [
        (end - start, start, end, family, wanted)
        for _, family, wanted, distinct, spare in needs[: bisect_right(needs, len(present), key=itemgetter(0))]
        if len(distinct - present) <= spare  # no order yet: a cheap bound
        for start, end in stretches(words, wanted, like)
        if inner[0] <= start and end <= inner[1] or end - start > OVERLAP - AROUND
    ]
    open_.sort()
    taken: dict[int, str] = {}

    def rest(start: int, end: int) -> list[str]:
        return [words[i] for i in range(max(0, start), min(end, len(words))) if i not in taken]

    def own(start: int, end: int, wanted: list[str]) -> bool:
        """Whether the stretch still speaks for its family without what confirmed families took."""
        foreign = {w for g in {taken[i] for i in range(start, end) if i in taken} for n in _WANTED[g] for w in n}
        left = rest(start, end)
        held = shared(left, wanted)[0] / len(wanted)
        return held >= like or held >= REST and any(w in left for w in wanted if w not in foreign)

    again = True
    while again:
        again = False
        for _, start, end, family, wanted in open_:
            if family in out and out[family][2]:
                continue
            around = rest(start - AROUND, end + AROUND)
            if not around or not taken.keys().isdisjoint(range(start, end)) and not own(start, end, wanted):
                continue
            name, chance = model.predict(around)
            if name == family:
                ok = chance >= sure
                if family not in out or (ok, chance) > (out[family][2], out[family][0]):
                    out[family] = chance, likeness(words, family), ok
                if ok:
                    taken.update(dict.fromkeys(range(start, end), family))
                    again = True
                    break
    name, chance = (UNKNOWN, 1.0) if taken else model.predict(words)
    if name != UNKNOWN:
        alike = likeness(words[slice(*inner)], name)
        ok = chance >= sure and alike >= like
        if name not in out or (ok, chance) > (out[name][2], out[name][0]):
            out[name] = chance, alike, ok
    return [(family, *found) for family, found in out.items()]


def scan(
    docs: DataFrame, model: Classifier, sure: float = SURE, like: float = LIKE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc id, n_paragraphs, licenses (array of paragraph, family, probability, likeness, confirmed), families, n_unsure.

    ``families`` are the confirmed ones, sorted and comma-joined; ``licenses`` also lists paragraphs that a family was
    predicted for without reaching ``sure`` or ``like``, and ``n_unsure`` counts these.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def of_batch(batch: dict[str, list]) -> dict[str, object]:
        fitted = spread.value
        out = {"n_paragraphs": [], "licenses": [], "families": [], "n_unsure": []}
        for text in batch["text"]:
            found: dict[tuple[int, str], dict] = {}
            count, last = 0, -1
            for number, words, inner in pieces_of(text):
                count, last = count + (number != last), number
                for family, chance, alike, ok in families_of(fitted, words, inner, sure, like):
                    old = found.get((number, family))
                    if old is None or (ok, chance) > (old["confirmed"], old["probability"]):
                        found[number, family] = {
                            "paragraph": number, "family": family, "probability": chance, "likeness": alike, "confirmed": ok}
            rows = [found[k] for k in sorted(found)]
            out["n_paragraphs"].append(count)
            out["licenses"].append(rows)
            out["families"].append(",".join(sorted({r["family"] for r in rows if r["confirmed"]})))
            out["n_unsure"].append(sum(not r["confirmed"] for r in rows))
        return {"id": batch["id"], **out}

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, n_paragraphs long, licenses array<struct<paragraph: long, family: string, probability: double, "
              "likeness: double, confirmed: boolean>>, families string, n_unsure long")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, of_batch, schema).withColumnRenamed("id", id_col)

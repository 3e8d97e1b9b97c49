"""Licence scans with a trained paragraph classifier.

Sparse word n-grams feed a multinomial logistic regression over licence families and
``unknown``. It learns from templates, cut and padded at random, against paragraphs of the
corpus. A temperature fitted on variants it has not seen calibrates its probabilities, and
a family counts only if a template of that family agrees with the paragraph.

A paragraph is a line. A notice that is wrapped over lines is looked for in windows of
neighbouring lines, up to a line without words, and is told by the first of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import hash_sample, text_of

UNKNOWN = "unknown"

# Notices by which licences are declared, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the software without restriction.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the Apache License, Version 2.0.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation.",
    ),
    "BSD": (
        "Distributed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    "MPL": (
        "This source code form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the corpus paragraphs that stand for ``unknown``. ``agreement`` is
    the share of a template's word pairs that a paragraph must hold to confirm its family.
    A wrapped notice has them within ``spread`` times as many words as the template."""

    sample: int = 4_000
    variants: int = 60
    epochs: int = 200
    rate: float = 0.5
    decay: float = 1e-4
    probability: float = 0.5
    agreement: float = 0.6
    spread: float = 2.0
    seed: int = 3


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def paragraphs(text: str) -> list[str]:
    """Lines that hold a word."""
    return [line for line in text.split("\n") if _WORD.search(line)]


def runs(text: str) -> Iterator[tuple[int, list[str]]]:
    """Paragraphs with no line between them that holds no word, and the first one's number."""
    first, run = 0, []
    for line in text.split("\n"):
        if _WORD.search(line):
            run.append(line)
        elif run:
            yield first, run
            first, run = first + len(run), []
    if run:
        yield first, run


def grams(words: list[str], vocabulary: frozenset[str]) -> set[str]:
    """Word n-grams up to three words long whose words are all in ``vocabulary``."""
    made: set[str] = set()
    one = two = ""
    for word in words:
        if word not in vocabulary:
            one = two = ""
            continue
        made.add(word)
        if one:
            made.add(f"{one} {word}")
            if two:
                made.add(f"{two} {one} {word}")
        one, two = word, one
    return made


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


@dataclass(frozen=True)
class Model:
    settings: Settings
    families: tuple[str, ...]  # the last is ``unknown``
    vocabulary: frozenset[str]
    features: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: dict[str, tuple[frozenset, ...]]

    def found(self, lines: list[list[str]]) -> list[list[int]]:
        get = self.features.get
        made = []
        for words in lines:
            held = grams(words, self.vocabulary)
            made.append([i for i in map(get, held) if i is not None])
        return made

    def probabilities(self, lines: list[list[str]]) -> np.ndarray:
        rows = self.found(lines)
        return _softmax(_logits(rows, self.weights, self.bias) / self.temperature)

    def confirmed(self, family: str, words: list[str]) -> bool:
        held = _pairs(words)
        return any(
            len(pairs & held) >= self.settings.agreement * len(pairs)
            for pairs in self.templates.get(family, ())
        )

    def windows(self, run: list[list[str]]) -> list[tuple[int, int]]:
        """(first, last) of the neighbouring lines that hold a template between them: the
        shortest at each place, two lines at least, in order."""
        if len(run) < 2:
            return []
        words = [word for line in run for word in line]
        of = [i for i, line in enumerate(run) for _ in line]
        own: dict[int, list[tuple[int, tuple[str, str]]]] = {}
        for at, pair in enumerate(zip(words, words[1:])):
            for k in self.places.get(pair, ()):
                own.setdefault(k, []).append((at, pair))
        made = set()
        for k, hits in own.items():
            pairs, length = self.notices[k]
            if len({pair for _, pair in hits}) < self.settings.agreement * len(pairs):
                continue
            held: Counter = Counter()
            low = 0
            for at, pair in hits:
                held[pair] += 1
                while low < len(hits) and (
                    at - hits[low][0] >= self.settings.spread * length or held[hits[low][1]] > 1
                ):
                    old = hits[low][1]
                    held[old] -= 1
                    if not held[old]:
                        del held[old]
                    low += 1
                if len(held) >= self.settings.agreement * len(pairs):
                    first, last = of[hits[low][0]], of[at + 1]
                    if first < last:
                        made.add((first, last))
        return sorted(made)

    @cached_property
    def notices(self) -> list[tuple[frozenset, int]]:
        """Word pairs and number of words of every template."""
        return [(pairs, len(pairs) + 1) for sets in self.templates.values() for pairs in sets]

    @cached_property
    def places(self) -> dict[tuple[str, str], list[int]]:
        """The templates that hold a word pair."""
        made: dict[tuple[str, str], list[int]] = {}
        for k, (pairs, _) in enumerate(self.notices):
            for pair in pairs:
                made.setdefault(pair, []).append(k)
        return made

    def other_lines(self, text: str) -> list[str]:
        """Paragraphs outside of wrapped notices."""
        made = []
        for _, run in runs(text):
            inside: set[int] = set()
            for first, last in self.windows([words_of(line) for line in run]):
                inside.update(range(first, last + 1))
            made += [line for i, line in enumerate(run) if i not in inside]
        return made

    def scan(self, text: str) -> tuple[int, list[tuple[int, str, float]]]:
        """Number of paragraphs, and (paragraph, family, probability) of confirmed ones."""
        lines = [words_of(line) for line in paragraphs(text)]
        if not lines:
            return 0, []
        chances = self.probabilities(lines)
        best = chances.argmax(1)
        made = []
        for i in np.flatnonzero(best != len(self.families) - 1):
            family, chance = self.families[best[i]], float(chances[i, best[i]])
            if chance >= self.settings.probability and self.confirmed(family, lines[i]):
                made.append((int(i), family, chance))
        told = {(i, family) for i, family, _ in made}
        for start, run in runs(text):
            own = lines[start : start + len(run)]
            for first, last in self.windows(own):
                words = [word for line in own[first : last + 1] for word in line]
                chances = self.probabilities([words])[0]
                k = int(chances.argmax())
                family, chance = self.families[k], float(chances[k])
                inside = {(start + i, family) for i in range(first, last + 1)}
                if family == UNKNOWN or inside & told or chance < self.settings.probability:
                    continue
                if self.confirmed(family, words):
                    told |= inside
                    made.append((start + first, family, chance))
        return len(lines), sorted(made)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def _logits(rows: list[list[int]], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    sizes = np.array([len(row) for row in rows])
    flat = np.array([i for row in rows for i in row], np.int64)
    sums = np.zeros((len(flat) + 1, weights.shape[1]))
    np.cumsum(weights[flat], axis=0, out=sums[1:])
    ends = np.cumsum(sizes)
    return bias + sums[ends] - sums[ends - sizes]


def _variants(words: list[str], padding: list[list[str]], random, n: int) -> Iterator[list[str]]:
    """The words with some left out, and with words of corpus paragraphs around them."""
    for i in range(n):
        keep = random.random(len(words)) >= (0.0 if i % 3 == 0 else 0.1)
        made = [word for word, kept in zip(words, keep) if kept]
        if padding and i % 2:
            around = padding[random.integers(len(padding))]
            cut = int(random.integers(len(around) + 1))
            made = around[:cut][-30:] + made + around[cut:][:30]
        yield made


def _shell(settings: Settings, templates: dict) -> Model:
    """A model that knows the templates and has no weights."""
    known = {
        family: tuple(frozenset(_pairs(words_of(text))) for text in texts)
        for family, texts in templates.items()
    }
    vocabulary = frozenset(w for texts in templates.values() for text in texts for w in words_of(text))
    return Model(
        settings, (*templates, UNKNOWN), vocabulary, {}, np.zeros((0, 0)), np.zeros(0), 1.0, known
    )


def fit(negatives: list[str], settings: Settings = Settings(), templates=None) -> Model:
    """A model from templates and corpus paragraphs; the same input gives the same model.

    Corpus paragraphs that a template confirms teach nothing, as they are no negatives.
    """
    templates = TEMPLATES if templates is None else templates
    shell = _shell(settings, templates)
    families, vocabulary, known = shell.families, shell.vocabulary, shell.templates
    lines = [words_of(line) for line in negatives]
    lines = [words for words in lines if not any(shell.confirmed(f, words) for f in templates)]
    random = np.random.default_rng(settings.seed)
    rows: list[list[str]] = []
    labels: list[int] = []
    for k, texts in enumerate(templates.values()):
        for text in texts:
            made = list(_variants(words_of(text), lines, random, settings.variants))
            rows += made
            labels += [k] * len(made)
    # Words of the templates in no order of theirs name no licence.
    pool = sorted(vocabulary)
    mixed = [[pool[i] for i in random.integers(0, len(pool), 8)] for _ in range(settings.variants)]
    rows += mixed + lines + [[]]
    labels += [len(families) - 1] * (len(rows) - len(labels))
    names = sorted({gram for words in rows[: len(rows) - len(lines)] for gram in grams(words, vocabulary)})
    features = {name: i for i, name in enumerate(names)}
    weights, bias = np.zeros((len(names), len(families))), np.zeros(len(families))
    shell = Model(settings, families, vocabulary, features, weights, bias, 1.0, known)
    found, want = shell.found(rows), np.eye(len(families))[labels]
    held = np.arange(len(rows)) % 5 == 4
    flat = np.array([f for row, out in zip(found, held) if not out for f in row], np.int64)
    train = [row for row, out in zip(found, held) if not out]
    each = np.repeat(np.arange(len(train)), [len(row) for row in train])
    target = want[~held]
    share = target / np.maximum(target.sum(0), 1)[None, :]  # families weigh alike
    weight = share.sum(1) / len(families)
    past, past_bias = np.full(weights.shape, 1e-8), np.full(bias.shape, 1e-8)
    for _ in range(settings.epochs):
        error = (_softmax(_logits(train, weights, bias)) - target) * weight[:, None]
        grad = settings.decay * weights
        for k in range(len(families)):
            grad[:, k] += np.bincount(flat, error[each, k], len(names))
        past += grad**2
        weights -= settings.rate * grad / np.sqrt(past)
        past_bias += error.sum(0) ** 2
        bias -= settings.rate * error.sum(0) / np.sqrt(past_bias)
    logits = _logits([row for row, out in zip(found, held) if out], weights, bias)
    best = min(
        np.geomspace(0.25, 8, 41),
        key=lambda t: -np.log(np.maximum((_softmax(logits / t) * want[held]).sum(1), 1e-12)).mean(),
    )
    return Model(settings, families, vocabulary, features, weights, bias, float(best), known)


def train(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> Model:
    """Fits on the templates and ``settings.sample`` paragraphs of the corpus: those with
    the smallest hashes. Lines of a wrapped notice are no negatives either."""
    shell = _shell(settings, TEMPLATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [line for text in batch.column("text") for line in shell.other_lines(text.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["line"])

    lines = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "line string")
    place = F.xxhash64("line", F.lit(settings.seed))
    rows = hash_sample(lines, place, settings.sample, "line").collect()
    return fit([row.line for row in rows], settings)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_paragraphs, licences) of every whole text; ``licences`` has
    (paragraph, family, probability) of each confirmed paragraph, in order.

    Null and empty texts have no paragraphs; null ids and repeated rows stay rows of their
    own. The model has the size of the templates' n-grams; nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    entry = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in batches:
            counts, lists = [], []
            for text in batch.column("text"):
                n, found = fitted.scan(text.as_py())
                counts.append(n)
                lists.append([dict(zip(("paragraph", "family", "probability"), one)) for one in found])
            arrays = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(lists, pa.list_(entry))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_paragraphs", "licences"])

    schema = (
        f"id {kind}, n_paragraphs bigint, "
        "licences array<struct<paragraph:int,family:string,probability:double>>"
    )
    chosen = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text"))
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)

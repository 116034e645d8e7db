"""License scan with a positional index of rare words.

Templates are short texts with a mandatory key phrase each. The index holds postings: for
a word, the templates in whose key phrase it is the rarest or the second rarest by document frequency
in the scanned table, and its position there. As a phrase stands only where all of its words do,
a file's licence words of highest inverse document frequency meet every phrase that the file holds.
They are looked up wherever they stand; postings of the same template that agree on the relative
position propose a place, where the whole key phrase must then stand word by word. The rest of the
template is compared around verified places; its share of words found in place is the score.
Work follows the hits of the postings, not the number of templates.

Words are runs of ASCII digits and letters (lower-cased) and non-ASCII characters.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .columns import few_rows
from .words import NO_LETTERS, slices, word_hash, words_of

FILTER_BITS = 20
RARE = 2


@dataclass(frozen=True)
class Template:
    """A licence text, the phrase it must hold, and the label it gives if at least ``least`` of it is in place."""

    label: str
    phrase: str
    text: str
    base: bool = False
    least: float = 0.6


#: Base phrases with their labels, and public licence notices.
TEMPLATES = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
    Template("mit", "permission is hereby granted free of charge",
             "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files to deal in the software without restriction"),
    Template("apache", "apache license version 2 0",
             "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
             "with the license", least=0.3),
    Template("gpl", "under the terms of the gnu general public license",
             "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
             "public license as published by the free software foundation", least=0.3),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms",
             "redistribution and use in source and binary forms with or without modification are permitted provided that "
             "the following conditions are met"),
    Template("bsd", "bsd license", "bsd license"),
    Template("mpl", "mozilla public license",
             "this source code form is subject to the terms of the mozilla public license v 2 0", least=0.2),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


class PositionalIndex:
    """Words of all templates as small numbers, and postings of the rare words of key phrases."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[str, int] | None = None):
        self.templates = templates
        words = sorted({w for t in templates for w in t.text.split()})
        self.words = words
        hashes = np.array([word_hash(w) for w in words], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True
        number = {w: i for i, w in enumerate(words)}
        frequency = frequency or {}
        self.texts, phrases = [], [t.phrase.split() for t in templates]
        self.sizes = np.array([len(p) for p in phrases], np.int64)
        self.phrases = np.full((len(templates), max(self.sizes, default=0)), -1, np.int32)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(RARE)]
        for t, (template, phrase) in enumerate(zip(templates, phrases)):
            text = template.text.split()
            at = next(i for i in range(len(text)) if text[i:i + len(phrase)] == phrase)
            self.texts.append((np.array([number[w] for w in text], np.int32), at))
            self.phrases[t, :len(phrase)] = [number[w] for w in phrase]
            rare = sorted(range(len(phrase)), key=lambda i: (frequency.get(phrase[i], 0), i))
            for rank in range(RARE):
                # a phrase of one word has it at every rank
                i = rare[min(rank, len(rare) - 1)]
                found[rank].append((number[phrase[i]], t, i))
        self.postings = []
        for rows in found:
            word, template, position = np.array(sorted(rows), np.int64).reshape(-1, 3).T
            self.postings.append((np.searchsorted(word, np.arange(len(words) + 1)), template, position))

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no template."""
        found = np.full(len(hashes), -1, np.int32)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        place = np.searchsorted(self.hashes, hashes[at])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == hashes[at]
        found[at[same]] = self.order[place[same]]
        return found

    def looked_up(self, numbers: np.ndarray, at: np.ndarray, rank: int) -> np.ndarray:
        """What the words at some places propose: template times number of words, plus begin of the key phrase."""
        edges, template, position = self.postings[rank]
        first, hits = edges[numbers[at]], edges[numbers[at] + 1] - edges[numbers[at]]
        entry = np.repeat(first - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
        start = np.repeat(at, hits) - position[entry]
        inside = (start >= 0) & (start + self.sizes[template[entry]] <= len(numbers))
        return template[entry][inside] * len(numbers) + start[inside]

    def places(self, numbers: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Templates in order and where their key phrases begin."""
        at = np.flatnonzero(numbers >= 0)
        if not len(at):
            return at, at
        both = self.looked_up(numbers, at, 0)
        for rank in range(1, RARE):
            both = np.intersect1d(both, self.looked_up(numbers, at, rank))
        template, start = np.divmod(both, len(numbers))
        whole = text_of[start] == text_of[start + self.sizes[template] - 1]
        template, start = template[whole], start[whole]
        for i in range(self.phrases.shape[1]):
            over = i >= self.sizes[template]
            same = over | (numbers[np.where(over, 0, start + i)] == self.phrases[template, i])
            template, start = template[same], start[same]
        return template, start

    def coverage(self, numbers: np.ndarray, t: int, starts: np.ndarray, text_of: np.ndarray) -> np.ndarray:
        """Share of the template's words that stand in place around each key phrase."""
        text, at = self.texts[t]
        grid = starts[:, None] - at + np.arange(len(text))
        inside = (grid >= 0) & (grid < len(numbers))
        grid = np.where(inside, grid, 0)
        inside &= text_of[grid] == text_of[starts][:, None]
        return ((numbers[grid] == text) & inside).mean(axis=1)


def document_frequency(docs: DataFrame, text: str, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """In how many rows each template word stands; one small row per word and batch leaves the tasks."""
    index = PositionalIndex(templates)

    def run(batches):
        for batch in batches:
            counts = np.zeros(len(index.words), np.int64)
            for _, _, data, offsets in slices(batch.column(0)):
                words = words_of(data, offsets, NO_LETTERS)
                numbers = index.numbered(words.hashes)
                at = np.flatnonzero(numbers >= 0)
                row = np.searchsorted(words.first, at, "right") - 1
                seen = np.unique(row * len(index.words) + numbers[at])
                counts += np.bincount(seen % len(index.words), minlength=len(index.words))
            yield pa.RecordBatch.from_arrays([pa.array(index.words), pa.array(counts)], names=["word", "n"])

    found = docs.select(F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return dict(found.groupBy("word").agg(F.sum("n")).collect())  # one row per template word


def _scanned(index: PositionalIndex, column) -> Iterator[tuple]:
    for _, _, data, offsets in slices(column):
        words = words_of(data, offsets, NO_LETTERS)
        numbers = index.numbered(words.hashes)
        text_of = np.repeat(np.arange(len(offsets) - 1), words.counts)
        n = len(offsets) - 1
        labels: list[set] = [set() for _ in range(n)]
        base: list[set] = [set() for _ in range(n)]
        score = np.zeros(n)
        count = np.zeros(n, np.int64)
        first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        spans: list[list] = [[] for _ in range(n)]
        hit, begins = index.places(numbers, text_of)
        for t in np.unique(hit).tolist():
            template, starts = index.templates[t], begins[hit == t]
            rows, share = text_of[starts], index.coverage(numbers, t, starts, text_of)
            np.maximum.at(score, rows, share)
            for row, start, part in zip(rows.tolist(), (starts - words.first[rows]).tolist(), share.tolist()):
                if template.base:
                    base[row].add(template.label)
                    count[row] += 1
                    first[row] = start if first[row] < 0 else min(first[row], start)
                    last[row] = max(last[row], start)
                if template.base or part >= template.least:
                    labels[row].add(template.label)
                    spans[row].append((t, start, part))
        for i in range(n):
            yield (int(words.counts[i]), int(count[i]), None if first[i] < 0 else int(first[i]),
                   None if last[i] < 0 else int(last[i]), ",".join(sorted(base[i])), ",".join(sorted(labels[i])),
                   float(score[i]), [{"template": a, "first_word": b, "in_place": c} for a, b, c in spans[i]])


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id",
            templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: words, base places, labels, score and every place of a template.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the
    smallest and largest start among them (else null); ``labels`` joins the distinct sorted
    labels of base phrases and of templates with enough words in place. Null and empty texts
    have no words, no label and score 0. Keys may repeat or be null. Other columns are ignored.
    """
    index = PositionalIndex(templates, document_frequency(docs, text, templates))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
    place = pa.struct([("template", pa.int32()), ("first_word", pa.int64()), ("in_place", pa.float64())])
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(place)]
    schema = (f"{key} long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, places array<struct<template: int, first_word: long, in_place: double>>")

    def run(batches):
        for batch in few_rows(batches):
            columns = list(zip(*_scanned(index, batch.column(1)))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))], names=[key, *names])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema)

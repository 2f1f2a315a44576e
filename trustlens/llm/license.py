"""Licence scan by a positional index of rare words.

Licence templates are indexed by word: each word has its postings, (template,
position).  How rare a licence word is - its inverse document frequency - is
counted over the whole corpus.  In a file, a template's rarest words that the
file has are looked up; every place of one, less the position of a posting, is
a start the template could have, and starts on which two or more of them agree
are candidates.  A candidate is confirmed on the whole template: so many of its
words in place, and all its mandatory phrases within its stretch.

Beside the templates stand phrases that are a licence by themselves, wherever
their words stand consecutively.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import slices, wide_rows
from .textscan import Words
from .wordscan import Pieces, byte_classes, scan_pieces

RARE_WORDS = 4  # words of a template looked up in a file
AGREE = 2  # of them that must agree on a start
IN_PLACE = 0.6  # share of a template's words that must be in place

#: Phrases that are a licence by themselves.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Fixed values: (label, notice, mandatory phrases).  Excerpts of the public
#: licences and of the notices that their publishers recommend.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted", "without restriction"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ["with or without fee", "this permission notice"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms", "following conditions are met"]),
    ("bsd", "licensed under the bsd license", ["bsd license"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ["unless required by applicable law", "without warranties or conditions"]),
    ("gpl", "licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license", "free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["affero general public license"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("epl", "made available under the terms of the eclipse public license v 2 0", ["eclipse public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

# words are runs of 0-9, a-z (A-Z folded) and all beyond ASCII
CLASSES = byte_classes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    length = np.array([len(w) for w in raw], np.int64)
    start = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    return Words(np.frombuffer(b"".join(raw), np.uint8), start, length, np.zeros(1, np.int64)).hashes()


@dataclass
class Index:
    """Templates as word numbers, and postings by word."""

    labels: list[str]
    templates: list[np.ndarray]
    mandatory: list[list[np.ndarray]]
    base: list[tuple[str, np.ndarray]]
    vocabulary: list[str]
    postings: list[dict[int, np.ndarray]] = field(default_factory=list)  # per template: word to positions
    rarity: np.ndarray | None = None  # place of each word from rare to frequent

    def __post_init__(self):
        hashes = _hashes(self.vocabulary)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        for t in self.templates:
            self.postings.append({int(w): np.flatnonzero(t == w) for w in np.unique(t)})
        self.needed = [np.unique(np.concatenate(m)) for m in self.mandatory]

    def numbers(self, words: Words) -> np.ndarray:
        """Number of each word in the vocabulary, -1 for others."""
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.order[at], -1)

    def rank(self, document_frequency: np.ndarray) -> None:
        """Order words by inverse document frequency, ties by the word."""
        names = np.array([w.encode() for w in self.vocabulary], object)
        order = sorted(range(len(names)), key=lambda w: (document_frequency[w], names[w]))
        self.rarity = np.empty(len(order), np.int64)
        self.rarity[order] = np.arange(len(order))

    def find(self, words: np.ndarray, t: int) -> list[tuple[int, float]]:
        """(start, share of words in place) of template ``t`` in a file."""
        postings, template = self.postings[t], self.templates[t]
        here = {w: np.flatnonzero(words == w) for w in postings}
        rare = sorted((w for w in postings if len(here[w])), key=lambda w: self.rarity[w])[:RARE_WORDS]
        starts = [np.unique(here[w][:, None] - postings[w]) for w in rare]
        if not starts:
            return []
        start, votes = np.unique(np.concatenate(starts), return_counts=True)
        out = []
        for s in start[votes >= AGREE].tolist():
            a, b = max(0, s), min(len(words), s + len(template))
            share = int((words[a:b] == template[a - s : b - s]).sum()) / len(template)
            if share >= IN_PLACE and all(len(stands(words[a:b], m)) for m in self.mandatory[t]):
                out.append((s, share))
        return out


def stands(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Positions at which the words of the phrase stand consecutively."""
    n = len(words) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = np.ones(n, bool)
    for j, w in enumerate(phrase):
        ok &= words[j : j + n] == w
    return np.flatnonzero(ok)


def build_index(templates=None, base_phrases: dict[str, str] | None = None) -> Index:
    """Index of (label, notice, mandatory phrases) and of base phrases."""
    templates = TEMPLATES if templates is None else templates
    base_phrases = BASE_PHRASES if base_phrases is None else base_phrases
    texts = [t for _, t, _ in templates] + [m for _, _, ms in templates for m in ms] + list(base_phrases)
    vocabulary = sorted({w for t in texts for w in t.split()})
    number = {w: i for i, w in enumerate(vocabulary)}
    coded = lambda t: np.array([number[w] for w in t.split()])
    return Index(
        [label for label, _, _ in templates],
        [coded(t) for _, t, _ in templates],
        [[coded(m) for m in ms] for _, _, ms in templates],
        [(label, coded(p)) for p, label in base_phrases.items()],
        vocabulary,
    )


def _presence(index: Index, found: Pieces, numbers: np.ndarray, n: int) -> np.ndarray:
    """Which texts have which words of the vocabulary."""
    out = np.zeros((n, len(index.vocabulary)), bool)
    known = numbers >= 0
    out[found.row[known], numbers[known]] = True
    return out


def document_frequency(docs: DataFrame, index: Index) -> np.ndarray:
    """In how many documents each word of the vocabulary stands.

    One row per word comes to the driver, whatever the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.vocabulary), np.int64)
        for b in slices(batches, "text"):
            found = scan_pieces(b.column("text"), CLASSES)
            total += _presence(index, found, index.numbers(found.words), b.num_rows).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(index.vocabulary), np.int64)
    for r in rows:
        out[r.word] = r.n
    return out


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "places array<struct<label:string,start:long,share:double>>"
)
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))


def _scan(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = scan_pieces(b.column("text"), CLASSES)
            numbers, first = index.numbers(found.words), found.words.first
            present = _presence(index, found, numbers, b.num_rows)
            base: dict[int, list[tuple[int, str]]] = {}
            for label, phrase in index.base:
                at = stands(numbers, phrase)
                for p in at[found.row[at] == found.row[at + len(phrase) - 1]].tolist():
                    row = int(found.row[p])
                    base.setdefault(row, []).append((p - int(first[row]), label))
            places: dict[int, list[dict]] = {}
            for t, label in enumerate(index.labels):
                # without the words of its mandatory phrases it is not there
                for row in np.flatnonzero(present[:, index.needed[t]].all(1)).tolist():
                    words = numbers[first[row] : first[row + 1]]
                    for start, share in index.find(words, t):
                        places.setdefault(row, []).append({"label": label, "start": start, "share": share})
            rows = range(b.num_rows)
            own = [[at for at, _ in base.get(r, [])] for r in rows]
            labels = [{x for _, x in base.get(r, [])} for r in rows]
            more = [labels[r] | {p["label"] for p in places.get(r, [])} for r in rows]
            score = [1.0 if own[r] else max((p["share"] for p in places.get(r, [])), default=0.0) for r in rows]
            joined = lambda xs: pa.array([",".join(sorted(x)) for x in xs], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(found.words.counts, pa.int64()),
                    pa.array([len(x) for x in own], pa.int64()),
                    pa.array([min(x) if x else None for x in own], pa.int64()),
                    pa.array([max(x) if x else None for x in own], pa.int64()),
                    joined(labels),
                    joined(more),
                    pa.array(score, pa.float64()),
                    pa.array([sorted(places.get(r, []), key=lambda p: (p["start"], p["label"], -p["share"])) for r in rows], _PLACES),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"],
            )

    return run


def scan_licenses(docs: DataFrame, templates=None, base_phrases: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, places) of every row of ``docs``.

    Words are runs of digits, letters a-z (A-Z folded) and characters beyond
    ASCII.  ``n_base`` counts the places of all base phrases, ``first_word`` and
    ``last_word`` are the least and the largest of their starts (null without
    one), ``base_labels`` their labels; ``labels`` has those of the templates
    found, too, and ``places`` where these start (below 0 where a text begins
    inside one) and the share of their words that is in place.  ``score`` is 1
    with a base phrase, else the largest share, else 0.  Labels are distinct,
    sorted and joined by commas; none is an empty string.

    A null or empty text has no words.  Rows are taken one by one: repeated
    rows and rows without an id are returned as often as they come (a word's
    document frequency counts them all); an empty table gives no rows.  Only
    doc_id and text are read.
    """
    rows = wide_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = build_index(templates, base_phrases)
    index.rank(document_frequency(rows, index))
    return rows.mapInArrow(_scan(index), _SCHEMA)

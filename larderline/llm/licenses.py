"""Find licence statements: stated phrases, and passages of licence templates.

The templates' tokens make up one generalised suffix automaton. A document is
streamed through it, which gives for each token the longest run of tokens ending
there that stands in some template, and along the suffix links the longest run of
each place of each template. Runs that go on neither way are chained, per template,
where they follow each other in the document and in the template, by dynamic
programming; a template of which a chain covers enough is a licence found.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import equip

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

def _gnu(name: str, work: str, version: str, comma: str = ",") -> str:
    return (
        f"This {work} is free software: you can redistribute it and/or modify it under the terms"
        f" of the GNU {name} as published by the Free Software Foundation{comma} either"
        f" version {version} of the License, or (at your option) any later version."
    )


# The notices that licences ask for, their shorter texts, and usual
# short statements.
_NOTICES = {
    "agpl-3.0": (_gnu("Affero General Public License", "program", "3"),),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under"
        " the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY"
        " KIND, either express or implied.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution.",
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software without specific prior"
        " written permission.",
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a"
        " copy of the software and accompanying documentation covered by this license",
    ),
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Creative Commons Attribution 4.0 International",
        "Licensed under CC BY 4.0",
    ),
    "cc-by-nc-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "Licensed under CC BY-NC 4.0",
    ),
    "cc-by-sa-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0"
        " International License",
        "Creative Commons Attribution-ShareAlike 4.0 International",
        "Licensed under CC BY-SA 4.0",
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work",
        "CC0 1.0 Universal",
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License 2.0",
    ),
    "gpl-2.0": (
        _gnu("General Public License", "program", "2"),
        "This work is licensed under the GNU General Public License, version 2",
    ),
    "gpl-3.0": (
        _gnu("General Public License", "program", "3"),
        "This work is licensed under the GNU General Public License, version 3",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    "lgpl-2.1": (_gnu("Lesser General Public License", "library", "2.1"),),
    "lgpl-3.0": (_gnu("Lesser General Public License", "library", "3"),),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction",
        "Released under the MIT License",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event"
        " will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely",
    ),
}

# What stands behind "SPDX-License-Identifier:", by label.
_IDENTIFIERS = {
    "agpl-3.0": ("AGPL-3.0-only", "AGPL-3.0-or-later"),
    "apache-2.0": ("Apache-2.0",),
    "bsd": ("BSD-2-Clause",),
    "bsd-3-clause": ("BSD-3-Clause",),
    "bsl-1.0": ("BSL-1.0",),
    "cc-by-4.0": ("CC-BY-4.0",),
    "cc-by-sa-4.0": ("CC-BY-SA-4.0",),
    "cc0-1.0": ("CC0-1.0",),
    "epl-2.0": ("EPL-2.0",),
    "gpl-2.0": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0"),
    "gpl-3.0": ("GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0"),
    "isc": ("ISC",),
    "lgpl-2.1": ("LGPL-2.1-only", "LGPL-2.1-or-later"),
    "lgpl-3.0": ("LGPL-3.0-only", "LGPL-3.0-or-later"),
    "mit": ("MIT",),
    "mpl-2.0": ("MPL-2.0",),
    "unlicense": ("Unlicense",),
    "zlib": ("Zlib",),
}

TEMPLATES = {
    label: (
        *notices,
        *[f"SPDX-License-Identifier: {name}" for name in _IDENTIFIERS.get(label, ())],
    )
    for label, notices in _NOTICES.items()
}

# Tokens of a run that counts, if the template is not shorter; tokens that may lie
# between runs of a chain, or this part of the template if that is more; and the
# share of a template that has to be covered.
LEAST_RUN = 4
MOST_GAP = 8
GAP_SHARE = 0.25
LEAST_COVERED = 0.75
# What a phrase alone is worth as a score.
PHRASE_SCORE = 0.5

# Letters A-Z are lowered, other ASCII characters but digits and a-z separate.
def _plain(byte: int) -> int:
    if 65 <= byte <= 90:
        return byte + 32
    stays = 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128
    return byte if stays else 32


_PLAIN = bytes(_plain(byte) for byte in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


class Automaton:
    """The generalised suffix automaton of token sequences.

    ``ends`` of a state are all places where its runs end: sequence and token.
    """

    def __init__(self, sequences: list[list[int]]):
        self.length, self.link = [0], [-1]
        self.after: list[dict[int, int]] = [{}]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            state = 0
            for end, token in enumerate(sequence):
                state = self._extend(state, token)
                self.ends[state].add((number, end))
        # Where a run ends, all its suffixes do.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]
        self._reached: dict[int, list[tuple[int, int, int]]] = {}

    def reached(self, state: int) -> list[tuple[int, int, int]]:
        """All places where some suffix of the state's runs ends, by sequence and
        token, with the length of the longest one."""
        if state not in self._reached:
            places, below, at = [], set(), state
            while at > 0:
                places += [(n, end, self.length[at]) for n, end in self.ends[at] - below]
                below, at = self.ends[at], self.link[at]
            self._reached[state] = places
        return self._reached[state]

    def _new(self, length: int, link: int, like: int | None = None) -> int:
        self.length.append(length)
        self.link.append(link)
        self.after.append({} if like is None else dict(self.after[like]))
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """A state for the shorter runs of the target, to which they now lead."""
        clone = self._new(self.length[state] + 1, self.link[target], like=target)
        self.link[target] = clone
        while state >= 0 and self.after[state].get(token) == target:
            self.after[state][token] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, token: int) -> int:
        known = self.after[last].get(token)
        if known is not None:
            exact = self.length[known] == self.length[last] + 1
            return known if exact else self._split(last, token, known)
        state = self._new(self.length[last] + 1, 0)
        at = last
        while at >= 0 and token not in self.after[at]:
            self.after[at][token] = state
            at = self.link[at]
        if at >= 0:
            target = self.after[at][token]
            exact = self.length[target] == self.length[at] + 1
            self.link[state] = target if exact else self._split(at, token, target)
        return state

    def statistics(self, tokens) -> Iterator[tuple[int, int]]:
        """For each token the longest known run ending there, and its state."""
        state = length = 0
        for token in tokens:
            while state and token not in self.after[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.after[state].get(token, 0)
            length = length + 1 if state else 0
            yield length, state


class Run(NamedTuple):
    """Tokens of a document that stand in a template: where they begin in each."""

    first: int
    begin: int
    length: int

    @property
    def last(self) -> int:
        return self.first + self.length - 1

    @property
    def end(self) -> int:
        return self.begin + self.length - 1


def chained(runs: list[Run], most_gap: int) -> list[tuple[int, int, int]]:
    """Chains of runs as first and last token and tokens covered, the best first;
    they do not overlap.

    In a chain both ends of a run lie behind those of the one before, in document
    and template, with at most ``most_gap`` tokens of the document between; what
    two runs share counts once. Each run is put behind the chain that makes the
    most of it.
    """
    runs = sorted(runs, key=lambda run: (run.last, run.end, run.first))
    best: list[tuple[int, int]] = []
    for number, run in enumerate(runs):
        covered, first = run.length, run.first
        for earlier in range(number - 1, -1, -1):
            other = runs[earlier]
            if run.first - other.last - 1 > most_gap:
                break
            shared = max(0, other.last + 1 - run.first, other.end + 1 - run.begin)
            behind = other.first < run.first and other.begin < run.begin and other.last < run.last
            gap = run.first + shared - other.last - 1
            if behind and shared < run.length and gap <= most_gap:
                so_far, start = best[earlier]
                if so_far + run.length - shared > covered:
                    covered, first = so_far + run.length - shared, start
        best.append((covered, first))
    found: list[tuple[int, int, int]] = []
    for number in sorted(range(len(runs)), key=lambda n: (-best[n][0], runs[n].last)):
        covered, first = best[number]
        last = runs[number].last
        if all(last < other or first > end for other, end, _ in found):
            found.append((first, last, covered))
    return found


class Span(NamedTuple):
    """A chain of runs: words of the document, and the share covered."""

    label: str
    first: int
    last: int
    covered: float


class Scanner:
    """Phrases and templates, ready to be held against texts."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, tuple[str, ...]]):
        self.labels = [label for label, texts in templates.items() for _ in texts]
        texts = [text for texts in templates.values() for text in texts]
        sequences = [words_of(text) for text in texts]
        stated = {tuple(words_of(phrase)): label for phrase, label in phrases.items()}
        every = sorted({word for words in [*sequences, *stated] for word in words})
        self.ids = {word: number for number, word in enumerate(every)}
        self.phrases = [([self.ids[w] for w in words], label) for words, label in stated.items()]
        self.lengths = [len(words) for words in sequences]
        self.sequences = [[self.ids[w] for w in words] for words in sequences]
        # A template shorter than a run that counts has to be there in full.
        self.least = [min(LEAST_RUN, length) for length in self.lengths]
        self.shortest = min(self.least, default=LEAST_RUN)
        self.automaton = Automaton(self.sequences)

    def base(self, tokens: np.ndarray) -> tuple[list[int], set[str]]:
        """Where phrases start, one for each place and phrase, and their labels."""
        starts, labels = [], set()
        for phrase, label in self.phrases:
            places = max(0, len(tokens) - len(phrase) + 1)
            here = np.ones(places, dtype=bool)
            for offset, token in enumerate(phrase):
                here &= tokens[offset : offset + places] == token
            if here.any():
                starts.extend(np.flatnonzero(here).tolist())
                labels.add(label)
        return starts, labels

    def runs(self, tokens: np.ndarray) -> dict[int, list[Run]]:
        """The runs that go on neither way, by template. Only stretches of known
        words that are long enough are streamed."""
        known = np.concatenate([[0], (tokens >= 0).astype(np.int8), [0]])
        edges = np.diff(known)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        found: dict[int, list[Run]] = {}
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            if end - start >= self.shortest:
                self._runs_of(start, tokens[start:end].tolist(), found)
        return found

    def _runs_of(self, start: int, tokens: list[int], found: dict[int, list[Run]]) -> None:
        for at, (longest, state) in enumerate(self.automaton.statistics(tokens)):
            if longest < self.shortest:
                continue
            following = tokens[at + 1] if at + 1 < len(tokens) else None
            for number, end, size in self.automaton.reached(state):
                length = min(size, longest)
                goes_on = self.sequences[number][end + 1 : end + 2] == [following]
                if length >= self.least[number] and not goes_on:
                    run = Run(start + at - length + 1, end - length + 1, length)
                    found.setdefault(number, []).append(run)

    def spans(self, tokens: np.ndarray) -> list[Span]:
        """The template passages, by place. Of versions of a licence that differ in
        a few words, the one goes that covers less of the same place and is not
        there in full."""
        found = []
        for number, runs in self.runs(tokens).items():
            size = self.lengths[number]
            if sum(run.length for run in runs) < LEAST_COVERED * size:
                continue
            for first, last, covered in chained(runs, max(MOST_GAP, int(GAP_SHARE * size))):
                if covered >= LEAST_COVERED * size:
                    found.append((covered, Span(self.labels[number], first, last, covered / size)))
        kept = {
            span
            for covered, span in found
            if span.covered == 1
            or not any(
                more > covered
                and other.label != span.label
                and other.first <= span.first
                and span.last <= other.last
                for more, other in found
            )
        }
        return sorted(kept, key=lambda span: (span.first, span.label, span.last))

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        get = self.ids.get
        tokens = np.fromiter((get(word, -1) for word in words), dtype=np.int32, count=len(words))
        starts, labels = self.base(tokens)
        spans = self.spans(tokens)
        best = max((span.covered for span in spans), default=0.0)
        score = max(best, PHRASE_SCORE if starts else 0.0)
        return len(words), starts, sorted(labels), spans, score


@functools.cache
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(templates))


_SPAN = pa.struct(
    [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())]
)


def _scan(phrases: tuple, templates: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(phrases, templates)
        for batch in batches:
            rows = [scanner.scan(text.as_py()) for text in batch.column("text")]
            columns = [
                pa.array([row[0] for row in rows], pa.int64()),
                pa.array([len(row[1]) for row in rows], pa.int64()),
                pa.array([min(row[1], default=None) for row in rows], pa.int64()),
                pa.array([max(row[1], default=None) for row in rows], pa.int64()),
                pa.array([row[2] for row in rows], pa.list_(pa.string())),
                pa.array(
                    [sorted({*row[2], *(span.label for span in row[3])}) for row in rows],
                    pa.list_(pa.string()),
                ),
                pa.array([[span._asdict() for span in row[3]] for row in rows], pa.list_(_SPAN)),
                pa.array([row[4] for row in rows], pa.float64()),
            ]
            yield pa.record_batch([batch.column("id"), *columns], names=["id", *_ADDED.names])

    return run


_ADDED = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")],
        *[T.StructField(n, T.ArrayType(T.StringType())) for n in ("base_labels", "labels")],
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("first", T.LongType()),
                        T.StructField("last", T.LongType()),
                        T.StructField("covered", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("score", T.DoubleType()),
    ]
)


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
) -> DataFrame:
    """Each row's ``id``, ``n_words``, places of phrases (``n_base``, the start of
    the ``first_word`` and of the ``last_word``), ``base_labels``, all ``labels``,
    the ``spans`` of templates and a ``score``: the best covered share of a
    template, and half for a phrase alone.

    NULL and empty texts have no words and no labels. Repeated rows are scanned
    alike; nothing is shuffled. An empty table gives no rows.
    """
    equip(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = T.StructType([rows.schema["id"], *_ADDED.fields])
    return rows.mapInArrow(_scan(tuple(phrases.items()), tuple(templates.items())), schema)

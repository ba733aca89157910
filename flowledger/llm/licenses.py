"""Licence scan: a generalised suffix automaton of licence word sequences reads every text as a stream.

After each word the automaton's state and length are the matching statistics: the longest run of words
ending here that stands in some template. Runs that cannot grow further and have at least MIN_MATCH words
are chained per template, in order on both sides and with gaps of at most MAX_GAP words, into covered
spans. A template counts as found where a chain covers COVERED of its words. Short phrases with a label
of their own are part of the automaton; each of their places is reported.

Null text is empty text: no words, no labels, score 0. Repeated rows and null ids are scanned one by one;
other columns are not read. Nothing is shuffled; only stretches of words that stand in some template
enter the automaton, and state is kept per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOWER, plain_text

MIN_MATCH, MAX_GAP, COVERED = 4, 16, 0.8

# Phrases whose places are counted, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices and opening clauses of public licences.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions: The above copyright notice and this permission notice shall be included in "
            "all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                 "compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                 "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
                 "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                 "language governing permissions and limitations under the License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version. This program is distributed in the hope that it will be "
              "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR "
              "A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
              "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]

# Bytes of words: digits, a-z and everything beyond ASCII; A-Z in lower case, the rest is a gap.
_WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in LOWER)


def license_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split()


class LicenseAutomaton:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.labels = [label for label, _ in templates] + list(phrases.values())
        texts = [license_words(t) for _, t in templates] + [license_words(p) for p in phrases]
        self.sizes = [len(t) for t in texts]
        self.first_phrase = len(templates)
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        places: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate(texts):
            last = 0
            for end, w in enumerate(words, 1):
                last = self._extend(last, self.ids.setdefault(w, len(self.ids) + 1), places)
                places[last].add((t, end))
        # What ends in a state also ends in all states whose strings are suffixes of its own.
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            places[self.link[s]] |= places[s]
        self.places = [sorted(p) for p in places]
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for p in range(self.first_phrase, len(texts)):
            state = 0
            for w in texts[p]:
                state = self.next[state][self.ids[w]]
            for s in range(len(self.link)):
                a = s
                while a > 0 and a != state:
                    a = self.link[a]
                if a == state:
                    self.phrases[s].append((p, self.sizes[p]))

    def _state(self, length: int, link: int, following: dict[int, int], places) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        places.append(set())
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: int, places) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), places)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int, places) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w, places)
        new = self._state(self.length[last] + 1, 0, {}, places)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w, places)
        return new

    def read(self, ids: list[int], at: int, runs: list, phrases: list) -> None:
        """Matching statistics over words from position at; runs that end get (end, length, state)."""
        state = size = 0
        following, link, length = self.next, self.link, self.length
        for i, w in enumerate(ids, at):
            to = following[state].get(w)
            if to is None:
                if size >= MIN_MATCH:
                    runs.append((i, size, state))
                while state and to is None:
                    state = link[state]
                    to = following[state].get(w)
                size = length[state] if to is not None else 0
            if to is not None:
                state, size = to, size + 1
            for p, n in self.phrases[state]:
                if size >= n:
                    phrases.append((i + 1 - n, p))
        if size >= MIN_MATCH:
            runs.append((at + len(ids), size, state))

    def spans(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """(template, first word, last word, covered share) of chains of runs, best per stretch of text."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for end, size, state in runs:
            for t, t_end in self.places[state]:
                if t < self.first_phrase:
                    by_template.setdefault(t, []).append((end - size, t_end - size, size))
        out = []
        for t, found in by_template.items():
            found.sort()
            chains: list[tuple[int, int, int, int, int]] = []  # text end, template end, first word, words covered, run
            low = 0
            for start, t_start, size in found:
                while low < len(chains) and chains[low][0] < start - MAX_GAP:
                    low += 1
                best = (0, start)
                for end, t_end, first, covered, _ in chains[low:]:
                    # Runs may overlap by a few words; only what is new counts.
                    over = max(0, end - start, t_end - t_start)
                    if over < size and t_start - t_end <= MAX_GAP + self.sizes[t] // 4:
                        best = max(best, (covered - over, first), key=lambda b: b[0])
                chains.append((start + size, t_start + size, best[1], best[0] + size, size))
            ends: dict[int, tuple[int, int]] = {}
            for end, _, first, covered, _ in chains:
                if covered > ends.get(first, (0, 0))[1]:
                    ends[first] = (end, covered)
            out += [(t, first, end - 1, min(1.0, covered / self.sizes[t])) for first, (end, covered) in ends.items()]
        return out

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Number of words, (word, phrase) of every place of a phrase, spans of templates."""
        words = license_words(text)
        ids = list(map(self.ids.get, words))
        runs, phrases, known = [], [], np.fromiter((i is not None for i in ids), bool, len(ids))
        change = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        starts, ends = change[::2], change[1::2]
        least = min([MIN_MATCH, *self.sizes])
        long = ends - starts >= least
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            self.read(ids[a:b], a, runs, phrases)
        return len(words), phrases, self.spans(runs)


@lru_cache(1)
def automaton() -> LicenseAutomaton:
    return LicenseAutomaton(TEMPLATES, PHRASES)


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, spans array<struct<label:string,first:int,last:int,covered:double>>"
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: places of phrases, labels, the largest covered share of a template, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            rows = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for text in batch.column(1).to_pylist():
                n, phrases, spans = found.scan(text)
                spans = [s for s in sorted(spans, key=lambda s: (s[1], s[0])) if s[3] > 0]
                base = {found.labels[p] for _, p in phrases}
                more = {found.labels[t] for t, _, _, share in spans if share >= COVERED}
                rows["n_words"].append(n)
                rows["n_base"].append(len(phrases))
                rows["first_word"].append(min((i for i, _ in phrases), default=None))
                rows["last_word"].append(max((i for i, _ in phrases), default=None))
                rows["base_labels"].append(",".join(sorted(base)))
                rows["labels"].append(",".join(sorted(base | more)))
                rows["score"].append(1.0 if base else max((s[3] for s in spans), default=0.0))
                rows["spans"].append([
                    {"label": found.labels[t], "first": a, "last": b, "covered": c} for t, a, b, c in spans if c >= COVERED
                ])
            kinds = dict(n_words=pa.int64(), n_base=pa.int64(), first_word=pa.int64(), last_word=pa.int64(),
                         base_labels=pa.string(), labels=pa.string(), score=pa.float64(),
                         spans=pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()),
                                                   ("last", pa.int32()), ("covered", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[c], k) for c, k in kinds.items())], ["doc_id", *kinds]
            )

    return plain_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op6_query(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).drop("spans")

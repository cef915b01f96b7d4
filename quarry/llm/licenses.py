"""License scan with a generalised suffix automaton of licence texts.

The automaton accepts every run of words of every template.  Streaming a
document through it gives the matching statistics: the longest run that ends
at each word and occurs in some template; suffix links lead on to the shorter
runs of the other templates.  Runs that cannot be extended and have at least
``MIN_MATCH`` words are a template's matches.  Its best chain is the largest
set of word pairs out of its matches that increases in both texts, at any
distance; the share of a template's words that the chain covers is its
coverage.  A template covered by at least ``MIN_COVERAGE`` gives its label.
The chain is a longest increasing subsequence, so it takes n log n steps.

Four short phrases are looked for on their own ("base"): all places where
their words stand consecutively.  A phrase is a template of its own that is
covered whole, so it gives its label with score 1.  The score of a document is
the largest coverage of a reported label, 0 without one.

The automaton has a fixed size, and the scan is one map pass.  Words outside
the templates reset the automaton, so only runs of at least ``MIN_MATCH``
template words are walked; word hashes are compared for whole slices at once.

Defined results: a null text is the empty text: no words, labels "", score 0,
first and last word null.  Null ids, repeated rows and extra columns change
nothing: each row is scanned on its own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.words import LOWER, WORD, bounds, column, hash_text, lookup, spans, text_slices, words

MIN_MATCH = 6
MIN_COVERAGE = 0.4

# fixed values: phrases, labels and public licence notices
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
               "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
            "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
            "PARTICULAR PURPOSE."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
             "the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met: Redistributions of source code must retain the above "
            "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form "
            "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
            "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
                  "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def split_words(text: str) -> list[bytes]:
    raw = np.frombuffer(text.encode(), np.uint8)
    low = LOWER[raw].tobytes()
    start, end, _ = spans(raw, np.array([0, len(raw)]), WORD)
    return [low[a:b] for a, b in zip(start, end)]


class SuffixAutomaton:
    """States of all word runs of several sequences of small ints.

    ``places[s]`` lists, for states that hold a run of at least ``keep``
    words, the (sequence, last position) pairs where the state's runs end.
    """

    def __init__(self, sequences: list[list[int]], keep: int):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[set[tuple[int, int]]] = [set()]
        for k, seq in enumerate(sequences):
            last = 0
            for pos, word in enumerate(seq):
                last = self._extend(last, word, own)
                own[last].add((k, pos))
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__, reverse=True):
            own[self.link[s]] |= own[s]
        self.places = [sorted(p) if self.length[s] >= keep else [] for s, p in enumerate(own)]

    def _state(self, length: int, step: dict[int, int], link: int, own) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        own.append(set())
        return len(self.step) - 1

    def _split(self, at: int, word: int, own) -> int:
        """The state reached from ``at`` by ``word`` whose longest run is one word longer than at's."""
        q = self.step[at][word]
        if self.length[q] == self.length[at] + 1:
            return q
        clone = self._state(self.length[at] + 1, dict(self.step[q]), self.link[q], own)
        self.link[q] = clone
        while at >= 0 and self.step[at].get(word) == q:
            self.step[at][word] = clone
            at = self.link[at]
        return clone

    def _extend(self, last: int, word: int, own) -> int:
        if word in self.step[last]:
            return self._split(last, word, own)
        new = self._state(self.length[last] + 1, {}, 0, own)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word, own)
        return new

    def statistics(self, run):
        """(state, matched length) after each word of ``run``."""
        state = length = 0
        for word in run:
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.step[state].get(word, 0)
            length = length + 1 if state else 0
            yield state, length


class Scanner:
    def __init__(self, templates=tuple(TEMPLATES), min_match: int = MIN_MATCH):
        texts = [split_words(t) for _, t in templates]
        names = sorted({w for t in texts for w in t})
        self.labels = [label for label, _ in templates]
        self.sizes = [len(t) for t in texts]
        self.min_match = min_match
        keys = np.array([hash_text(w) for w in names], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        number = {names[o]: i for i, o in enumerate(order)}
        self.sequences = [[number[w] for w in t] for t in texts]
        self.automaton = SuffixAutomaton(self.sequences, min_match)
        self.phrases = [([np.uint64(hash_text(w)) for w in split_words(p)], label) for p, label in PHRASES.items()]

    def matches(self, run, start: int):
        """Matches of at least ``min_match`` words that cannot be extended:
        (template, first word in the document, first word in the template, words)."""
        auto = self.automaton
        for i, (state, length) in enumerate(auto.statistics(run)):
            seen: set[tuple[int, int]] = set()
            while length >= self.min_match:
                for k, pos in auto.places[state]:
                    if (k, pos) not in seen:
                        seen.add((k, pos))
                        if run[i + 1:i + 2] != self.sequences[k][pos + 1:pos + 2] or i + 1 == len(run):
                            yield k, start + i - length + 1, pos - length + 1, length
                state = auto.link[state]
                length = auto.length[state]

    def spans(self, found):
        """Best chain per template: {template: (covered words, [(doc word, template word, words)])}."""
        pairs: dict[int, list[tuple[int, int]]] = {}
        for k, d, t, n in found:
            pairs.setdefault(k, []).extend((d + j, -(t + j)) for j in range(n))
        best: dict[int, tuple[int, list]] = {}
        for k, own in pairs.items():
            # longest increasing subsequence; of one document word, later template words come first
            own.sort()
            ends: list[int] = []
            at: list[int] = []
            before: list[int] = []
            for i, (_, t) in enumerate(own):
                n = bisect_left(ends, -t)
                ends[n:n + 1] = [-t]
                before.append(at[n - 1] if n else -1)
                at[n:n + 1] = [i]
            i, chain = at[-1], []
            while i >= 0:
                chain.append((own[i][0], -own[i][1]))
                i = before[i]
            parts: list[tuple[int, int, int]] = []
            for d, t in reversed(chain):
                if parts and (d, t) == (parts[-1][0] + parts[-1][2], parts[-1][1] + parts[-1][2]):
                    parts[-1] = (*parts[-1][:2], parts[-1][2] + 1)
                else:
                    parts.append((d, t, 1))
            best[k] = len(chain), parts
        return best

    def scan(self, texts, min_coverage: float):
        """One dict per text of an Arrow column."""
        for a, b, data, offs in text_slices(texts):
            h, doc, _, _ = words(data, offs, WORD, LOWER)
            where = bounds(doc, b - a)
            base: dict[int, list] = {}
            for parts, label in self.phrases:
                at = np.flatnonzero(h[:max(0, len(h) - len(parts) + 1)] == parts[0])
                for j, p in enumerate(parts[1:], 1):
                    at = at[h[at + j] == p]
                at = at[doc[at] == doc[at + len(parts) - 1]]
                for i, d in zip(at.tolist(), doc[at].tolist()):
                    base.setdefault(d, []).append((i - int(where[d]), label))
            ids = lookup(self.keys, h)
            inside = ids >= 0
            begin = inside.copy()
            begin[1:] &= ~inside[:-1] | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(begin)
            stop = inside.copy()
            stop[:-1] &= ~inside[1:] | (doc[1:] != doc[:-1])
            stop = np.flatnonzero(stop) + 1
            long = stop - begin >= self.min_match
            found: dict[int, list] = {}
            for s, e in zip(begin[long].tolist(), stop[long].tolist()):
                d = int(doc[s])
                found.setdefault(d, []).extend(self.matches(ids[s:e].tolist(), s - int(where[d])))
            for d in range(b - a):
                places = base.get(d, [])
                best = self.spans(found[d]) if found.get(d) else {}
                cover = {k: n / self.sizes[k] for k, (n, _) in best.items() if n >= min_coverage * self.sizes[k]}
                base_labels = sorted({x for _, x in places})
                labels = sorted({*base_labels, *(self.labels[k] for k in cover)})
                yield {"n_words": int(where[d + 1] - where[d]), "n_base": len(places),
                       "first_word": min((i for i, _ in places), default=None),
                       "last_word": max((i for i, _ in places), default=None),
                       "base_labels": ",".join(base_labels), "labels": ",".join(labels),
                       "score": 1.0 if places else min(1.0, max(cover.values(), default=0.0)),
                       "spans": [{"label": self.labels[k], "coverage": c, "doc_word": s, "template_word": t, "words": n}
                                 for k, c in sorted(cover.items()) for s, t, n in best[k][1]]}


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("coverage", pa.float64()), ("doc_word", pa.int64()),
                             ("template_word", pa.int64()), ("words", pa.int64())]))
_FIELDS = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
           "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": _SPANS}


def scan_licenses(docs: DataFrame, min_coverage: float = MIN_COVERAGE, min_match: int = MIN_MATCH) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score and the covered template spans."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, spans array<struct<label:string,coverage:double,doc_word:long,"
              "template_word:long,words:long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(min_match=min_match)
        for batch in batches:
            rows = list(scanner.scan(column(batch, "text"), min_coverage))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), *[pa.array([r[k] for r in rows], t) for k, t in _FIELDS.items()]],
                names=["doc_id", *_FIELDS])
    return docs.select("doc_id", "text").mapInArrow(run, schema)

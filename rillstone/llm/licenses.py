"""License scan with a generalised suffix automaton over the words of license templates.

A text is streamed through the automaton, which tells at each word the longest stretch ending there that some
template contains (matching statistics). Long stretches are chained, in order and with small gaps, into spans that
cover parts of one template; the share covered is the span's score. Each text is read by itself, in pieces, so
neither the table's size nor a text's length matters.

NULL and empty texts have no words and no labels. Rows are independent, other columns are kept aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Phrases that alone name a license, and the public notices of common licenses.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Released under the MIT License.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY 4.0.",
    ),
}

#: words a stretch must have to be chained, words that may lie between two of a chain, share of a template that names it
LONG, GAP, SHARE = 4, 12, 0.6
PIECE = 1 << 20

#: A-Z to a-z, every other byte that is not part of a word to a space; bytes of other letters stay
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> Iterator[bytes]:
    """Lower-cased words, from pieces of the text, so that a long one is never a list as a whole."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and not (text[end] < "\x80" and FOLD[ord(text[end])] == 32):
            end += 1  # up to the next character between words
        yield from text[at:end].encode().translate(FOLD).split()
        at = end


class Automaton:
    """Generalised suffix automaton: every stretch of words of every template leads to one state."""

    def __init__(self, templates: list[tuple[str, list[bytes]]], phrases: list[tuple[str, list[bytes]]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.templates, self.phrases = templates, phrases
        for _, words in [*templates, *phrases]:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.places = self._places()
        self.ends = self._ends()
        self.stops: dict[tuple[int, int | None, int], list[tuple[int, int, int]]] = {}

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:  # another template has led here already
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def _walk(self, words: list[bytes]) -> Iterator[int]:
        state = 0
        for word in words:
            state = self.next[state][word]
            yield state

    def _places(self) -> list[list[tuple[int, int]]]:
        """Per state the templates, and the word in them, at which its stretches end."""
        places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for t, (_, words) in enumerate(self.templates):
            for at, state in enumerate(self._walk(words)):
                while state > 0:
                    places[state].append((t, at + 1))
                    state = self.link[state]
        return places

    def _holders(self, state: int) -> dict[int, int]:
        """For each template with LONG words or more that end at the state: the state of the longest such words."""
        holders: dict[int, int] = {}
        while state > 0 and self.length[state] >= LONG:
            for t, _ in self.places[state]:
                holders.setdefault(t, state)
            state = self.link[state]
        return holders

    def stopping(self, state: int, follow: int | None, leads: int) -> list[tuple[int, int, int]]:
        """(state of the words, template, place) for each template in which the longest words read so far do not go
        on when the next word leads to ``follow`` from ``leads``, the state itself or an ancestor of it."""
        known = self.stops.get((state, follow, leads))
        if known is None:
            ahead = {} if follow is None else self._holders(follow)
            known = self.stops[state, follow, leads] = []
            for t, holder in self._holders(state).items():
                then = ahead.get(t)
                if then == follow and then is not None:
                    goes_on = holder == leads
                else:
                    goes_on = then is not None and holder != state and self.length[then] == self.length[holder] + 1
                if not goes_on:
                    known += [(holder, t, place) for of, place in self.places[holder] if of == t]
        return known

    def _ends(self) -> list[list[tuple[int, int]]]:
        """Per state the phrases (number, words) that end its stretches; a stretch must be as long as the phrase."""
        final = {}
        for n, (_, words) in enumerate(self.phrases):
            *_, state = self._walk(words)
            final.setdefault(state, []).append((n, len(words)))
        ends = []
        for state in range(len(self.next)):
            found, up = [], state
            while up > 0:
                found += final.get(up, [])
                up = self.link[up]
            ends.append(found)
        return ends


def automaton(templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]) -> Automaton:
    return Automaton(
        [(label, list(words_of(text))) for label, text in templates],
        [(label, list(words_of(text))) for text, label in phrases],
    )


def scan(auto: Automaton, text: str) -> dict:
    """n_words; base: (word, label) of each phrase; spans: (start, end, label, score), words from 0, end exclusive."""
    steps, link, length, ends = auto.next, auto.link, auto.length, auto.ends
    state = matched = at = 0
    base: list[tuple[int, str]] = []
    chains: dict[int, list] = {}
    spans: list[tuple[int, int, str, float]] = []

    def close(t: int) -> None:
        start, end, _, covered = chains.pop(t)
        label, words = auto.templates[t]
        spans.append((start, end, label, covered / len(words)))

    def chain(t: int, place: int, size: int, end: int) -> None:
        """The stretch of ``size`` words before ``end``, which is before ``place`` in the template, joins its chain."""
        first = place - size
        if t in chains:
            start, upto, template_upto, covered = chains[t]
            fresh = place - max(first, template_upto)
            if end - size - upto <= GAP and fresh > 0 and first - template_upto <= GAP:
                chains[t] = [start, end, place, covered + fresh]
                return
            if end <= upto:
                return
            close(t)
        chains[t] = [end - size, end, place, size]

    def stop(follow: int | None, leads: int, end: int) -> None:
        """Chain what the templates have of the words before ``end``, for those in which it ends there."""
        for holder, t, place in auto.stopping(state, follow, leads):
            size = matched if holder == state else length[holder]
            if size >= LONG:
                chain(t, place, size, end)

    for word in words_of(text):
        leads, follow = state, steps[state].get(word)
        while leads and follow is None:
            leads = link[leads]
            follow = steps[leads].get(word)
        if matched >= LONG:
            stop(follow, leads, at)
        if leads != state:
            matched = length[leads]
        state = 0
        if follow is not None:
            state, matched = follow, matched + 1
            for n, size in ends[state]:
                if matched >= size:
                    base.append((at + 1 - size, auto.phrases[n][0]))
        at += 1
    if matched >= LONG:
        stop(None, 0, at)
    for t in list(chains):
        close(t)
    return {"n_words": at, "base": base, "spans": sorted(spans)}


def telling(spans: list[tuple[int, int, str, float]], share: float) -> list[tuple[int, int, str, float]]:
    """The spans without those below ``share`` that lie within one that covers as much of its own template. Spans of one
    template do not overlap, so at most as many as there are templates are open at a time."""
    kept, still_open = [], []
    for span in sorted(spans, key=lambda s: (s[0], -s[1], -s[3])):
        still_open = [s for s in still_open if s[1] > span[0]]
        if span[3] >= share or not any(s[1] >= span[1] and s[3] >= span[3] for s in still_open):
            kept.append(span)
        still_open.append(span)
    return sorted(kept)


SCANNED = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<start:bigint,end:bigint,label:string,score:double>>"
)
SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))


def find_licenses(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    templates: dict[str, tuple[str, ...]] | None = None,
    phrases: dict[str, str] | None = None,
    share: float = SHARE,
) -> DataFrame:
    """One row per document: counts and places of the phrases, labels of phrases and of templates covered by ``share``
    or more, the best score, and the chained spans. A span below ``share`` within one that covers as much of its own
    template is left out of the spans; labels and score take all spans."""
    library = tuple((label, t) for label, each in (templates or TEMPLATES).items() for t in each)
    named = tuple((phrases or PHRASES).items())

    def row(auto: Automaton, doc_id: int | None, body: str | None) -> tuple:
        found = scan(auto, body or "")
        starts = [at for at, _ in found["base"]]
        base = {label for _, label in found["base"]}
        best = max([0.0, *(s[3] for s in found["spans"])])
        labels = base | {s[2] for s in found["spans"] if s[3] >= share}
        spans = [{"start": a, "end": b, "label": label, "score": s} for a, b, label, s in telling(found["spans"], share)]
        return (
            doc_id, found["n_words"], len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), min(best, 1.0), spans,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(library, named)
        ints, texts = [pa.int64()] * 5, [pa.string()] * 2
        names = [c.split(" ")[0] for c in SCANNED.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [row(auto, d, t) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [*ints, *texts, pa.float64(), SPAN], strict=True)], names=names
                )

    return docs.select(F.col(doc).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, SCANNED)

"""Licence scanning with a generalised suffix automaton of licence-text tokens.

The automaton holds every substring of every template.  Streaming a file's words through it gives
matching statistics: at each word the length of the longest run ending there that is a substring of
some template.  Maximal runs are long matches; for each template, matches in the same order in text
and template with small gaps are chained into one span, and a span that covers enough of the
template reports its label.  A phrase template counts wherever the whole phrase stands: a flag on the
automaton's states, inherited along suffix links, says which phrases end at a state.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import LOWER, UPPER, raw_bytes, slices

#: Fixed values of the contract: phrase and label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Usual public licence notices, by label.  Any list of (label, text) can be given instead.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]

MIN_RUN = 2
MAX_GAP = 4
MIN_COVER = 0.7

_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
assert len(UPPER) == len(LOWER) == 26


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_WORDS).split() if text else []


@dataclass
class Automaton:
    """Generalised suffix automaton over word ids.

    step[s]: id -> state; link[s]: longest proper suffix in another class; size[s]: longest run of the
    state; ends[s]: (template, place of the run's last word) for all occurrences; whole[s]: templates
    that end as a whole at this state.
    """

    templates: list[tuple[str, list[bytes]]]
    ids: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])
    whole: list[list[int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        for t, (_, words) in enumerate(self.templates):
            last = 0
            for place, w in enumerate(words):
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
                self.ends[last].append((t, place))
        by_size = sorted(range(1, len(self.size)), key=lambda s: -self.size[s])
        for s in by_size:  # occurrences of a run are occurrences of its suffixes
            if self.link[s] > 0:
                self.ends[self.link[s]] += self.ends[s]
        self.ends = [sorted(set(e)) for e in self.ends]
        length = [len(words) for _, words in self.templates]
        own = [[t for t, p in e if p == length[t] - 1 and length[t] <= self.size[s] and (s == 0 or length[t] > self.size[self.link[s]])] for s, e in enumerate(self.ends)]
        self.whole = [[] for _ in own]
        for s in reversed(by_size):
            self.whole[s] = own[s] + (self.whole[self.link[s]] if self.link[s] > 0 else [])

    def _new(self, size: int, step: dict[int, int], link: int) -> int:
        self.size.append(size)
        self.step.append(step)
        self.link.append(link)
        self.ends.append([])
        return len(self.size) - 1

    def _extend(self, last: int, c: int) -> int:
        q = self.step[last].get(c)
        if q is not None and self.size[q] == self.size[last] + 1:
            return q
        cur = -1 if q is not None else self._new(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = cur
            p = self.link[p]
        if p < 0:
            return cur
        q = self.step[p][c]
        if self.size[q] == self.size[p] + 1:
            target = q
        else:
            target = self._new(self.size[p] + 1, dict(self.step[q]), self.link[q])
            self.link[q] = target
            while p >= 0 and self.step[p].get(c) == q:
                self.step[p][c] = target
                p = self.link[p]
        if cur < 0:
            return target
        self.link[cur] = target
        return cur

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(word place, state, longest run that ends there) for every word some template has."""
        get, step, link, size = self.ids.get, self.step, self.link, self.size
        state = run = 0
        before = -2
        for i, c in enumerate(map(get, words)):
            if c is None:
                continue
            if i != before + 1:
                state = run = 0
            before = i
            while state and c not in step[state]:
                state = link[state]
                run = size[state]
            state = step[state].get(c, 0)
            run = run + 1 if state else 0
            yield i, state, run


def _chain(matches: list[tuple[int, int, int]], length: int, gap: int) -> list[tuple[int, int, float]]:
    """Matches (text start, template start, words) of one template -> spans (text start, text end, share covered).

    Greedy in text order: a match continues the first open chain it follows in both text and template
    within ``gap`` words; overlapping words count once.
    """
    chains: list[list[int]] = []  # text start, text end, template end, covered
    for at, place, n in sorted(matches):
        for c in reversed(chains):
            skip, ahead = at - c[1], place - c[2]
            if ahead == skip <= 0 < skip + n or (0 <= skip <= gap and 0 <= ahead <= gap):
                c[3] += n + min(0, skip)
                c[1], c[2] = at + n, place + n
                break
        else:
            chains.append([at, at + n, place + n, n])
    return [(c[0], c[1], c[3] / length) for c in chains]


def scan(auto: Automaton, phrases: int, words: list[bytes], min_run: int = MIN_RUN, gap: int = MAX_GAP, min_cover: float = MIN_COVER) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
    """One text -> places of whole phrases (template < ``phrases``, start) and spans (template, start, end, share)."""
    places: list[tuple[int, int]] = []
    matches: dict[int, list[tuple[int, int, int]]] = {}
    held: tuple[int, int, int] | None = None
    templates = auto.templates

    def keep(i: int, state: int, run: int) -> None:
        for t, p in auto.ends[state]:
            if t >= phrases:
                matches.setdefault(t, []).append((i - run + 1, p - run + 1, run))

    for i, state, run in auto.statistics(words):
        for t in auto.whole[state]:
            # a state's whole templates are at most its longest run, which may exceed the run read so far
            if t < phrases and len(templates[t][1]) <= run:
                places.append((t, i - len(templates[t][1]) + 1))
        if held and not (i == held[0] + 1 and run == held[2] + 1) and held[2] >= min_run:
            keep(*held)
        held = (i, state, run)
    if held and held[2] >= min_run:
        keep(*held)
    spans = [(t, a, z, min(share, 1.0)) for t, m in matches.items() for a, z, share in _chain(m, len(templates[t][1]), gap) if share >= min_cover]
    return places, sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def license_spans(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, min_cover: float = MIN_COVER) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, n_words, phrases (start, label) and spans (start, end, label, share); one row each.

    Null and empty texts have no words and empty lists.  Repeated rows and null ids stay; other columns are ignored.
    """
    named = list((PHRASES if phrases is None else phrases).items())
    all_templates = [(label, words_of(text.encode())) for text, label in named] + [(label, words_of(text.encode())) for label, text in (TEMPLATES if templates is None else templates)]
    if not all(w for _, w in all_templates):
        raise ValueError("a template or phrase has no word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Automaton(all_templates)
        hit = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))
        for b in slices(batches):
            n_words, found, covered = [], [], []
            for text in raw_bytes(b, "text"):
                words = words_of(text)
                places, spans = scan(auto, len(named), words, min_cover=min_cover)
                n_words.append(len(words))
                found.append([{"start": at, "label": all_templates[t][0]} for t, at in places])
                covered.append([{"start": a, "end": z, "label": all_templates[t][0], "share": s} for t, a, z, s in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(found, hit), pa.array(covered, span)], ["doc_id", "n_words", "phrases", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, phrases array<struct<start:long,label:string>>, spans array<struct<start:long,end:long,label:string,share:double>>")

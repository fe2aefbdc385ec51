"""License scans: matching statistics of token streams against licence templates.

A generalised suffix automaton of all template tokens reads each text once and
tells at every token how long a run of template tokens ends there.  Runs that
cannot be lengthened are chained in template order into covered spans.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Fixed phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices and openings of public licences, by label.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD License"),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.translate(UPPER)) if text else []


class SuffixAutomaton:
    """Of several token sequences; a state knows its longest length, link and where its runs end."""

    def __init__(self, sequences: list[list[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        self._ends = ends
        for k, sequence in enumerate(sequences):
            last = 0
            for i, token in enumerate(sequence):
                last = self._add(last, token)
                ends[last].add((k, i + 1))
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            ends[self.link[s]] |= ends[s]
        self.ends = [sorted(e) for e in ends]

    def _state(self, length: int, link: int, edges: dict[str, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self._ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, token: str, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, token: str) -> int:
        q = self.next[last].get(token)
        if q is not None:  # the sequence so far is already part of another one
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def runs(self, words: list[str], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of matched runs of ``least`` tokens or more that the next token does not lengthen."""
        out, state, n = [], 0, 0
        root, following = self.next[0], self.next
        for i, word in enumerate(words):
            if not state and word not in root:
                continue
            before = (i, n, state)
            edges = following[state]
            while word not in edges and state:
                state = self.link[state]
                n = self.length[state]
                edges = following[state]
            if word in edges:
                state, n = edges[word], n + 1
            else:
                state = n = 0
            if before[1] >= least and n <= before[1]:
                out.append(before)
        if n >= least:
            out.append((len(words), n, state))
        return out


class Scanner:
    """Templates and phrases compiled once a task."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: int, cover: float, gap: int):
        self.labels = [label for label, _ in templates]
        self.sequences = [tokens(text) for _, text in templates]
        self.automaton = SuffixAutomaton(self.sequences)
        self.least, self.cover, self.gap = least, cover, gap
        self.phrases = defaultdict(list)
        for phrase, label in PHRASES:
            first, *rest = phrase.split()
            self.phrases[first].append((rest, label))

    def base(self, words: list[str]) -> list[tuple[int, str]]:
        """Places and labels of the fixed phrases."""
        out = []
        for first, options in self.phrases.items():
            at = -1
            for _ in range(words.count(first)):
                at = words.index(first, at + 1)
                out += [(at, label) for rest, label in options if words[at + 1 : at + 1 + len(rest)] == rest]
        return sorted(out)

    def spans(self, words: list[str]) -> list[tuple[int, int, str, float]]:
        """(start, end, label, share) of chains that cover enough of a template."""
        pieces = defaultdict(list)
        for end, n, state in self.automaton.runs(words, self.least):
            for k, stop in self.automaton.ends[state]:
                pieces[k].append((end - n, end, stop - n, stop))
        out = []
        for k, found in pieces.items():
            # Longest chain that goes forward in text and template; a piece may overlap the one before.
            best: list[tuple[int, int, int]] = []
            for j, (a, b, c, d) in enumerate(found):
                score, begin, back = b - a, a, -1
                for i in range(j - 1, -1, -1):
                    a0, b0, c0, d0 = found[i]
                    if a - b0 > self.gap:
                        break
                    if a0 < a and b0 < b and c0 < c and d0 < d:
                        gain = best[i][0] + (b - a) - max(0, b0 - a, d0 - c)
                        if gain > score:
                            score, begin, back = gain, best[i][1], i
                best.append((score, begin, back))
            whole = len(self.sequences[k])
            for (score, begin, _), piece in zip(best, found, strict=True):
                if score >= self.cover * whole:
                    out.append((begin, piece[1], self.labels[k], score / whole))
        # Of overlapping spans the one that covers more tokens of its template stays.
        out.sort(key=lambda s: (-(s[1] - s[0]) * s[3], s[0], s[2]))
        kept: list[tuple[int, int, str, float]] = []
        for s in out:
            if all(s[1] <= t[0] or s[0] >= t[1] for t in kept):
                kept.append(s)
        return sorted(kept)


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: int = 3,
    cover: float = 0.8,
    gap: int = 8,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, n_words, the fixed phrases' places, and template spans with labels and score.

    ``least`` tokens make a run, runs at most ``gap`` tokens apart make a chain,
    and a chain over ``cover`` of a template makes a span.  The score is the
    largest covered share, and 1 where a fixed phrase stands.  Null and empty
    texts have no words, no places and score 0.  Rows are independent: one pass,
    no shuffle, one text in memory at a time.
    """
    picked = docs.select(*keep, "text")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType()), T.StructField("share", T.DoubleType())])
    schema = T.StructType(
        [f for f in picked.schema.fields if f.name != "text"]
        + [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
        + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least, cover, gap)
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 512):
                batch = whole.slice(at, 512)
                n, count, first, last, base, every, score, spans = ([] for _ in range(8))
                for value in batch.column("text"):
                    words = tokens(value.as_py())
                    places = scanner.base(words)
                    found = scanner.spans(words)
                    n.append(len(words))
                    count.append(len(places))
                    first.append(places[0][0] if places else None)
                    last.append(places[-1][0] if places else None)
                    base.append(",".join(sorted({x for _, x in places})))
                    every.append(",".join(sorted({x for _, x in places} | {x[2] for x in found})))
                    score.append(1.0 if places else max((x[3] for x in found), default=0.0))
                    spans.append([dict(zip(("start", "end", "label", "share"), x, strict=True)) for x in found])
                columns = [batch.column(c) for c in batch.schema.names if c != "text"]
                columns += [pa.array(x, pa.int64()) for x in (n, count, first, last)]
                columns += [pa.array(base, pa.string()), pa.array(every, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return picked.mapInArrow(scan, schema)

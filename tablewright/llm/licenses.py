"""License scans: fingerprints of templates pick candidates, banded alignment measures them.

Templates are winnowed: of every WINDOW neighbouring word grams the smallest hash is a fingerprint, so any shared run of
GRAM + WINDOW - 1 words holds one; templates shorter than that keep all their grams. An inverted index takes the
grams of a text to places in templates. Hits near one diagonal are one candidate: text and template are aligned word by word
within a band around it, and the longest common subsequence gives the matched share of the template and the span in the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import texts, worker_cache

GRAM, WINDOW = 4, 4
BAND = 24  # words that a match may have more or less than its template, to either side of its diagonal
COVERAGE = 0.8

#: License notices as their publishers word them.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or"
        ' substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
}

_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Match:
    license: str
    start: int  # in words
    end: int
    matched: int
    size: int

    @property
    def coverage(self) -> float:
        return self.matched / self.size


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the smallest hash of every WINDOW neighbours, the last of equals; all if there are fewer."""
    if len(hashes) <= WINDOW:
        return np.arange(len(hashes))
    view = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
    return np.unique(np.arange(len(view)) + WINDOW - 1 - view[:, ::-1].argmin(axis=1))


def _scrambled(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)


class TemplateIndex:
    """The inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.vocabulary: dict[bytes, int] = {}
        self.names, self.words = [], []
        for name, variants in sorted(templates.items()):
            for v in variants:
                w = words_of(v)
                if len(w) < GRAM:
                    raise ValueError(f"template too short: {v!r}")
                self.names.append(name)
                self.words.append(np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], np.int64))
        self.base = len(self.vocabulary) + 1
        if self.base**GRAM >= 1 << 63:
            raise ValueError("too many different words in the templates")
        entries = []
        for t, w in enumerate(self.words):
            grams = self.grams(w)
            keep = winnowed(_scrambled(grams)) if len(w) >= GRAM + WINDOW - 1 else np.arange(len(grams))
            entries += [(int(grams[k]), t, int(k)) for k in keep]
        entries.sort()
        self.keys, self.template, self.place = (np.array(x, np.int64) for x in zip(*entries, strict=True))

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of the word grams; 0 for those with a word that no template has."""
        n = len(ids) - GRAM + 1
        if n < 1:
            return np.empty(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            out = out * self.base + ids[k : k + n]
            known &= ids[k : k + n] > 0
        return np.where(known, out, 0)

    def candidates(self, ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(template, rows of place in the text and diagonal) of hits that lie together; a diagonal is the text's place less the template's."""
        grams = self.grams(ids)
        low, high = np.searchsorted(self.keys, grams, "left"), np.searchsorted(self.keys, grams, "right")
        n = np.where(grams > 0, high - low, 0)
        at = np.flatnonzero(n)
        if not len(at):
            return []
        n = n[at]
        entry = np.repeat(low[at], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        template, diagonal = self.template[entry], np.repeat(at, n) - self.place[entry]
        order = np.lexsort((diagonal, template))
        template, diagonal, place = template[order], diagonal[order], np.repeat(at, n)[order]
        new = np.concatenate([[True], (template[1:] != template[:-1]) | (diagonal[1:] - diagonal[:-1] > BAND)])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(new)) - 1
        return [(int(template[s]), np.stack([place[s : e + 1], diagonal[s : e + 1]], axis=1)) for s, e in zip(starts, ends, strict=True)]

    def align(self, ids: np.ndarray, template: int, low: int, high: int, begin: int = 0, band: int = BAND) -> Match | None:
        """The longest common subsequence of template and text from ``begin`` on diagonals from ``low - band`` to ``high + band``."""
        t = self.words[template]
        first = low - band
        width = high - low + 2 * band + 1
        best = np.zeros((len(t) + 1, width + 1), np.int32)  # a spare column at the end
        columns = np.arange(width)
        for i, w in enumerate(t.tolist()):
            j = i + first + columns
            inside = (j >= begin) & (j < len(ids))
            same = inside & (ids[np.clip(j, 0, len(ids) - 1)] == w)
            row = np.maximum(best[i, 1:], best[i, :-1] + same)
            best[i + 1, :-1] = np.maximum.accumulate(row)
        i, b = len(t), int(best[len(t), :-1].argmax())
        matched, places = int(best[i, b]), []
        while i > 0 and best[i, b] > 0:  # the way back
            j = i - 1 + first + b
            if begin <= j < len(ids) and ids[j] == t[i - 1] and best[i, b] == best[i - 1, b] + 1:
                places.append(j)
                i -= 1
            elif best[i, b] == best[i - 1, b + 1]:
                i, b = i - 1, b + 1
            else:
                b -= 1
        if not places:
            return None
        return Match(self.names[template], places[-1], places[0] + 1, matched, len(t))

    def aligned(self, ids: np.ndarray, template: int, hits: np.ndarray, least: float) -> list[Match]:
        """Matches of a candidate: no hit is left that no accepted or refused alignment covers. Copies differ by
        about the template's length in diagonal, so a window of half of that is aligned at a time, behind the matches before it."""
        size, out = len(self.words[template]), []
        place, diagonal = hits[:, 0], hits[:, 1]
        reach = min(BAND, max(1, size // 2))
        left = np.ones(len(hits), bool)
        while left.any():
            low = int(diagonal[left].min())  # the earliest copy that is left
            of = left & (diagonal <= low + reach)
            begin = max([m.end for m in out if m.end <= place[of].min()], default=0)
            m = self.align(ids, template, low, int(diagonal[of].max()), begin)
            if not m or m.matched < least * m.size or m.matched < least * (m.end - m.start):  # words of a neighbour may be mixed in: one diagonal by itself
                tries = (self.align(ids, template, d, d, max(begin, d), band) for d in np.unique(diagonal[of]).tolist() for band in (0, BAND))
                fit = [x for x in tries if x and x.matched >= least * x.size and x.matched >= least * (x.end - x.start)]
                m = max(fit, key=lambda x: (x.matched, x.start - x.end, -x.start), default=None)
            if m:
                out.append(m)
                left &= ~((place >= m.start) & (place < m.end))
            left &= diagonal > low
        return out

    def scan(self, ids: np.ndarray, least: float = COVERAGE) -> list[Match]:
        """Matches that do not overlap: those with the most matched words first, then of the higher share, then the earlier."""
        found = [m for c in self.candidates(ids) for m in self.aligned(ids, *c, least)]
        out: list[Match] = []
        for m in sorted(set(found), key=lambda m: (-m.matched, -m.coverage, m.start, m.license)):
            if all(m.end <= o.start or o.end <= m.start for o in out):
                out.append(m)
        return sorted(out, key=lambda m: m.start)


def _index(templates: tuple[tuple[str, tuple[str, ...]], ...]) -> TemplateIndex:
    return worker_cache(("licenses", hash(templates)), lambda: TemplateIndex(dict(templates)))


KIND = "array<struct<license:string,start:long,end:long,matched:long,words:long>>"
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("words", pa.int64())]))


def with_licenses(df: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, text: str = "text", least: float = COVERAGE, name: str = "licenses") -> DataFrame:
    """``df`` with the license notices of each text: license, span in code points (end exclusive), matched words, words of the template.

    Null and empty texts have none. Repeated rows stay; a column called ``name`` is replaced. Templates are a parameter and go to every
    task, so they should be some hundreds, not a corpus.
    """
    fixed = tuple(sorted((k, tuple(v)) for k, v in (templates or TEMPLATES).items()))

    def scan(column: pa.Array) -> pa.Array:
        index, rows = _index(fixed), []
        for t in texts(column):
            ids = np.array([index.vocabulary.get(w, 0) for w in words_of(t)], np.int64)
            found = index.scan(ids, least) if len(ids) >= GRAM else []
            spans = [m.span() for m in _WORD.finditer(t)] if found else []
            rows.append([{"license": m.license, "start": spans[m.start][0], "end": spans[m.end - 1][1], "matched": m.matched, "words": m.size} for m in found])
        return pa.array(rows, _ARROW)

    return df.withColumn(name, F.arrow_udf(scan, KIND).asNondeterministic()(F.col(text)))  # so that it runs once, however often it is read

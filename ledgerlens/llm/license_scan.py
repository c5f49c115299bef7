"""License scan (operator 7).

Texts are compared in a normal form (letters and digits in lower case, other runs
as one space).  Templates of at most ``NOTICE_WORDS`` words are looked up by their
words: wherever a stretch of a text, a template long and ``DRIFT`` more, holds as
many of them as ``COVERAGE`` asks for, it is a candidate region.  Longer ones, bodies of
licenses, are looked up by fingerprints: of the hashes of a text's 12-grams those that
are the least of some 8 in a row (winnowing), so a text that shares a run of 19
characters with a template shares a fingerprint.  Their fingerprints form
an inverted index; where a document's fingerprints hit it, hits of one template on
nearby diagonals make a candidate region.  The words of template and region are
then aligned, and the region is reported if at least ``COVERAGE`` of
the template's words are matched.  Of overlapping regions the best one stays.

The templates are a parameter, a small list; their index is broadcast.  Documents
are read whole and not shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import ship_package, slices
from ledgerlens.llm.license_texts import BODIES
from ledgerlens.llm.qgram_decontam import BREAK, WINDOW, Normal

GRAM, WINNOW = 12, 8
COVERAGE = 0.8
#: Words that a region may have more or fewer than its template, as a share of it.
DRIFT = 0.25
#: Templates of at most so many words are looked up by their words, longer ones by fingerprints.
NOTICE_WORDS = 64
#: The templates' texts may have so many characters in all (the index is some 20 times that).
MAX_TEMPLATE_CHARS = 4 << 20

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may
not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
_LESSER = """This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} General Public
License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""

#: (license, template): texts of common licenses, and the lines by which works name one.
TEMPLATES = (
    ("MIT", _MIT), ("MIT-warranty", _MIT_WARRANTY), ("BSD", _BSD), ("Apache-2.0", _APACHE), ("ISC", _ISC),
    ("GPL-2.0", _GPL.format(2)), ("GPL-3.0", _GPL.format(3)), ("AGPL-3.0", _LESSER.format("program", "Affero", 3)),
    *((f"LGPL-{v if '.' in v else v + '.0'}", _LESSER.format(work, kind, v)) for work in ("library", "program")
      for kind, v in (("Library", "2"), ("Lesser", "2.1"), ("Lesser", "3"))),
    ("BSD-disclaimer", _BSD_DISCLAIMER), ("Unlicense", _UNLICENSE), ("Zlib", _ZLIB), *BODIES,
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    *((f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.") for v in ("3.0", "4.0") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the 12-gram that begins at each place."""
    if len(codes) < GRAM:
        return np.zeros(0, np.uint32)
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:]
    four = two[:-2] * np.uint32(0x85EBCA77) + two[2:]
    four = (four ^ (four >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
    eight = four[:-4] * np.uint32(0x27D4EB2F) + four[4:]
    h = eight[:-4] * np.uint32(0x165667B1) + four[8:]
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x9E3779B1)
    return h ^ (h >> np.uint32(14))


def winnow(h: np.ndarray) -> np.ndarray:
    """Places of the hashes that are the least of some 8 in a row; of fewer than 8, of all."""
    if not len(h):
        return np.zeros(0, np.int64)
    if len(h) <= WINNOW:
        return np.flatnonzero(h == h.min())

    def over(v: np.ndarray, pick) -> np.ndarray:
        for step in (1, 2, 4):
            v = pick(v[:-step], v[step:])
        return v

    least = over(h, np.minimum)  # of the window that begins at each place
    edge = np.zeros(WINNOW - 1, h.dtype)
    # A hash is a fingerprint if it is the least of a window over it: the largest of those windows' least is itself.
    return np.flatnonzero(over(np.concatenate([edge, least, edge]), np.maximum) == h)


def words(codes: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of a normal form, and where each begins and ends."""
    edge = np.diff(np.concatenate([[0], (codes != 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    raw = np.ascontiguousarray(codes).tobytes()
    return [raw[4 * s:4 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], starts, ends


def word_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each word of normal forms with breaks between them, and where it begins and ends."""
    real = (codes != 0) & (codes != BREAK)
    edge = np.diff(np.concatenate([[0], real.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    at, size = np.flatnonzero(real), ends - starts
    place = at - np.repeat(starts, size)
    h = np.add.reduceat(codes[at].astype(np.uint64) * _FACTORS[np.minimum(place, len(_FACTORS) - 1)], np.cumsum(size) - size)
    return h, starts, ends


def _factors(n: int = 64) -> np.ndarray:
    h = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(27))) | np.uint64(1)


#: A factor for each place in a word.
_FACTORS = _factors()


def align(template: Sequence[bytes], region: Sequence[bytes], band: int) -> list[tuple[int, int]]:
    """Matched (template word, region word) pairs of a best alignment of the whole
    template with a part of the region: fewest substituted, left out and inserted
    words.  Row i is kept at region places c - band .. c + band around the place c
    where it would be if both were stretched alike."""
    m, n = len(template), len(region)
    if not m or not n:
        return []
    number: dict = {}
    t, r = (np.array([number.setdefault(w, len(number)) for w in x], np.int32) for x in (template, region))
    big = m + n + 1
    low = [max(0, i * n // m - band) for i in range(m + 1)]
    high = [min(n, i * n // m + band) for i in range(m + 1)]
    # cost[j + 1] is of region place j; big outside of the row.
    cost = np.full(n + 2, big, np.int32)
    cost[low[0] + 1:high[0] + 2] = 0
    step = np.arange(n + 1, dtype=np.int32)
    other = np.ones(n + 1, np.int32)
    steps: list[np.ndarray] = []
    for i in range(1, m + 1):
        a, z = low[i], high[i] + 1
        other[1:] = r != t[i - 1]
        up = cost[a + 1:z + 1] + 1
        diagonal = cost[a:z] + other[a:z]
        new = np.minimum(diagonal, up)
        # Left moves: the least of (cost at k) + (j - k) over k <= j.
        new = np.minimum.accumulate(new - step[:z - a]) + step[:z - a]
        steps.append(np.where(new == diagonal, 0, np.where(new == up, 1, 2)).astype(np.int8))
        cost[low[i - 1] + 1:a + 1] = big
        cost[a + 1:z + 1] = new
    i, j = m, low[m] + int(np.argmin(cost[low[m] + 1:high[m] + 2]))
    out = []
    while i:
        how = steps[i - 1][j - low[i]]
        if how == 0:
            if t[i - 1] == r[j - 1]:
                out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif how == 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


class Index:
    """Words of the templates, and fingerprints of the long ones."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        if sum(len(t) for _, t in templates) > MAX_TEMPLATE_CHARS:
            raise ValueError("the templates are too long for one index")
        normal = Normal()
        forms = [normal.form(t)[0] for _, t in templates]
        kept = [(name, f, words(f)[0]) for (name, _), f in zip(templates, forms, strict=True) if len(f) >= GRAM]
        self.names, self.words = [name for name, _, _ in kept], [w for _, _, w in kept]
        self.length = np.array([len(f) for _, f, _ in kept], np.int64)
        self.bags = [Counter(w) for w in self.words]
        # Which notice has which words, each word with a number.
        self.notices = [t for t, w in enumerate(self.words) if len(w) <= NOTICE_WORDS]
        hashed = [word_hashes(kept[t][1])[0] for t in self.notices]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]))
        self.has = np.zeros((len(self.vocabulary), len(self.notices)), np.float32)
        for k, h in enumerate(hashed):
            self.has[np.searchsorted(self.vocabulary, h), k] = 1
        grams = [gram_hashes(f) if len(w) > NOTICE_WORDS else gram_hashes(f[:0]) for _, f, w in kept]
        at = [winnow(h) for h in grams]
        hashes = np.concatenate([np.zeros(0, np.uint32), *(h[a] for h, a in zip(grams, at, strict=True))])
        order = np.argsort(hashes, kind="stable")
        self.hash, first = np.unique(hashes[order], return_index=True)
        self.first = np.append(first, len(hashes))
        self.template = np.repeat(np.arange(len(kept)), [len(a) for a in at])[order] if kept else order
        self.place = np.concatenate([np.zeros(0, np.int64), *at])[order]
        self.table = np.zeros(1 << 20, bool)
        self.table[self.hash >> np.uint32(12)] = True

    def need(self, t: int, coverage: float) -> int:
        """Words of a template that a region has to match."""
        return max(1, math.ceil(coverage * len(self.words[t])))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the notices' vocabulary, or -1."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        k = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[k] == hashes, k, -1)

    def noticed(self, number: np.ndarray, doc: np.ndarray, docs: int, coverage: float) -> np.ndarray:
        """For documents and notices, if the document has as many different words of
        the notice as any region needs: all but those that may stay unmatched."""
        known = number >= 0
        present = np.zeros((docs, len(self.vocabulary)), np.float32)
        present[doc[known], number[known]] = 1
        least = [len(self.bags[t]) - len(self.words[t]) + self.need(t, coverage) for t in self.notices]
        return present @ self.has >= np.array(least, np.float32)

    def covers(self, t: int, region: Sequence[bytes], coverage: float) -> bool:
        """If the region has enough of the template's words, in whatever order."""
        need = self.need(t, coverage)
        if len(region) < need:
            return False
        bag = Counter(region)
        return sum(min(n, bag[w]) for w, n in self.bags[t].items()) >= need

    def notice_matches(self, codes: np.ndarray, coverage: float) -> list[tuple[int, int, int, int]]:
        """As :meth:`matches`, of the notices."""
        hashes, starts, ends = word_hashes(codes)
        number = self.numbers(hashes)
        fits = np.flatnonzero(self.noticed(number, np.zeros(len(number), np.int64), 1, coverage)[0])
        if not len(fits) or not len(number):
            return []
        out, all_words = [], words(codes)[0]
        for k in fits.tolist():
            t = self.notices[k]
            need, size = self.need(t, coverage), len(self.words[t])
            reach = size + max(2, int(size * DRIFT))
            mine = (self.has[number, k] > 0) & (number >= 0)
            count = np.concatenate([[0], np.cumsum(mine)])
            at = np.flatnonzero(mine)
            at = at[count[np.minimum(at + reach, len(mine))] - count[at] >= need]
            # Stretches of candidate starts, taken in pieces so that each region lies within one of them.
            for group in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1) if len(at) else []:
                for a in range(int(group[0]), int(group[-1]) + 1, reach):
                    piece = group[(group >= a) & (group < a + reach)]
                    if not len(piece):
                        continue
                    todo = [(int(piece[0]), min(int(piece[-1]) + reach, len(all_words)))]
                    while todo:
                        lo, hi = todo.pop()
                        region = all_words[lo:hi]
                        if not self.covers(t, region, coverage):
                            continue
                        pairs = align(self.words[t], region, hi - lo)
                        if len(pairs) >= need:
                            first, last = lo + pairs[0][1], lo + pairs[-1][1]
                            out.append((t, len(pairs), int(starts[first]), int(ends[last])))
                            todo += [(lo, first), (last + 1, hi)]
                        elif hi - lo > reach:
                            # The fewest edits leave too few words matched here; each start is tried by itself.
                            todo += [(s, min(s + reach, hi)) for s in piece.tolist() if lo <= s < hi]
        return out

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first, last diagonal) of hits whose diagonals lie close together."""
        h = gram_hashes(codes)
        at = winnow(h)
        at = at[self.table[h[at] >> np.uint32(12)]]
        if not len(at) or not len(self.hash):
            return []
        k = np.minimum(np.searchsorted(self.hash, h[at]), len(self.hash) - 1)
        known = self.hash[k] == h[at]
        at, k = at[known], k[known]
        n = self.first[k + 1] - self.first[k]
        if not len(n):
            return []
        entry = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        template = self.template[entry]
        diagonal = np.repeat(at, n) - self.place[entry]
        by = np.lexsort((diagonal, template))
        template, diagonal = template[by], diagonal[by]
        near = (self.length[template] * DRIFT).astype(np.int64) + GRAM
        new = np.ones(len(by), bool)
        new[1:] = (template[1:] != template[:-1]) | (np.diff(diagonal) > near[1:])
        cuts = [*np.flatnonzero(new).tolist(), len(by)]
        return [(int(template[a]), int(diagonal[a]), int(diagonal[z - 1])) for a, z in zip(cuts, cuts[1:], strict=False)]

    def matches(self, codes: np.ndarray, coverage: float) -> list[tuple[int, int, int, int]]:
        """(template, matched words, start, end) in normal form."""
        out = self.notice_matches(codes, coverage)
        for t, lo, hi in self.candidates(codes):
            m, drift = int(self.length[t]), int(self.length[t] * DRIFT) + GRAM
            # A long stretch of hits holds several copies: it is aligned piece by piece, each a template's length on.
            for d in range(lo, hi + 1, m):
                a, z = max(0, d - drift), min(len(codes), min(d + m, hi) + m + drift)
                region, starts, ends = words(codes[a:z])
                if not self.covers(t, region, coverage):
                    continue
                pairs = align(self.words[t], region, max(3, abs(len(region) - len(self.words[t])) + int(len(self.words[t]) * DRIFT)))
                if len(pairs) >= coverage * len(self.words[t]):
                    out.append((t, len(pairs), a + int(starts[pairs[0][1]]), a + int(ends[pairs[-1][1]])))
        return out


class Scanner:
    def __init__(self, index: Index, coverage: float):
        self.index, self.coverage, self.normal = index, coverage, Normal()
        self.overlap = int(index.length.max(initial=0)) * 3 + 4 * GRAM

    def in_texts(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """(template, matched words, start, end) for each text, in places of the
        text; of overlapping ones the one with most matched words, then the best covered, the first."""
        out: list[list] = [[] for _ in texts]
        group: list[int] = []
        size = 0
        for i, t in enumerate([*texts, None]):
            if group and (t is None or size + len(t) > WINDOW):
                for k in self._hit(texts, group):
                    out[k] = self._text(texts[k])
                group, size = [], 0
            if t is not None:
                group.append(i)
                size += len(t) + 1
        return out

    def _hit(self, texts: list[str], group: list[int]) -> list[int]:
        """Texts of the group with a gram of the index or words of a notice, looked at as one."""
        if len(group) == 1:
            return group
        forms = [self.normal.form(texts[i])[0] for i in group]
        codes = np.concatenate([x for f in forms for x in (f, np.array([BREAK], np.uint32))])
        starts = np.cumsum([0, *(len(f) + 1 for f in forms[:-1])])
        hashes, first, _ = word_hashes(codes)
        doc = np.searchsorted(starts, first, side="right") - 1
        noticed = self.index.noticed(self.index.numbers(hashes), doc, len(group), self.coverage).any(axis=1)
        h = gram_hashes(codes)
        at = np.flatnonzero(self.index.table[h >> np.uint32(12)])
        if not len(self.index.hash) or not len(at):
            return [group[i] for i in np.flatnonzero(noticed).tolist()]
        k = np.minimum(np.searchsorted(self.index.hash, h[at]), len(self.index.hash) - 1)
        at = at[self.index.hash[k] == h[at]]
        noticed[np.searchsorted(starts, at, side="right") - 1] = True
        return [group[i] for i in np.flatnonzero(noticed).tolist()]

    def _text(self, text: str) -> list[tuple[int, int, int, int]]:
        codes, places = self.normal.form(text)
        found = set()
        step = max(WINDOW, 2 * self.overlap)
        for at in range(0, max(len(codes), 1), step):
            for t, k, s, e in self.index.matches(codes[at:at + step + self.overlap], self.coverage):
                found.add((t, k, int(places[s + at]), int(places[e + at - 1]) + 1))
        out: list[tuple[int, int, int, int]] = []
        for m in sorted(found, key=lambda m: (-m[1], -m[1] / len(self.index.words[m[0]]), m[2], m[3], m[0])):
            if all(m[3] <= o[2] or m[2] >= o[3] for o in out):
                out.append(m)
        return sorted(out, key=lambda m: m[2])


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, license, coverage, matched_words, start, end`` for each region of a
    text (code points of the text as it is) that covers a template.

    A null text is empty.  Repeated documents give repeated rows, null ids are
    kept, other columns ignored; templates of fewer than 12 characters in normal
    form are left out."""
    ship_package(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(Index(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(index.value, coverage)
        names, size = index.value.names, [len(w) for w in index.value.words]
        for b in slices(batches):
            ids = b.column(0).to_pylist()
            got = scanner.in_texts([t or "" for t in b.column(1).to_pylist()])
            rows = [(ids[k], names[t], n / size[t], n, s, e) for k, ms in enumerate(got) for t, n, s, e in ms]
            if rows:
                kinds = [b.schema.types[0], pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 [id_col, "license", "coverage", "matched_words", "start", "end"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, license string, coverage double, matched_words bigint, start bigint, end bigint")

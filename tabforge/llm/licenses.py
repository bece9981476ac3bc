"""License scans with a generalised suffix automaton of license words.

The automaton holds the words of all templates and phrases.  Streaming a text
through it yields, at every word, the longest match with any template that
ends there (matching statistics).  Phrases are read off the automaton's
states; matches of ``MIN_MATCH`` words or more that cannot be extended are
chained, in text and template order, into covered spans of a template.  Every
chain that covers ``COVER`` of a template's words is a span; where chains of
one template overlap, those that cover the most words together stay.  So a
license that a text holds twice is found twice.

Templates are whole license texts and notices (:data:`WHOLE`), their opening
passages (:data:`TEMPLATES`), and whatever a caller passes, be it a list or a
table (:func:`templates_of`).

Edge cases: a null or empty text has no word, no place and score 0; long texts
are streamed in slices of bounded size; repeated rows give repeated results;
no rows give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame, functions as F

MIN_MATCH = 4
COVER = 0.5
#: Words that two links of a chain may lie apart.
GAP = 12
SLICE_BYTES = 1 << 20

#: Phrases that name a license, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Opening passages of public licenses, and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this work is licensed under a creative commons attribution noncommercial license", "cc-by-nc"),
)

#: Whole texts and notices of public licenses, and their labels.
WHOLE = (
    ("""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "mit"),
    ("""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", "isc"),
    ("""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""", "bsd"),
    ("""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
may not be removed or altered from any source distribution.""", "zlib"),
    ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License.""", "apache-2"),
    ("""This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/.""", "gpl"),
    ("""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means.""", "unlicense"),
)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


class Automaton:
    """Suffix automaton of several word sequences, and what its states mean."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.next, self.link, self.length = [{}], [-1], [0]
        self.phrases = [(p.split(), label) for p, label in phrases]
        cut = [([w.decode() for w in _WORD.findall(t.encode().lower())], label) for t, label in templates]
        self.templates = [(w, label) for w, label in cut if w]
        texts = [w for w, _ in self.templates] + [w for w, _ in self.phrases]
        self.vocabulary = {w.encode(): i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        coded = [[self.vocabulary[w.encode()] for w in t] for t in texts]
        for t in coded:
            last = 0
            for c in t:
                last = self._extend(last, c)
        # where each state's words end in the templates
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for k, t in enumerate(coded[: len(self.templates)]):
            v = 0
            for at, c in enumerate(t):
                v = self.next[v][c]
                s = v
                while s > 0:
                    self.ends[s].append((k, at))
                    s = self.link[s]
        self.kinds = [len({k for k, _ in e}) for e in self.ends]
        # the phrases that end wherever a state (or one it links to) is reached
        own: dict[int, list[int]] = {}
        for k, t in enumerate(coded[len(self.templates):]):
            v = 0
            for c in t:
                v = self.next[v][c]
            own.setdefault(v, []).append(k)
        self.marks = [[] for _ in self.next]
        for v in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            self.marks[v] = own.get(v, []) + self.marks[self.link[v]]
        self.shortest = min([MIN_MATCH, *(len(w) for w, _ in self.phrases)])

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            if self.length[q] == self.length[last] + 1:
                return q
            return self._clone(last, c, q)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin


def word_slices(data: bytes, size: int = SLICE_BYTES):
    """The words of a lower-cased text, list by list."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            cut = _NO_WORD.search(data, end)
            end = cut.start() if cut else len(data)
        yield _WORD.findall(data[at:end])
        at = end


def scan(auto: Automaton, data: bytes):
    """(n_words, phrase places [(phrase, start word)], maximal matches
    [(state, length, end word)]) of a UTF-8 text."""
    import numpy as np

    places, matches, n = [], [], 0
    v = length = 0
    get = auto.vocabulary.get
    for words in word_slices(data.lower()):
        ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        known = np.flatnonzero(ids >= 0)
        if length and len(ids) and ids[0] < 0:
            if length >= MIN_MATCH:
                matches.append((v, length, n - 1))
            v = length = 0
        if len(known):
            breaks = np.flatnonzero(np.diff(known) > 1)
            firsts, lasts = known[np.append(0, breaks + 1)], known[np.append(breaks, len(known) - 1)]
            for a, b in zip(firsts.tolist(), lasts.tolist()):
                last_run = b == len(ids) - 1
                if b - a + 1 < auto.shortest and a > 0 and not last_run:
                    continue
                for i, c in enumerate(ids[a: b + 1].tolist(), n + a):
                    w = auto.next[v].get(c)
                    # the match ends here, for all templates or for those that go on otherwise
                    if length >= MIN_MATCH and (w is None or auto.kinds[w] < auto.kinds[v]):
                        matches.append((v, length, i - 1))
                    if w is None:
                        while v and c not in auto.next[v]:
                            v = auto.link[v]
                        length = auto.length[v]
                    if c in auto.next[v]:
                        v = auto.next[v][c]
                        length += 1
                    for k in auto.marks[v]:
                        size = len(auto.phrases[k][0])
                        if length >= size:
                            places.append((k, i - size + 1))
                if not last_run:
                    if length >= MIN_MATCH:
                        matches.append((v, length, n + b))
                    v = length = 0
        n += len(words)
    if length >= MIN_MATCH:
        matches.append((v, length, n - 1))
    return n, places, matches


def chain(auto: Automaton, matches):
    """Per template the chains that cover ``COVER`` of it, none overlapping
    another: {template: [(covered words, first word, last word)]}, in text order."""
    found: dict[int, list] = {}
    open_: dict[int, list] = {}                       # template -> chains that may go on: (text end, template end, covered, first)
    for v, length, end in matches:
        grown: dict[int, list] = {}
        for k, at in auto.ends[v]:
            start, t_start = end - length + 1, at - length + 1
            covered, first = length, start
            for e, t_e, cov, f in open_.get(k, []):
                fresh = min(length, end - e, at - t_e)            # words beyond both ends of the chain
                if start - e <= GAP and t_start - t_e <= GAP and fresh > 0 and cov + fresh > covered:
                    covered, first = cov + fresh, f
            grown.setdefault(k, []).append((end, at, covered, first))
            if covered >= COVER * len(auto.templates[k][0]):
                found.setdefault(k, []).append((end, first, covered))
        for k, chains in grown.items():
            open_[k] = [c for c in open_.get(k, []) if end - c[0] <= GAP] + chains
    return {k: apart(chains) for k, chains in found.items()}


def apart(chains):
    """Of (last, first, covered) those that lie apart and cover the most words together."""
    chains = sorted(set(chains))
    ends = [c[0] for c in chains]
    best = [(0, None, None)]                          # (words, chain, what was best before it)
    for i, (last, first, covered) in enumerate(chains):
        j = bisect_left(ends, first)
        words = best[j][0] + covered
        best.append((words, i, j) if words > best[-1][0] else (best[-1][0], None, i))
    out, at = [], len(chains)
    while at:
        _, i, j = best[at]
        if i is not None:
            out.append((chains[i][2], chains[i][1], chains[i][0]))
        at = j
    return out[::-1]


def judge(auto: Automaton, data: bytes):
    """n_words, places [(label, start, end)], found spans [(label, start, end, cover)]."""
    n, places, matches = scan(auto, data)
    spots = sorted((s, s + len(auto.phrases[k][0]), auto.phrases[k][1]) for k, s in places)
    spans = []
    for k, chains in chain(auto, matches).items():
        words, label = auto.templates[k]
        spans += [(first, last + 1, label, min(1.0, covered / len(words))) for covered, first, last in chains]
    return n, spots, sorted(spans)


def templates_of(table: DataFrame, *, text_col: str = "text", label_col: str = "label") -> list:
    """[(text, label)] of a table of license texts, for ``scan_licenses``.  The
    automaton holds them whole in every task, so the table must be of that kind."""
    rows = table.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(text_col, label_col).distinct()
    return sorted((r[0], r[1]) for r in rows.collect())


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
                  templates=TEMPLATES + WHOLE) -> DataFrame:
    """doc_id, n_words, places (phrases: start, end, label), spans (templates:
    start, end, label, cover); words count from 0, ends are exclusive."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))

    def run(batches):
        import pyarrow as pa

        auto = Automaton(phrases, templates)         # some thousand states
        place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("cover", pa.float64())])
        for b in batches:
            got = [judge(auto, t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([[dict(zip(("start", "end", "label"), p)) for p in g[1]] for g in got], pa.list_(place)),
                 pa.array([[dict(zip(("start", "end", "label", "cover"), s)) for s in g[2]] for g in got], pa.list_(span))],
                names=["doc_id", "n_words", "places", "spans"])

    return rows.mapInArrow(run, "doc_id long, n_words long, places array<struct<start:long,end:long,label:string>>, "
                                "spans array<struct<start:long,end:long,label:string,cover:double>>")

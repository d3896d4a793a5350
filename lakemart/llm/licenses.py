"""License scans by patience alignment.

A text and a template are word sequences. Words that occur once in both are
anchors; the longest increasing run of anchors is kept, and the gaps between
them are aligned in the same way until no anchor is left (equal words at a
gap's ends are aligned first). Coverage is the aligned share of the template's
words, from the first to the last of which a place reaches.

Places are proposed by this alignment, window by window, around the occurrences
of one word position more than a place may lack (those whose words the text
holds least often): every place holds one of these. A proposed place is taken
when a count of common words in order (a longest common subsequence in bit
sets) shows that no place that overlaps it is stronger: none that aligns more
words, none as good and shorter or earlier. Repeated words give no anchors, so a
proposal may fall short; what the places taken leave over is counted alike, and
only where it still holds a place is it aligned exactly (``shortest``).
``Scanner.settled`` counts the places of either kind.

A template stands at a place of at most ``width`` times its words: this is what
a place is, and no place is left out.

All places of all templates are reported as ``findings``, in the order of the
text; of places that overlap only the strongest stays. The best of them is
reported beside.

Defined results: a null or empty text holds no license (null, coverage 0, no
findings); the strongest place is that of the highest coverage, then of the
longer template, then of the first by name, then the shortest, then the first;
the best of a text is chosen alike, but the first before the shortest; repeated
rows are scanned each.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, texts_of

# Opening notices of public licenses, and whole texts of the short ones.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
#: A place holds at most so many times the words of its template (the default).
WIDTH = 4
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (in order of the first) that increases in the second:
    patience piles with a link to the top of the pile before."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for n, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(b)
            piles.append(n)
        else:
            tops[at], piles[at] = b, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned places (text, template), increasing in both."""
    found, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, a2, b, b2 = todo.pop()
        while a < a2 and b < b2 and text[a] == template[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a2 and b < b2 and text[a2 - 1] == template[b2 - 1]:
            a2, b2 = a2 - 1, b2 - 1
            found.append((a2, b2))
        if a >= a2 or b >= b2:
            continue
        of_template: dict = {}
        for j in range(b, b2):
            of_template[template[j]] = -1 if template[j] in of_template else j
        of_text: dict = {}
        for i in range(a, a2):
            if of_template.get(text[i], -1) >= 0:
                of_text[text[i]] = -1 if text[i] in of_text else i
        anchors = increasing([(i, of_template[w]) for w, i in of_text.items() if i >= 0])
        if not anchors:
            continue
        found += anchors
        for (i, j), (i2, j2) in zip([(a - 1, b - 1), *anchors], [*anchors, (a2, b2)]):
            todo.append((i + 1, i2, j + 1, j2))
    return sorted(found)


def bits_of(template: list) -> dict[str, int]:
    """Of each word, the set of its places in the template, as the bits of a number."""
    out: dict[str, int] = {}
    for j, w in enumerate(template):
        out[w] = out.get(w, 0) | 1 << j
    return out


def common(text: list, low: int, high: int, bits: dict[str, int], n: int) -> int:
    """Words of the longest common subsequence of text[low:high] and a template of
    n words: a bit is cleared where the length grows by one along the template."""
    full = (1 << n) - 1
    row = full
    for i in range(low, high):
        if places := bits.get(text[i]):
            hit = row & places
            row = (row + hit | row - hit) & full
    return n - row.bit_count()


def shortest(text: list, low: int, high: int, template: list, need: int, width: int = WIDTH) -> list[tuple[int, int, int]]:
    """(aligned words, first, last) of the shortest places in text[low:high] that
    align ``need`` words of the template or more: of each end and number of
    words, the place that starts last. ``latest[j, c]`` is the last start of a
    place up to here that aligns c of the template's first j words."""
    n, out = len(template), []
    rows = defaultdict(list)
    for j in range(n, 0, -1):
        rows[template[j - 1]].append(j)
    latest = np.full((n + 1, n + 1), -1, np.int64)
    before = latest[n, need:].tolist()
    for i in range(low, high):
        if text[i] not in rows:
            continue
        latest[:, 0] = i
        for j in rows[text[i]]:
            np.maximum(latest[j, 1:], latest[j - 1, :-1], out=latest[j, 1:])
        np.maximum.accumulate(latest, axis=0, out=latest)
        now = latest[n, need:].tolist()
        if now != before:
            beyond = -1
            for c in range(n - need, -1, -1):
                if now[c] > max(before[c], beyond) and i - now[c] < width * n:
                    out.append((need + c, now[c], i))
                beyond = max(beyond, now[c])
            before = now
    return out


def apart(places: list[tuple]) -> list[tuple]:
    """Of places (.., first, last), strongest first, those that overlap none before."""
    taken: list[tuple[int, int]] = []
    out = []
    for place in places:
        first, last = place[-2:]
        at = bisect_left(taken, (first, last))
        if (at == 0 or taken[at - 1][1] < first) and (at == len(taken) or taken[at][0] > last):
            taken.insert(at, (first, last))
            out.append(place)
    return out


class Scanner:
    def __init__(self, templates: dict[str, str], threshold: float, width: int = WIDTH):
        self.templates, self.width = [], width
        for name, template in sorted(((name, words(text)) for name, text in templates.items()), key=lambda t: (-len(t[1]), t[0])):
            n = len(template)
            need = next((c for c in range(1, n + 1) if c / n >= threshold), None)
            if need:
                self.templates.append((name, template, need, Counter(template)))
        self.ranks = {name: rank for rank, (name, *_) in enumerate(self.templates)}
        self.known = frozenset(w for _, template, *_ in self.templates for w in template)
        self.settled: Counter = Counter()

    def strongest(self, found: list, place: tuple[int, int, int], low: int, high: int, bits: dict[str, int], n: int) -> bool:
        """No place in found[low:high] that overlaps this one comes before it."""
        aligned, first, last = place
        own, reach = last - first + 1, self.width * n
        if own > reach or common(found, max(low, first - own + 1), last, bits, n) >= aligned or common(found, first + 1, min(high, last + own - 1), bits, n) >= aligned:
            return False
        return aligned == n or common(found, max(low, first - reach + 1), min(high, last + reach), bits, n) == aligned

    def places(self, found: list, at: dict[str, list[int]], template: list, need: int, counts: Counter) -> list[tuple[int, int, int]]:
        """(aligned words, first, last) of the template's places, none overlapping a stronger one."""
        n, width = len(template), self.width

        def held(low, high):
            return sum(min(c, bisect_left(at[w], high) - bisect_left(at[w], low)) for w, c in counts.items() if w in at)

        if sum(c for w, c in counts.items() if w in at) < need:
            return []
        seeds = sorted(range(n), key=lambda j: len(at.get(template[j], ())))[:n - need + 1]
        spans: list[list[int]] = []
        for i in sorted({i for j in seeds for i in at.get(template[j], ())}):
            low, high = max(0, i - width * n + 1), min(len(found), i + width * n)
            if held(low, high) < need:
                continue
            if spans and low <= spans[-1][1]:
                spans[-1][1] = high
            else:
                spans.append([low, high])
        if not spans:
            return []
        bits = bits_of(template)
        starts = sorted({i - j for j in seeds for i in at.get(template[j], ())})
        taken, out = [], []

        def exact(low, high):
            if held(low, high) >= need and common(found, low, high, bits, n) >= need:
                out.extend(shortest(found, low, high, template, need, width))

        for low, high in spans:
            for start in starts[bisect_left(starts, low - n):bisect_left(starts, high)]:
                for slack in (0, n // 4):  # substituted words keep a window's length, others do not
                    a, b = max(low, start - slack), min(high, start + n + slack)
                    if b - a < need or held(a, b) < need:
                        continue
                    pairs = align(found[a:b], template)
                    if len(pairs) < need:
                        continue
                    place = (len(pairs), a + pairs[0][0], a + pairs[-1][0])
                    if self.strongest(found, place, low, high, bits, n):
                        taken.append(place)
                        exact(low, place[1])
                        low = place[2] + 1
                        break
            exact(low, high)
        kept = apart(sorted(taken + out, key=lambda p: (-p[0], p[2] - p[1], p[1])))
        self.settled.update(patience=len(taken), exact=len(kept) - len(taken))
        return kept

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first and last aligned word) of every place at the
        threshold that overlaps no stronger one, in the order of the text."""
        found = words(text)
        at: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(found):
            if w in self.known:
                at[w].append(i)
        every = []
        for rank, (name, template, need, counts) in enumerate(self.templates):
            for aligned, first, last in self.places(found, at, template, need, counts):
                every.append((-aligned / len(template), rank, last - first, name, first, last))
        kept = apart(sorted(every, key=lambda p: (*p[:3], p[4])))
        return [(name, -less, first, last) for less, _, _, name, first, last in sorted(kept, key=lambda p: p[4])]

    def best(self, findings: list[tuple[str, float, int, int]]) -> tuple[str | None, float, int | None, int | None]:
        return min(findings, key=lambda f: (-f[1], self.ranks[f[0]], f[2]), default=(None, 0.0, None, None))


FINDING = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word, findings) of each whole
    text: the best place, and all places as an array of its four columns."""
    scanner = Scanner(templates or TEMPLATES, threshold, width)

    def run(batches):
        for ids, texts in slices(batches):
            findings = [scanner.scan(t) for t in texts]
            names, coverage, first, last = zip(*map(scanner.best, findings))
            every = pa.array([[dict(zip(FINDING.names, f)) for f in fs] for fs in findings], pa.list_(FINDING))
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(coverage, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), every],
                                             ["doc_id", "license", "coverage", "first_word", "last_word", "findings"])

    source = texts_of(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, license string, coverage double, first_word bigint, last_word bigint, "
                                  "findings array<struct<license:string,coverage:double,first_word:bigint,last_word:bigint>>")

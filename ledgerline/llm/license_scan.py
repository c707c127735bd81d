"""Operator 7: license scans by patience alignment.

A text is searched for the signal words of the license templates: of each
template so many of its rarest words that a find must hold one of them. Where
one is met, the template is laid over the text at each offset that a find with
that word can have; windows with enough of the template's words are
aligned by patience: words that are unique both in the window and in the
template are anchors, the longest increasing subsequence of anchors is kept,
and the gaps between are aligned in the same way. Coverage is the share of the
template's words that are aligned; COVERAGE or more is a find. Finds of one
template don't overlap; the better one stays, of equals the earlier one.

A window is little longer than its template, so a text costs time in proportion
to its length, whatever it repeats. A null or empty text has no finds. Rows are
independent: repeated rows, null ids and extra columns don't matter; an empty
table gives an empty table.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import common

COVERAGE = 0.8

#: Short notices and the public texts of well-known licenses.
TEMPLATES = {
    "notice:mit": "Released under the MIT License",
    "notice:apache-2.0": "Licensed under the Apache License, Version 2.0",
    "notice:gpl": "This work is licensed under the GNU General Public License, version 3",
    "notice:cc-by-nc": "Licensed under CC BY-NC 4.0",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
        ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
        1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
        this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
        2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
        3. This notice may not be removed or altered from any source distribution.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS
        SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
        NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
        SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    "bsd-3-clause:third": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    "mpl-2.0:header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "lgpl-2.1:header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later
        version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more
        details.""",
    "apache-2.0:header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "gpl-3.0:header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
}

_WORD = re.compile(r"\w[\w.\-/:]*\w|\w")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of equal words, increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        often_a, often_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if often_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if often_a[w] == 1 and w in place]
        if not anchors:
            continue
        last_a, last_b = a0, b0
        for i, j in _increasing(anchors):
            out.append((i, j))
            work.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
        work.append((last_a, a1, last_b, b1))
    return sorted(out)


def _increasing(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence with increasing second places, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    under: list[int] = []
    for k, (_, j) in enumerate(anchors):
        p = bisect_left(tops, j)
        under.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[p], piles[p] = j, k
    out, k = [], piles[-1]
    while k >= 0:
        out.append(anchors[k])
        k = under[k]
    return out[::-1]


class Find(NamedTuple):
    license: str
    coverage: float
    start: int
    end: int


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.templates = {name: words for name, text in templates.items() if (words := words_of(text))}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self._signals: dict[float, dict[str, list[tuple[str, int]]]] = {}

    def signals(self, least: float) -> dict[str, list[tuple[str, int]]]:
        """Word -> (template, place): one place more of each template than a find may leave unaligned, rarest words first."""
        if least not in self._signals:
            often, out = Counter(w for words in self.templates.values() for w in words), defaultdict(list)
            for name, words in self.templates.items():
                spare = len(words) - _needed(least, len(words))
                for j in sorted(range(len(words)), key=lambda j: (often[words[j]], -len(words[j]), j))[: spare + 1]:  # noqa: B023
                    out[words[j]].append((name, j))
            self._signals[least] = dict(out)
        return self._signals[least]

    def _offsets(self, words: list[str], name: str, near: list[int], need: int, slack: int) -> Iterator[int]:
        """The offsets at which a find with a signal at one of the places ``near`` can lie and the window holds enough words of the template."""
        n, counts = len(self.templates[name]), self.counts[name]
        reach, spans = n - need + slack, []
        for at in sorted(near):
            if spans and at - reach <= spans[-1][1] + 1:
                spans[-1][1] = at + reach
            else:
                spans.append([at - reach, at + reach])
        for first, last in spans:
            have, held = Counter(), 0
            for w in words[max(0, first - slack) : max(0, first + n + slack)]:
                if w in counts:
                    have[w] += 1
                    held += have[w] <= counts[w]
            for s in range(first, last + 1):
                if held >= need:
                    yield s
                out, new = s - slack, s + n + slack
                if 0 <= out < len(words) and (w := words[out]) in counts:
                    held -= have[w] <= counts[w]
                    have[w] -= 1
                if 0 <= new < len(words) and (w := words[new]) in counts:
                    have[w] += 1
                    held += have[w] <= counts[w]

    def scan(self, text: str | None, least: float = COVERAGE) -> list[Find]:
        words, signals = words_of(text), self.signals(least)
        near: dict[str, set[int]] = defaultdict(set)
        for i, w in enumerate(words):
            if w in signals:
                for name, j in signals[w]:
                    near[name].add(i - j)
        finds: list[Find] = []
        for name, places in near.items():
            template = self.templates[name]
            need, slack, own = _needed(least, len(template)), max(2, len(template) // 10), set()
            for start in self._offsets(words, name, list(places), need, slack):
                low = max(0, start - slack)
                pairs = align(words[low : max(0, start + len(template) + slack)], template)
                if len(pairs) >= need:
                    own.add(Find(name, len(pairs) / len(template), low + pairs[0][0], low + pairs[-1][0] + 1))
            finds += _apart(own)
        return sorted(finds, key=lambda f: (f.start, f.license))


def _needed(least: float, n: int) -> int:
    return max(1, math.ceil(least * n))


def _apart(own: set[Find]) -> list[Find]:
    """The best finds that don't overlap. Those taken stay sorted, so a find is held against its two neighbours only."""
    taken: list[tuple[int, int]] = []
    out = []
    for find in sorted(own, key=lambda f: (-f.coverage, f.start, f.end)):
        i = bisect.bisect_left(taken, (find.end,))  # the first that starts at or after this one's end
        if i == 0 or taken[i - 1][1] <= find.start:
            taken.insert(i, (find.start, find.end))
            out.append(find)
    return out


@functools.lru_cache(maxsize=4)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(templates))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, n_found, coverage (the best, 0 without finds), licenses (distinct, sorted), finds (license, coverage, first word, end)."""
    given = tuple((templates or TEMPLATES).items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(given)
        kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in common.lean(batches):
            finds = [scanner.scan(x.as_py(), least) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(f) for f in finds], pa.int64()),
                    pa.array([max((x.coverage for x in f), default=0.0) for f in finds], pa.float64()),
                    pa.array([sorted({x.license for x in f}) for f in finds], pa.list_(pa.string())),
                    pa.array([[x._asdict() for x in f] for f in finds], kind),
                ],
                ["doc_id", "n_found", "coverage", "licenses", "finds"],
            )

    schema = "doc_id long, n_found long, coverage double, licenses array<string>, finds array<struct<license:string,coverage:double,start:long,end:long>>"
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, schema)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))

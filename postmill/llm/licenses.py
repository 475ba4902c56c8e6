"""Licence scans: units of a text compared with licence templates by Dice over word bigrams.

Units are lines, blocks (runs of lines without an empty one between them) and the whole text, each
normalised to lower-case words of letters and digits. A unit of n bigrams and a template of m
share at most ``min(n, m)``, so their Dice coefficient ``2 * shared / (n + m)`` can reach ``t`` only
where ``n`` lies within ``t / (2 - t) * m`` and ``(2 - t) / t * m``. These size bounds choose the candidate
templates of a unit; most units have none and are passed over with a count of their words.

Bigrams count as often as they occur. A unit that matches several templates goes to the most similar, then to the
first by name. A notice within a line or block is found by windows: runs of words as long as a template. A window that reaches ``t`` lacks
at most ``(1 - t) * m`` of the template's bigrams, so one of its rarest ``(1 - t) * m + 1`` is in it; windows are counted around these only, a
word at a time. Of overlapping finds the most similar stays, then the longest. Defined results: null, empty and non-matching texts give one row with no licence and Dice 0; repeated
rows each come back; texts are read whole. Templates are a parameter; a template of fewer than two words matches nothing.
"""

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import quoted, slices, with_fields

MIN_DICE = 0.8
# Fixed texts: public notices by which works name their licence, and whole short licences.
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", f"{_BSD_2} {_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD_2} {_BSD_3} {_AS_IS}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
)

_WORDS = re.compile(r"[^\W_]+")
FOUND = "array<struct<license: string, dice: double, start: long, end: long>>"


def normalized(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def dice(a: Counter, b: Counter, sizes: int) -> float:
    """Of two bags of bigrams with ``sizes`` bigrams in all."""
    return 2 * sum(min(n, b[x]) for x, n in a.items() if x in b) / sizes


class Templates:
    """Templates in the order of their sizes."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = MIN_DICE):
        words = [(name, normalized(text)) for name, text in templates]
        bags = [(len(w) - 1, name, Counter(zip(w, w[1:], strict=False))) for name, w in words if len(w) > 1]
        self.bags = sorted(bags, key=lambda b: b[:2])
        self.sizes = [b[0] for b in self.bags]
        self.least = least
        self.anchors: dict[tuple[str, str], list[int]] = {}
        common = Counter(x for _, _, bag in self.bags for x in bag)
        for number, (size, _, bag) in enumerate(self.bags):
            # So many bigrams, counted as often as they occur, that no window which reaches the coefficient lacks them all.
            spare = int(size * (1 - least) + 1e-9)
            for bigram, times in sorted(bag.items(), key=lambda b: (common[b[0]], -len(b[0][0]) - len(b[0][1]), b[0])):
                self.anchors.setdefault(bigram, []).append(number)
                spare -= times
                if spare < 0:
                    break
        self.reach = least / (2 - least)

    def candidates(self, size: int) -> list[tuple[int, str, Counter]]:
        """The templates whose size allows the least coefficient with a unit of ``size`` bigrams."""
        slack = 1e-9
        return self.bags[bisect_left(self.sizes, size * self.reach - slack) : bisect_right(self.sizes, size / self.reach + slack)]

    def best(self, words: list[str]) -> tuple[float, str] | None:
        size = len(words) - 1
        near = self.candidates(size) if size > 0 else []
        if not near:
            return None
        bag = Counter(zip(words, words[1:], strict=False))
        scores = [(dice(bag, other, size + m), name) for m, name, other in near]
        score, name = min(scores, key=lambda s: (-s[0], s[1]))
        return (score, name) if score >= self.least else None

    def windows(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, coefficient, start, end) of windows as long as a template, one for each run of windows that reach the coefficient."""
        words = normalized(text)
        if self.anchors.keys().isdisjoint(zip(words, words[1:], strict=False)):
            return []
        places = [(m.start(), m.end()) for m in _WORDS.finditer(text)]
        words = [text[start:end].lower() for start, end in places]
        bigrams = list(zip(words, words[1:], strict=False))
        near: dict[int, list[int]] = {}
        for at, bigram in enumerate(bigrams):
            for number in self.anchors.get(bigram, ()):
                near.setdefault(number, []).append(at)
        found = []
        for number, hits in near.items():
            size, name, _ = self.bags[number]
            for first, last in _merged([(max(0, at - size + 1), min(at, len(bigrams) - size)) for at in hits]):
                for shared, at in self._best_windows(number, bigrams, first, last):
                    found.append((name, shared / size, places[at][0], places[at + size][1]))
        return found

    def _best_windows(self, number: int, bigrams: list[tuple[str, str]], first: int, last: int) -> Iterator[tuple[int, int]]:
        """(shared bigrams, start) of the best window, the first of equals, of each run of starts that reach the coefficient."""
        size, _, bag = self.bags[number]
        counts: Counter = Counter()
        shared, best = 0, None
        for at in range(first, last + size):
            come = bigrams[at]
            if come in bag:
                counts[come] += 1
                shared += counts[come] <= bag[come]
            start = at - size + 1
            if start > first and (gone := bigrams[start - 1]) in bag:
                shared -= counts[gone] <= bag[gone]
                counts[gone] -= 1
            if start < first:
                continue
            if shared >= self.least * size - 1e-9:
                best = max(best or (0, 0), (shared, -start))
            elif best:
                yield best[0], -best[1]
                best = None
        if best:
            yield best[0], -best[1]

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, coefficient, start, end) of the units that match; spans are code points.

        A unit within a larger one that matches as well is reported once, as the more similar.
        """
        units, block, whole = [], [], []
        at = 0
        for line in [*text.split("\n"), ""]:
            words = normalized(line)
            start, end = at, min(at + len(line), len(text))
            at += len(line) + 1
            if words:
                units.append((start, end, words))
                block.append((start, end, words))
                whole.append((start, end, words))
            else:
                if len(block) > 1:
                    units.append(self._joined(block))
                block = []
        if len(whole) > 1:
            units.append(self._joined(whole))
        found = self.windows(text)
        for start, end, words in units:
            if words and (best := self.best(words)):
                found.append((best[1], best[0], start, end))
        kept: list[tuple[str, float, int, int]] = []
        starts: list[int] = []
        for one in sorted(found, key=lambda f: (-f[1], f[2] - f[3], f[2], f[0])):
            # Those kept do not overlap, so only its neighbours may overlap with it.
            at = bisect_left(starts, one[3])
            if not at or kept[at - 1][3] <= one[2]:
                kept.insert(at, one)
                starts.insert(at, one[2])
        return kept

    def _joined(self, lines: list[tuple[int, int, list[str]]]) -> tuple[int, int, list[str]]:
        """A unit of several lines; without its words where no template is as large."""
        size = sum(len(w) for _, _, w in lines) - 1
        words = [x for _, _, w in lines for x in w] if self.candidates(size) else []
        return lines[0][0], lines[-1][1], words


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of rising starts as ranges that do not touch, without empty ones."""
    merged: list[tuple[int, int]] = []
    for first, last in ranges:
        if first > last:
            continue
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return merged


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = MIN_DICE,
    text_column: str = "text",
) -> DataFrame:
    """All rows of ``docs`` without their text, with ``found``: the licence notices of the text."""
    index = Templates(templates, least)
    kept = [c for c in docs.columns if c not in (text_column, "found")]
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column):
                found = [
                    [dict(zip(("license", "dice", "start", "end"), f, strict=True)) for f in index.find(t.as_py() or "")]
                    for t in part[text_column]
                ]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), pa.array(found, kind)], [*kept, "found"])

    return docs.select(*quoted([*kept, text_column])).mapInArrow(run, with_fields(docs, kept, f"found {FOUND}"))


def best_license(found: DataFrame) -> DataFrame:
    """The most similar notice of each row as ``license`` and ``dice``, and ``n_notices``."""
    # Arrays of structs compare by their fields in order; equal coefficients go to the first notice.
    best = F.array_max(F.transform("found", lambda f: F.struct(f["dice"].alias("dice"), (-f["start"]).alias("late"), f["license"].alias("license"))))
    return found.withColumns(
        {"license": best["license"], "dice": F.coalesce(best["dice"], F.lit(0.0)), "n_notices": F.size("found").cast("long")}
    )

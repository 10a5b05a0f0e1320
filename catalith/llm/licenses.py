"""Licence scans: Dice coefficient over word bigrams against licence templates.

Every run of words of a text is compared, wherever it starts and ends, since a notice
may be a file, a paragraph, a sentence or some words within a longer line.
Words are lower-case letters and digits; all else only separates them. The coefficient is
``2 * common / (a + b)`` on bigrams counted with repeats.

The bigrams of a text that a template has are its hits. A run gets better by every
bigram at its ends that is no hit and is left out, so runs start and end with hits.
A coefficient of ``least`` needs ``a / b`` between ``least / (2 - least)`` and its
inverse, and so a least number of hits within the longest run; starts without them
are skipped. Both only skip what cannot reach ``least`` or is worse than a part of it.

The templates are a fixed list or a parameter and go to every executor; their
size is checked. Defined cases: a null or empty text has no finding. Equal
coefficients go to the template that is first by name. Rows that repeat are
scanned each for itself. Of runs that overlap only the best is
reported: the one whose common bigrams exceed most what ``least`` asks of its size,
so a whole header comes before the short notice in it; then the shorter and the
first. Only key and text are read.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.75
TEMPLATE_BYTES = 8 << 20
WORD = re.compile(r"[0-9a-z]+")
PART = re.compile(r"\n|(?<=[.;!?])[ \t]+")

# Notices and short licences as they are published.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License."
    ),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Artistic-2.0": "Licensed under the Artistic License 2.0.",
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."
    ),
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "EPL-2.0": "Licensed under the Eclipse Public License, version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MIT-notice": "Licensed under the MIT License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

FINDING = "license string, dice double, first_line int, last_line int"


def words(text: str) -> list[str]:
    """Lower-case words of ASCII letters and digits; other characters part them."""
    return WORD.findall(text.lower())


def bigrams(found: list[str]) -> Counter:
    """Counted pairs of neighbouring words; a single word is one with nothing."""
    if len(found) == 1:
        return Counter([(found[0], "")])
    return Counter(zip(found, found[1:], strict=False))


class Templates:
    """Bigrams of the templates, by size and by bigram."""

    def __init__(self, texts: dict[str, str], least: float):
        if sum(len(t.encode()) for t in texts.values()) > TEMPLATE_BYTES:
            raise ValueError("the templates are too large to send to every executor")
        self.least = least
        self.known = sorted((name, bigrams(words(text))) for name, text in texts.items())
        self.known = [(name, grams, grams.total()) for name, grams in self.known if grams]
        #: The templates that have a bigram.
        self.having: dict[tuple[str, str], list[int]] = {}
        for i, (_, grams, _) in enumerate(self.known):
            for gram in grams:
                self.having.setdefault(gram, []).append(i)
        #: The templates of one word.
        self.singles = {word: i for i, (_, grams, _) in reversed([*enumerate(self.known)]) for word, no in grams if not no}
        self.largest = max((n for _, _, n in self.known), default=0) * (2 - least) / least

    def best(self, grams: Counter, size: int) -> tuple[float, str] | None:
        """The best template with at least ``least``."""
        found = None
        for name, own, n in self.known:
            if not self.least * max(size, n) <= (2 - self.least) * min(size, n):
                continue
            small, large = (own, grams) if len(own) < len(grams) else (grams, own)
            common = sum(min(c, large[g]) for g, c in small.items() if g in large)
            dice = 2 * common / (size + n)
            if dice >= self.least and (found is None or dice > found[0]):
                found = (dice, name)
        return found

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """``(license, dice, first_line, last_line)`` of the best runs of whole lines and sentences, in order.

        A notice within a longer one is not seen; :meth:`find` compares all runs of words.
        """
        parts = [words(part) for part in PART.split(text)]
        hits = {i: self._hits(part) for i, part in enumerate(parts) if self._known(part)}
        near = list(hits)
        if not near:
            return []
        line, lines = 0, []
        for cut in [*PART.finditer(text), None]:
            lines.append(line)
            line += bool(cut and cut[0] == "\n")
        found = []
        for place, i in enumerate(near):
            run: list[str] = []
            end = i
            shared: Counter = Counter()
            for j in near[place:]:
                for part in parts[end : j + 1]:
                    run += part
                end = j + 1
                if max(len(run) - 1, 1) > self.largest:
                    break
                # One bigram more may lie across each of the ends of parts.
                shared.update(hits[j])
                if all(n + j - i < self.needed(t) for t, n in shared.items()):
                    continue
                grams = bigrams(run)
                got = self.best(grams, grams.total())
                if got:
                    found.append((got[1], got[0], i, j))
        # The best first; what overlaps a better one is left out.
        chosen: list[tuple[str, float, int, int]] = []
        for item in sorted(found, key=lambda x: (-x[1], x[3] - x[2], x[2])):
            if all(item[3] < c[2] or item[2] > c[3] for c in chosen):
                chosen.append(item)
        return [(name, dice, lines[i], lines[j]) for name, dice, i, j in sorted(chosen, key=lambda x: x[2])]

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """``(license, dice, first_line, last_line)`` of the best runs of words, in order."""
        low = text.lower()
        found = WORD.findall(low)
        hits: dict[int, list[int]] = {}
        grams = list(zip(found, found[1:], strict=False))
        for i in (i for i, gram in enumerate(grams) if gram in self.having):
            for t in self.having[grams[i]]:
                hits.setdefault(t, []).append(i)
        # Best first: (-score, words, first word, template, last word, dice).
        heap = []
        for t, places in hits.items():
            need = max(math.ceil(self.needed(t)), 1)
            longest = self.known[t][2] * (2 - self.least) / self.least
            for at in range(len(places) - need + 1):
                if places[at + need - 1] - places[at] < longest:
                    heap += self._best_from(grams, t, places, at, len(grams))
        for t in self.singles.values() if self.singles.keys() & set(found) else ():
            word = next(iter(self.known[t][1]))[0]
            heap += [(2 * self.least - 2, 1, i, t, i, 1.0) for i, w in enumerate(found) if w == word]
        heapq.heapify(heap)
        chosen: list[tuple[int, int, int, float]] = []
        while heap:
            _, _, first, t, last, dice = heapq.heappop(heap)
            place = bisect_left(chosen, (first + 1,))
            if place and chosen[place - 1][1] >= first:
                continue
            if place < len(chosen) and chosen[place][0] <= last:
                # What overlaps a better run ends before it, if that is enough.
                if first < last:
                    again = self._best_from(grams, t, hits[t], bisect_left(hits[t], first), chosen[place][0] - 1)
                    for item in again:
                        heapq.heappush(heap, item)
                continue
            insort(chosen, (first, last, t, dice))
        if not chosen:
            return []
        breaks = [m.start() for m in re.finditer("\n", low)]
        lines = [bisect_right(breaks, m.start()) for m in WORD.finditer(low)]
        return [(self.known[t][0], dice, lines[first], lines[last]) for first, last, t, dice in chosen]

    def _best_from(
        self, grams: list[tuple[str, str]], t: int, places: list[int], at: int, end: int
    ) -> list[tuple[float, int, int, int, int, float]]:
        """The best run from hit ``at`` of template ``t`` with bigrams before ``end``, if any reaches ``least``."""
        _, own, n = self.known[t]
        start, longest = places[at], n * (2 - self.least) / self.least
        left, common, best = {}, 0, []
        for i in places[at:]:
            size = i - start + 1
            if i >= end or size > longest:
                break
            gram = grams[i]
            rest = left.get(gram, own[gram])
            if not rest:
                continue
            left[gram] = rest - 1
            common += 1
            dice = 2 * common / (size + n)
            item = (self.least * (size + n) - 2 * common, size + 1, start, t, i + 1, dice)
            if dice >= self.least and (not best or item < best[0]):
                best = [item]
        return best

    def _known(self, part: list[str]) -> bool:
        """Whether the part shares a bigram with a template."""
        if len(part) == 1:
            return (part[0], "") in self.having
        return not self.having.keys().isdisjoint(zip(part, part[1:], strict=False))

    def _hits(self, part: list[str]) -> Counter:
        """How many bigrams of the part each template has."""
        grams = [(part[0], "")] if len(part) == 1 else zip(part, part[1:], strict=False)
        return Counter(t for gram in grams for t in self.having.get(gram, ()))

    def needed(self, template: int) -> float:
        """Fewer common bigrams cannot reach ``least``, as the sizes are bounded too."""
        n = self.known[template][2]
        return self.least * n * (1 + self.least / (2 - self.least)) / 2 - 1e-9


def scan_licenses(
    df: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, least: float = LEAST
) -> DataFrame:
    """``(key, license, dice, first_line, last_line)``: one row per finding, lines from 0."""
    shared = df.sparkSession.sparkContext.broadcast(Templates(TEMPLATES if templates is None else templates, least))
    rows = df.select(F.col(key).alias("row_key"), F.col(text).cast("string").alias("body"))
    kind = rows.schema["row_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        for whole in batches:
            at, found = [], []
            for i, body in enumerate(whole.column("body").to_pylist()):
                for item in scanner.find(body) if body else ():
                    at.append(i)
                    found.append(item)
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    whole.column("row_key").take(pa.array(at, pa.int64())),
                    *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)),
                ],
                ["row_key", "license", "dice", "first_line", "last_line"],
            )

    found = rows.mapInArrow(run, f"row_key {kind}, {FINDING}")
    return found.withColumnRenamed("row_key", key) if key != "row_key" else found

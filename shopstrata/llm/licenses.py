"""License scans: winnowed fingerprints find candidate places, banded alignment measures them.

Templates and texts are words (lower case, without punctuation). A fingerprint is the hash of GRAM consecutive words; of
each RUN consecutive fingerprints the smallest is kept, so GRAM + RUN - 1 words in common always share one. Templates of
fewer words are looked up at every word of a text. The templates' fingerprints are an inverted index. Hits of a template on nearby diagonals are one candidate, aligned within a band around
them. What is matched by enough of a template's words is reported; of overlapping matches the best one. Words that tell licenses
apart (names, versions, clauses) are never left out of a match or inserted in one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import with_columns
from .words import LETTERS, U, Words, _ranges, split, windows

GRAM, RUN = 3, 2
#: The least share of a template's words that a match has. One of fewer than SHORT words, where each word tells licenses
#: apart, is matched whole and without gaps.
COVERAGE, SHORT = 0.8, 12
_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)


def _gnu(name: str, version: str) -> list[str]:
    """A GNU license's notices: one sentence with the version in full or short, and the standard file headers."""
    header = (
        "This {} is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free "
        "Software Foundation, either version {} of the License, or (at your option) any later version."
    )
    only = (
        "This {} is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free "
        "Software Foundation, version {} of the License."
    )
    return [
        f"This work is licensed under the {name}, version {version}.",
        f"This work is licensed under the {name} v{version}.",
        *(form.format(what, name, version) for form in (header, only) for what in ("program", "library")),
    ]


def _bodies() -> dict[str, str]:
    """Full license texts by name, without the instructions for applying them behind their terms."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return {f.stem: f.read_text("utf-8").split("END OF TERMS AND CONDITIONS")[0] for f in files}


#: License notices as they are commonly written. `license_texts` has full texts beside these.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        _MIT,
        f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-1.0": _gnu("GNU General Public License", "1"),
    "GPL-2.0": _gnu("GNU General Public License", "2"),
    "GPL-3.0": _gnu("GNU General Public License", "3"),
    "LGPL-2.0": _gnu("GNU Library General Public License", "2") + _gnu("GNU Lesser General Public License", "2"),
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3"),
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3"),
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD": [
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ],
    "BSD-2-Clause": [f"{_BSD} {_WARRANTY}"],
    "BSD-3-Clause": [f"{_BSD} {_ENDORSE} {_WARRANTY}"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC0-1.0": ["Licensed under CC0 1.0."],
    "Proprietary": ["All rights reserved."],
}
for _name, _body in _bodies().items():
    TEMPLATES[_name] = [*TEMPLATES[_name], _body]

#: A word before "[general] public license" is a name, but for these; further names stand before "license".
UNNAMED = "gnu general the this that a any such your our its in of or".split()
NAMES = "apache mit bsd isc zlib boost artistic".split()


def _hashes(words: list[str]) -> np.ndarray:
    return split(pa.array([" ".join(words)]), LETTERS).hash


_LICENSE, _UNNAMED, _NAMES = _hashes(["license", "licence"]), _hashes(UNNAMED), _hashes(NAMES)
_GENERAL, _PUBLIC, _ENDORSE_, _PROMOTE, _ADVERTISING, _MATERIALS = _hashes("general public endorse promote advertising materials".split())
_VERSION, _NUMBERS = _hashes(["version", "v"]), _hashes([str(n) for n in range(10)])
_SHORT_VERSIONS = _hashes([f"v{n}" for n in range(1, 10)])


def telling(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word whether it tells licenses apart, and whether it continues the version number before it.

    These are names before "license", numbers behind "version" (but zeros: 2.0 is 2), and words of clauses that only some
    licenses have.
    """
    n = len(words.hash)
    h = np.concatenate([words.hash, np.zeros(3, U)])
    owner = np.concatenate([words.owner(), np.full(3, -1)])
    near = [owner[k : n + k] == owner[:n] for k in range(4)]
    at = [h[k : n + k] for k in range(4)]
    licence = np.isin(h, _LICENSE)
    public = ((at[1] == _PUBLIC) & licence[2 : n + 2] & near[2]) | ((at[1] == _GENERAL) & (at[2] == _PUBLIC) & licence[3 : n + 3] & near[3])
    out = public & ~np.isin(at[0], _UNNAMED)
    out |= np.isin(at[0], _NAMES) & licence[1 : n + 1] & near[1]
    out |= (at[0] == _ENDORSE_) & (at[2] == _PROMOTE) & near[2] | (at[0] == _ADVERTISING) & (at[1] == _MATERIALS) & near[1]
    number, short = np.isin(at[0], _NUMBERS), np.isin(at[0], _SHORT_VERSIONS)
    version = np.zeros(n, bool)
    version[1:] = number[1:] & np.isin(at[0][:-1], _VERSION) & near[1][:-1]
    version |= short
    point = np.zeros(n, bool)
    point[1:] = number[1:] & near[1][:-1] & (words.begin[1:] == words.end[:-1] + 1)
    point[point] = words.raw[words.begin[point] - 1] == 0x2E
    more = np.zeros(n, bool)
    for _ in range(3):  # numbers of up to four parts
        more[1:] |= point[1:] & (version | more)[:-1]
    zero = at[0] == _NUMBERS[0]
    return out | (version | more) & ~zero, more & ~zero


def winnowed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The kept fingerprints and the words (of all texts) at which they begin. A text of fewer words has one."""
    hashes, first = windows(words, GRAM)
    counts = np.diff(first)
    begin = np.repeat(words.first[:-1] - first[:-1], counts) + np.arange(len(hashes))
    keep = np.zeros(len(hashes), bool)
    keep[first[:-1][(counts > 0) & (counts < RUN)]] = True
    if len(hashes) >= RUN:
        starts = np.arange(len(hashes) - RUN + 1)
        owner = np.repeat(np.arange(len(counts)), counts)
        starts = starts[owner[starts] == owner[starts + RUN - 1]]
        runs = np.stack([hashes[starts + k] for k in range(RUN)])
        keep[starts + RUN - 1 - np.argmin(runs[::-1], axis=0)] = True  # of equal ones the last
    return hashes[keep], begin[keep]


@dataclass
class Match:
    license: str
    begin: int  # words of the text, end exclusive
    end: int
    coverage: float
    words: int  # of the template that are matched


class Index:
    def __init__(self, templates: dict[str, list[str]], coverage: float = COVERAGE):
        self.names = [name for name, texts in templates.items() for _ in texts]
        self.coverage = coverage
        words = split(pa.array([t for texts in templates.values() for t in texts], pa.string()), LETTERS)
        self.words = [words.hash[a:b] for a, b in zip(words.first, words.first[1:])]
        flags, _ = telling(words)
        self.telling = [flags[a:b] for a, b in zip(words.first, words.first[1:])]
        # Winnowing may keep none of the fingerprints of a few words.
        self.few = [t for t, own in enumerate(self.words) if 0 < len(own) < GRAM + RUN - 1]
        hashes, begin = winnowed(words)
        enough = words.counts[np.searchsorted(words.first, begin, "right") - 1] >= GRAM + RUN - 1
        hashes, begin = hashes[enough], begin[enough]
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.template = (np.searchsorted(words.first, begin, "right") - 1)[order]
        self.place = begin[order] - words.first[self.template]

    def band(self, template: int) -> int:
        return max(2, len(self.words[template]) // 5)

    def matches(self, words: Words) -> list[tuple[int, Match]]:
        """(number of the text, match), the best of overlapping ones."""
        hashes, begin = winnowed(words)
        low, high = np.searchsorted(self.hashes, hashes), np.searchsorted(self.hashes, hashes, "right")
        hit = _ranges(low, high - low)
        at = np.repeat(begin, high - low)
        found: dict[int, list[Match]] = {}
        for i, match in self._few_words(words):
            found.setdefault(i, []).append(match)
        text = np.searchsorted(words.first, at, "right") - 1
        template, diagonal = self.template[hit], at - self.place[hit]
        order = np.lexsort((diagonal, template, text))
        text, template, diagonal = text[order], template[order], diagonal[order]
        band = np.array([self.band(t) for t in range(len(self.words))])[template]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (template[1:] != template[:-1]) | (diagonal[1:] - diagonal[:-1] > band[1:])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(text))[: len(heads)] - 1
        flags = telling(words) if len(heads) else None
        for a, b in zip(heads.tolist(), tails.tolist()):
            i, t = int(text[a]), int(template[a])
            start, stop = int(words.first[i]), int(words.first[i + 1])
            match = self._align(words.hash, t, int(diagonal[a]), int(diagonal[b]), start, stop, flags)
            if match:
                found.setdefault(i, []).append(match)
        out = []
        for i, own in found.items():
            taken: list[Match] = []
            for m in sorted(own, key=lambda m: (-m.words * m.coverage, m.begin, m.license)):
                if all(m.end <= x.begin or m.begin >= x.end for x in taken):
                    taken.append(m)
            out += [(i, m) for m in sorted(taken, key=lambda m: m.begin)]
        return out

    def _few_words(self, words: Words) -> list[tuple[int, Match]]:
        """Every occurrence of the templates that have too few words to be winnowed; these are matched whole."""
        out = []
        for t in self.few:
            own = self.words[t]
            at = np.flatnonzero(words.hash[: max(0, len(words.hash) - len(own) + 1)] == own[0])
            for k in range(1, len(own)):
                at = at[words.hash[at + k] == own[k]]
            text = np.searchsorted(words.first, at, "right") - 1
            whole = at + len(own) <= words.first[text + 1]
            for i, a in zip(text[whole].tolist(), (at - words.first[text])[whole].tolist()):
                out.append((i, Match(self.names[t], a, a + len(own), 1.0, len(own))))
        return out

    def _align(
        self, text: np.ndarray, t: int, low: int, high: int, start: int, stop: int, flags: tuple[np.ndarray, np.ndarray] | None = None
    ) -> Match | None:
        """Align a whole template with some part of the text, within the band around diagonals low to high.

        The most words in order, and of equal alignments the one over the shortest part of the text. Cells of a row are
        the text's places place + low - band to place + high + band. flags: telling words of the text, and those that
        continue a version number; no telling word of template or text is skipped, and no version number is cut.
        """
        own, band = self.words[t], self.band(t)
        need = math.ceil(self.coverage * len(own) - 1e-9)
        base, width = low - band, high - low + 2 * band + 1
        a, b = max(base, start), min(base + width + len(own), stop)
        if b - a < need or np.isin(own, text[a:b]).sum() < need or _common(own, text[a:b]) < need:
            return None
        # A whole copy without gaps is the best there is.
        for j in (a + np.flatnonzero(text[a : max(a, b - len(own) + 1)] == own[0])).tolist():
            to = j + len(own)
            if j < base + width and np.array_equal(text[j:to], own) and not (flags is not None and to < stop and flags[1][to]):
                return Match(self.names[t], j - start, to - start, 1.0, len(own))
        span, inside = np.zeros(width + len(own), U), np.zeros(width + len(own), bool)
        span[a - base : b - base], inside[a - base : b - base] = text[a:b], True
        skip, cut = np.zeros((2, width + len(own)), np.int64)
        if flags is not None:
            skip[a - base : b - base] = flags[0][a:b]
            after = flags[1][a + 1 : min(b + 1, stop)]
            cut[a - base : a - base + len(after)] = after
        required = self.telling[t] if flags is not None else np.zeros(len(own), bool)
        last = int(np.flatnonzero(required)[-1]) if required.any() else 0
        # A cell is the number of words in order, then where they begin (later is better); 0 before the first, -1 if a
        # telling word was skipped.
        one, segment, barred = 1 << 24, 1 << 44, bool(skip.any())
        cell, floor, places = np.zeros(width, np.int64), 0, np.arange(1, width + 1)
        best, length, end = 0, 0, 0
        for i, word in enumerate(own):
            same = (span[i : i + width] == word) & inside[i : i + width] & (cell >= 0)
            longer = np.where(cell > 0, cell + one, one + i + places)
            if required[i]:
                floor = -1
                new = np.full(width, -1, np.int64)
            else:
                # Skipping the template's word keeps the text's place: the cell to the right in the row above.
                new = np.append(cell[1:], floor)
            new = np.maximum(new, np.where(same, longer, floor))
            if barred:
                groups = np.cumsum(skip[i : i + width]) * segment
                new = np.maximum.accumulate(new + groups) - groups
            else:
                new = np.maximum.accumulate(new)
            cell = new
            if i >= last:
                ends = np.flatnonzero(same & (cut[i : i + width] == 0))
                if len(ends):
                    score = longer[ends] >> 24
                    top = int(score.max())
                    ends = ends[score == top]
                    sizes = i + ends + 2 - (longer[ends] & (one - 1))
                    k = int(np.argmin(sizes))
                    if top > best or top == best and sizes[k] < length:
                        best, length, end = top, int(sizes[k]), base + i + int(ends[k]) + 1
        coverage = best / len(own)
        if not best or coverage < self.coverage or len(own) < SHORT and not best == len(own) == length:
            return None
        return Match(self.names[t], end - length - start, end - start, coverage, best)


def _common(own: np.ndarray, text: np.ndarray) -> int:
    """The length of the longest common sequence, a row of the table as the bits of one number."""
    places: dict[int, int] = dict.fromkeys(own.tolist(), 0)
    for j, word in enumerate(text.tolist()):
        if word in places:
            places[word] |= 1 << j
    full = row = (1 << len(text)) - 1
    for word in own.tolist():
        met = row & places[word]
        row = ((row + met) | (row - met)) & full
    return len(text) - row.bit_count()


def scan(
    docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, coverage: float = COVERAGE, text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows of `docs` with n_licenses, licenses (distinct names, sorted) and matches.

    matches: license, begin and end (code points, end exclusive), coverage (share of the template's words, in order). Null
    and empty texts have none. Columns that have one of these names are replaced. The templates are an argument, not a
    table.
    """

    def maker():
        index = Index(templates, coverage)

        def make(texts):
            words = split(texts, LETTERS)
            found: list[list[dict]] = [[] for _ in range(len(texts))]
            for i, m in index.matches(words):
                first = words.first[i]
                bounds = words.begin[first + m.begin], words.end[first + m.end - 1]
                found[i].append({"license": m.license, "bytes": bounds, "coverage": m.coverage})
            for i, own in enumerate(found):
                for m in own:
                    bounds = m.pop("bytes")
                    m["begin"], m["end"] = (int(((words.raw[words.starts[i] : x] & 0xC0) != 0x80).sum()) for x in bounds)
            kind = pa.list_(pa.struct([("license", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())]))
            names = [sorted({m["license"] for m in own}) for own in found]
            return [pa.array(list(map(len, names)), pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(found, kind)]

        return make

    fields = "n_licenses long, licenses array<string>, matches array<struct<license:string,begin:int,end:int,coverage:double>>"
    return with_columns(docs, text, fields, maker, keep)

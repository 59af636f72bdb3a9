"""License scans by conditional compression.

A candidate block is the words around a word of license notices, across lines; blocks
that touch are one. Names with their versions, and phrases of the license texts that
are telling without a name, are looked for from left to right. The words around such a
place are compressed alone and with every template of every license as a zstandard raw
dictionary. The templates that shorten them, by bytes saved, are confirmed by wording:
each is aligned with the words, no further than it reaches, and the stretch that agrees
must hold its license's name or phrase. Of the confirmed ones the template that saves
most bytes of its own stretch wins, and the search goes on behind the notice. Lines that state a license by its SPDX identifier are read as
such. Equal blocks, and equal words around a name, are judged once per worker.

Defined results: a null or empty text has no notices; a tie goes to the longer
agreement, then to the template listed first; a mention of fewer than GRANT words needs
an "under" shortly before its name; positions are code points, the end exclusive. Every
row is judged by itself, repeated ones too, and a repeated line is a notice each time;
an empty table gives an empty table; a column already named `out` is replaced and all
others pass unchanged.
"""

from __future__ import annotations

import bisect
import functools
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from shelfcast.llm.shipping import append_column

#: Notices and texts of public licenses, each by itself.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}
HINT = re.compile(r"licen[sc]e|permission is hereby|redistribution and use|unencumbered|copyright", re.I)
_WORD = re.compile(r"[\w.+-]*\w")
#: What tells a license apart, in words joined by single spaces.
NAMES = {
    name: re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")
    for name, pattern in {
        "Apache-2.0": r"apache(?: software)?(?: licen[sc]e)?(?: version| v\.?)? v?2(?:\.0)?|apache-2\.0",
        "MIT": r"mit licen[sc]e|permission is hereby granted free of charge to any person obtaining a copy of this software",
        "GPL-3.0": r"(?:general public licen[sc]e|gnu gpl|(?<!lesser )(?<!affero )gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v\.?)? v?3(?:\.0)?|gplv3|gpl-3\.0",
        "CC-BY-NC-4.0": r"cc[ -]by-nc[ -]4\.0|creative commons attribution-noncommercial 4\.0",
        "CC-BY-4.0": r"cc[ -]by[ -]4\.0|creative commons attribution 4\.0",
        "BSD-3-Clause": r"(?:bsd )?(?:3|three)-clause bsd|bsd (?:3|three)-clause|bsd-3-clause|redistribution and use in source and binary forms(?= .*\bneither the name\b)",
        "MPL-2.0": r"mozilla public licen[sc]e(?: version| v\.?)? v?2(?:\.0)?|mpl[ -]v?2\.0",
        "Unlicense": r"the unlicense|free and unencumbered software released into the public domain",
    }.items()
}
#: Wording that is telling where no name stands; it follows the name in its template.
PHRASES = {
    name: re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")
    for name, pattern in {
        "Apache-2.0": r"https? www\.apache\.org licenses license-2\.0",
        "MIT": r"in no event shall the authors or copyright holders be liable for any claim",
        "BSD-3-Clause": r"neither the name of the copyright holder nor the names of its contributors",
        "MPL-2.0": r"if a copy of the mpl was not distributed with this file",
        "Unlicense": r"anyone is free to copy modify publish use compile sell or distribute this software",
    }.items()
}
_OTHER = re.compile(r"(?<![^ ])(?:lesser|library|affero)(?: gnu)? general public licen[sc]e")
_STATED = re.compile(r"(?:SPDX-License-Identifier|\blicen[sc]e)[ \t]*:[ \t]*([\w.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[\w.+()-]+)*)(?=[ \t]*(?:$|\*/|-->|[\"',;.]))", re.I | re.M)
_CLOSE = re.compile(r"[.)\"']*")
_SUFFIX = re.compile(r"(?:-only|-or-later|\+)$")
#: A stretch has at most a fifth of errors from either end on: an error outweighs four agreeing words.
ERROR = 4
LEAST, GRANT = 3, 5
#: Words of a notice without a name, and the share of them that may differ.
NAMELESS, DIFFER = 16, 0.1
#: Words on either side of a hint, and from a notice to the words that complete its name.
AROUND = 90
NOTICE = "array<struct<license:string,start:int,end:int,reduction:double,difference:double>>"


@functools.lru_cache(maxsize=1)
def _compressors():
    own = zstandard.ZstdCompressor(level=3)
    return own, {
        (name, k): zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for name, listed in TEMPLATES.items()
        for k, t in enumerate(listed)
    }


def _words(text: str) -> list[tuple[str, int, int]]:
    """(word in lower case, start, end)."""
    return [(w, m.start(), m.end()) for m in _WORD.finditer(text) if (w := m[0].lower().strip("+-._"))]


@functools.lru_cache(maxsize=1)
def _phrases() -> dict[tuple[str, bool], dict[int, tuple[list[str], int, int]]]:
    """Per license, by name or by phrase, its templates that hold it: words, and words before and after it."""
    found: dict[tuple[str, bool], dict] = {}
    for name, listed in TEMPLATES.items():
        for named, patterns in ((True, NAMES), (False, PHRASES)):
            found[name, named] = {}
            for k, t in enumerate(listed):
                words = [w for w, _, _ in _words(t)]
                m = patterns[name].search(" ".join(words)) if name in patterns else None
                if m:
                    before = " ".join(words)[: m.start()].count(" ")
                    inside = m[0].count(" ") + 1
                    found[name, named][k] = (words, before, len(words) - before - inside)
    return found


def _stretch(words: list[str], template: list[str], first: int, last: int) -> tuple[int, int, int, int]:
    """(score, begin, end, agreeing words) of the best local alignment that holds the words from `first` to `last`."""
    # Per place in the template: (score, begin in the words, agreeing words) of the best alignment that ends there.
    empty = (0, 0, 0)
    above, best = [empty] * (len(template) + 1), (0, 0, 0, 0)
    for i, word in enumerate(words):
        row = [empty]
        for j, other in enumerate(template):
            score, begin, same = above[j]
            if word == other:
                options = [(score + 1, begin if score else i, same + 1)]
            else:
                options = [(score - ERROR, begin, same)]
            options += [(x[0] - ERROR, x[1], x[2]) for x in (above[j + 1], row[j])]
            found = max(options, key=lambda x: x[0])
            row.append(found if found[0] > 0 else empty)
            if found[0] > best[0] and found[1] <= first and i >= last:
                best = (found[0], found[1], i + 1, found[2])
        above = row
    return best


def _saved(name: str, k: int, text: str) -> tuple[int, float]:
    """Bytes, and share of bytes, by which the template shortens the compressed text."""
    own, conditional = _compressors()
    raw = text.encode()
    alone = len(own.compress(raw))
    saved = alone - len(conditional[name, k].compress(raw))
    return saved, saved / alone


@functools.lru_cache(maxsize=1)
def _plain_compressors():
    return {
        (name, k): zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(" ".join(w for w, _, _ in _words(t)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for name, listed in TEMPLATES.items()
        for k, t in enumerate(listed)
    }


@functools.lru_cache(maxsize=20_000)
def _ranked(words: str) -> tuple[tuple[str, int], ...]:
    """The templates (license, number) of all licenses that shorten the compressed words, by bytes saved, most first."""
    raw = words.encode()
    alone = len(_compressors()[0].compress(raw))
    sizes = {template: len(c.compress(raw)) for template, c in _plain_compressors().items()}
    return tuple(sorted((x for x in sizes if sizes[x] < alone), key=sizes.get))


@functools.lru_cache(maxsize=20_000)
def _agreement(name: str, k: int, named: bool, words: tuple[str, ...], first: int, last: int) -> tuple[int, int, int, int] | None:
    """(score, begin, end, agreeing words) of a template aligned around its license's name or phrase at first..last."""
    if k not in _phrases()[name, named]:
        return None
    template, before, after = _phrases()[name, named][k]
    low = max(0, first - before - len(template) // ERROR - 1)
    high = last + 1 + after + len(template) // ERROR + 1
    score, begin, end, same = _stretch(list(words[low:high]), template, first - low, last - low)
    return (score, begin + low, end + low, same) if same and end - begin >= LEAST else None


@functools.lru_cache(maxsize=20_000)
def judge(block: str) -> tuple[tuple[str, int, int, float, float], ...]:
    """(license, start, end, share of bytes saved, share of words that differ) of the notices in a block."""
    words, found = _words(block), []
    plain = [w for w, _, _ in words]
    joined = " ".join(plain)
    starts, at = [], 0
    for w in plain:
        starts.append(at)
        at += len(w) + 1
    others = [m.span() for m in _OTHER.finditer(joined)]
    other_ends = [e for _, e in others]

    def is_other(begin: int, end: int) -> bool:
        i = bisect.bisect_right(other_ends, begin)
        return i < len(others) and others[i][0] < end

    order = list(TEMPLATES)
    places = []
    for is_name, patterns in ((True, NAMES), (False, PHRASES)):
        for name, pattern in patterns.items():
            for m in pattern.finditer(joined):
                if not is_other(*m.span()):
                    first = bisect.bisect_right(starts, m.start()) - 1
                    last = bisect.bisect_right(starts, m.end() - 1) - 1
                    places.append((first, last, order.index(name), name, is_name))
    places.sort()
    names = [x[:4] for x in places if x[4]]
    firsts = [x[0] for x in names]
    low = 0
    for i, here in enumerate(places):
        rivals = [x for x in places[i : i + 2 * len(NAMES)] if x[0] <= here[1]]
        options = []
        for first, last, place, name, is_name in rivals:
            if first < low:
                continue
            base = max(low, first - AROUND)
            high = _next_name(names, bisect.bisect_right(firsts, here[0]), last, name, len(plain))
            around = tuple(plain[base:high])
            agreed = []
            for other, k in _ranked(" ".join(around)):
                if other == name and (found_at := _agreement(name, k, is_name, around, first - base, last - base)):
                    agreed.append((k, *found_at))
            if not is_name:
                agreed = [x for x in agreed if x[3] - x[2] >= NAMELESS and 1 - x[4] / (x[3] - x[2]) <= DIFFER]
            # A name that is spelt unlike every template is a notice with the words of a grant before it.
            elif not agreed:
                agreed = [(0, last + 1 - first, first - base, last + 1 - base, last + 1 - first)]
            for k, score, begin, end, same in agreed:
                begin, end = begin + base, end + base
                if is_name and end - begin < GRANT and "under" not in plain[max(low, first - 7) : first]:
                    continue
                saved, share = _saved(name, k, block[words[begin][1] : words[end - 1][2]])
                options.append((saved, score, -place, name, begin, end, share, max(0.0, 1 - same / (end - begin))))
        if options:
            _, _, _, name, begin, end, share, differ = max(options)
            found.append((name, words[begin][1], words[end - 1][2], share, differ))
            low = end
    return tuple(found)


def _next_name(named: list[tuple], i: int, last: int, name: str, n: int) -> int:
    """Where the words end that a notice may reach: at the next name of another license, at most AROUND words on."""
    high = min(n, last + 1 + 2 * AROUND)
    for first, _, _, other in named[i : i + 8]:
        if first > last and other != name:
            return min(high, first)
    return high


_BY_ID = {name.lower(): name for name in TEMPLATES}


def _stated(text: str) -> list[tuple[str, int, int, float, float]]:
    found = []
    for m in _STATED.finditer(text):
        for part in re.split(r"[\s()]+", m[1]):
            if name := _BY_ID.get(_SUFFIX.sub("", part.lower())):
                found.append((name, m.start(), m.end(1), _saved(name, 0, m[0])[1], 0.0))
    return found


def notices(text: str | None) -> list[dict]:
    if not text or not HINT.search(text):
        return []
    stated = _stated(text)
    found = list(stated)
    ends = [m.end() for m in _WORD.finditer(text)]
    starts = [m.start() for m in _WORD.finditer(text)]
    areas: list[list[int]] = []
    for m in HINT.finditer(text):
        k = bisect.bisect_right(starts, m.start()) - 1
        low, high = max(0, k - AROUND), min(len(starts), k + AROUND)
        if areas and low <= areas[-1][1]:
            areas[-1][1] = high
        else:
            areas.append([low, high])
    for low, high in areas:
        begin, end = starts[low], ends[high - 1]
        for name, a, b, saved, differ in judge(text[begin:end]):
            a, b = a + begin, b + begin
            if not any(x < b and a < y for _, x, y, _, _ in stated):
                found.append((name, a, b + len(_CLOSE.match(text, b)[0]), saved, differ))
    keys = ("license", "start", "end", "reduction", "difference")
    return [dict(zip(keys, x, strict=True)) for x in sorted(found, key=lambda x: x[1:3])]


def scan(df: DataFrame, text: str = "text", out: str = "notices") -> DataFrame:
    """`df` with the license notices of each text."""
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("reduction", pa.float64()), ("difference", pa.float64())]))
    return append_column(df, text, out, NOTICE, lambda column: pa.array([notices(t) for t in column.to_pylist()], kind))

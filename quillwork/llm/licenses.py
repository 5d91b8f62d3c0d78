"""License scans by conditional compression.

Lines that speak of licensing are the candidates; neighbouring ones form a block. A block is compressed alone and with each
template as a raw zstandard dictionary, and the templates are ranked by the bytes they save. In that
order they have to be confirmed by wording: words are aligned, and the differences inside the aligned part must be few and
must not touch a number, a negation or a license's name. The first one confirmed is the
license of that part, and what is before and behind it is ranked anew, until no template is left. Only
templates are compressed with whose words could still align somewhere in the block, as no other can be confirmed.

Licenses granted by name have templates of their own: the words around each grant are compressed with the names of every
license, ranked in the same way, and confirmed where name and version stand there exactly.

Defined results: a null or empty text has no block; a block that no template explains
has license null; equal blocks have equal results; a row comes back for each license of
each candidate block, in whatever number; very long blocks are cut with an overlap longer than any template; of templates that save
as much the first in the list goes first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.llm.common import table

TRIGGER = (
    r"(?i)licen[sc]e|copyright|permission|warrant|redistribut|liabilit|public domain|creative commons|\bcc[ -]by"
    r"|\b[al]?gpl(?:v?[0-9]|\b)|\bcc0\b|\bunder (?:the )?(?:mit|bsd|isc|apache|zlib|mpl|epl)\b"
)
#: Lines without a trigger that may stand inside a block.
BRIDGE = 4
#: Longest line that may be part of a wrapped notice without a trigger of its own.
WRAPPED = 100
BREAKS = "\r\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
PIECE_WORDS, OVERLAP_WORDS = 2000, 400
LEVEL = 12
#: Share of a template's words that may be missing, and of aligned words that may be added.
MISSING, ADDED = 0.1, 0.1
CACHED = 50_000

# Public license notices as their stewards word them, (license, form): text.
TEMPLATES = {
    ("MIT", "name"): "Released under the MIT License.",
    ("MIT", "grant"): (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        ' files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,'
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice"
        ' shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY'
        " OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER"
        " LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR"
        " THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    ("ISC", "grant"): (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies."
    ),
    ("Apache-2.0", "name"): "Licensed under the Apache License, Version 2.0.",
    ("Apache-2.0", "notice"): (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the'
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable"
        ' law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES'
        " OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and"
        " limitations under the License."
    ),
    ("GPL-2.0", "name"): "This work is licensed under the GNU General Public License, version 2.",
    ("GPL-3.0", "name"): "This work is licensed under the GNU General Public License, version 3.",
    ("LGPL-3.0", "name"): "This work is licensed under the GNU Lesser General Public License, version 3.",
    ("AGPL-3.0", "name"): "This work is licensed under the GNU Affero General Public License, version 3.",
    ("GPL-3.0", "notice"): (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    ("GPL-2.0", "notice"): (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    ("MPL-2.0", "notice"): (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    ("BSD-3-Clause", "grant"): (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
        " the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the"
        " copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission."
    ),
    ("BSD-3-Clause", "name"): "Licensed under the BSD 3-Clause License.",
    ("Unlicense", "grant"): "This is free and unencumbered software released into the public domain.",
    ("CC-BY-4.0", "name"): "Licensed under CC BY 4.0.",
    ("CC-BY-SA-4.0", "name"): "Licensed under CC BY-SA 4.0.",
    ("CC-BY-NC-4.0", "name"): "Licensed under CC BY-NC 4.0.",
    ("CC-BY-ND-4.0", "name"): "Licensed under CC BY-ND 4.0.",
    ("CC-BY-4.0", "notice"): "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ("CC-BY-NC-4.0", "notice"): "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ("CC-BY-SA-4.0", "notice"): "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}
_AS_IS = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT' \
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE" \
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES" \
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)" \
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)" \
    " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC_AS_IS = ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES' \
    " OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR" \
    " ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS" \
    " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD_2 = TEMPLATES["BSD-3-Clause", "grant"].partition(" Neither")[0]
TEMPLATES |= {
    ("BSD-2-Clause", "grant"): _BSD_2,
    ("BSD-2-Clause", "text"): _BSD_2 + _AS_IS,
    ("BSD-3-Clause", "text"): TEMPLATES["BSD-3-Clause", "grant"] + _AS_IS,
    ("ISC", "text"): TEMPLATES["ISC", "grant"] + _ISC_AS_IS,
    ("0BSD", "text"): (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted." + _ISC_AS_IS
    ),
    ("Zlib", "text"): (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any"
        " damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this"
        " software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a"
        " product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be"
        " plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered"
        " from any source distribution."
    ),
    ("LGPL-2.1", "notice"): (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    ("LGPL-3.0", "notice"): (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    ("AGPL-3.0", "notice"): (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    ("EPL-2.0", "notice"): (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available"
        " at https://www.eclipse.org/legal/epl-2.0/"
    ),
    ("CC0-1.0", "notice"): (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
}
#: A template's license is another one where the words after its begin, as far as FURTHER beyond its end, say this.
EXCEPT = {"BSD-2-Clause": re.compile("endorse or promote|advertising materials")}
FURTHER = 80


def _group(license: str) -> str:
    return "is_" + re.sub(r"\W", "_", license)


def _version(number: str) -> str:
    return rf"(?: version| v)? ?v?{re.escape(number)}(?:\.0)?(?: only| or later)?"


def _gnu(kind: str, short: str, number: str) -> str:
    return rf"(?:gnu )?(?:{kind}general public licen[sc]e|{short}){_version(number)}"


def _cc(parts: str, words: str) -> str:
    return rf"(?:cc {parts}|creative commons {words})(?: licen[sc]e)?(?: version| v)? ?v?4\.0"


# Names and versions as words_of gives them, by license.
PATTERNS = {
    "MIT": r"(?:mit|expat)",
    "ISC": r"isc",
    "0BSD": r"(?:0bsd|(?:bsd )?(?:zero|0) clause(?: bsd)?)",
    "BSD-2-Clause": r"(?:(?:new )?bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)",
    "BSD-3-Clause": r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)",
    "Apache-2.0": r"(?:apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?v?2(?:\.0)?)",
    "GPL-2.0": _gnu("", "gpl", "2"),
    "GPL-3.0": _gnu("", "gpl", "3"),
    "LGPL-2.1": _gnu("(?:lesser|library) ", "lgpl", "2.1"),
    "LGPL-3.0": _gnu("lesser ", "lgpl", "3"),
    "AGPL-3.0": _gnu("affero ", "agpl", "3"),
    "MPL-2.0": rf"(?:mozilla public licen[sc]e|mpl){_version('2')}",
    "EPL-2.0": rf"(?:eclipse public licen[sc]e|epl){_version('2')}",
    "Zlib": r"zlib",
    "Unlicense": r"unlicense",
    "CC0-1.0": r"(?:cc0(?: 1\.0)?|creative commons (?:cc0|zero)(?: v?1\.0)?)",
    "CC-BY-SA-4.0": _cc("by sa", "attribution sharealike"),
    "CC-BY-NC-4.0": _cc("by nc", "attribution noncommercial"),
    "CC-BY-ND-4.0": _cc("by nd", "attribution noderivatives"),
    "CC-BY-NC-SA-4.0": _cc("by nc sa", "attribution noncommercial sharealike"),
    "CC-BY-NC-ND-4.0": _cc("by nc nd", "attribution noncommercial noderivatives"),
    "CC-BY-4.0": _cc("by", "attribution"),
}
# The licenses' full names, as grants spell them.
FULL_NAMES = {
    "MIT": "MIT License, Expat License",
    "ISC": "ISC License",
    "0BSD": "0BSD, BSD Zero Clause License, Zero-Clause BSD",
    "BSD-2-Clause": "BSD 2-Clause License, 2-Clause BSD, Simplified BSD License, FreeBSD License",
    "BSD-3-Clause": "BSD 3-Clause License, 3-Clause BSD, New BSD License, Modified BSD License",
    "Apache-2.0": "Apache License, Version 2.0, Apache Software License 2.0",
    "GPL-2.0": "GNU General Public License, version 2, GPLv2",
    "GPL-3.0": "GNU General Public License, version 3, GPLv3",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1, GNU Library General Public License, LGPLv2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3, LGPLv3",
    "AGPL-3.0": "GNU Affero General Public License, version 3, AGPLv3",
    "MPL-2.0": "Mozilla Public License, version 2.0, MPL 2.0",
    "EPL-2.0": "Eclipse Public License 2.0, EPL 2.0",
    "Zlib": "zlib License",
    "Unlicense": "The Unlicense",
    "CC0-1.0": "CC0 1.0, Creative Commons Zero 1.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0, Creative Commons Attribution-ShareAlike 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0, Creative Commons Attribution-NonCommercial 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0, Creative Commons Attribution-NoDerivatives 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0, Creative Commons Attribution-NonCommercial-ShareAlike 4.0",
    "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0, Creative Commons Attribution-NonCommercial-NoDerivatives 4.0",
    "CC-BY-4.0": "CC BY 4.0, Creative Commons Attribution 4.0",
}
NAME_TEMPLATES = {(k, "names"): f"SPDX-License-Identifier: {k}. Licensed under the terms of the {names}" for k, names in FULL_NAMES.items()}
# a name ends where no other version or number follows
NAME = re.compile(
    " (?:" + "|".join(f"(?P<{_group(k)}>{p})" for k, p in PATTERNS.items())
    + r")(?![^ ])(?! (?:v ?|version )?[0-9])"
)
#: A license named as a field of a file, such as "License: MIT".
FIELD = re.compile(r"(?i)\blicen[sc]e[\"']?\s*[:=]")
GRANT = re.compile(
    r"(?:\bunder|\bsubject to|\bgoverned by)(?: the| a| an)?(?: terms?| conditions?)?(?: and conditions)?(?: of)?(?: either)?(?: the| a| an)?(?= )"
    r"|\bspdx license identifier(?= )|\blicenseis(?= )|\breleased into the public domain (?:with|by|via|using)(?= )"
)
#: What joins two names of one grant.
MORE = re.compile(r"(?: licen[sc]e)? (?:or|and)(?: the)?(?= )")
SENTENCE = re.compile(r"(?<=[.;!?])\s+(?=[A-Z])")
#: Words that turn a grant behind them into none, and how far before it in its sentence.
NEGATED = frozenset("not no never neither nor cannot t without unless previously formerly unlike instead".split())
NEAR_WORDS, NEAR_SIGNS = 6, 200
# Words whose change makes it another license.
NAMES = frozenset(
    "mit isc bsd apache gnu gpl lgpl agpl lesser affero general mozilla mpl cc by sa nc nd attribution noncommercial sharealike"
    " noderivatives commons unencumbered not no non neither nor without".split()
)
TRIGGERS = re.compile(TRIGGER)
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
#: Numbers of the conditions in a list, which templates leave out.
LISTED = re.compile(r"(?<=[.:;])[\s*#/>-]+\(?[1-9][.)](?=\s)")


def words_of(text: str) -> list[str]:
    return WORD.findall(LISTED.sub(" ", text).lower())


@dataclass(frozen=True)
class Found:
    license: str | None
    form: str | None
    reduction: float | None
    missing: tuple[str, ...]
    added: tuple[str, ...]


class Scanner:
    """Templates ready to compress with and to compare with; one per task."""

    def __init__(self, templates: dict[tuple[str, str], str] = TEMPLATES):
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.words = {key: words_of(text) for key, text in templates.items()}
        self.given = {}
        for key, words in {**self.words, **{key: words_of(text) for key, text in NAME_TEMPLATES.items()}}.items():
            raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[key] = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)
        self.cache: dict[str, Found] = {}

    def ranked(self, words: list[str], keys: Iterable[tuple[str, str]]) -> list[tuple[tuple[str, str], float]]:
        """The templates by the bytes that each saves as a dictionary when the words are compressed, and the share it saves."""
        block = " ".join(words).encode()
        alone = len(self.alone.compress(block))
        sizes = [(len(self.given[key].compress(block)), key) for key in keys]
        return [(key, 1 - size / alone) for size, key in sorted(sizes, key=lambda s: s[0])]

    def windows(self, words: list[str], key: tuple[str, str]) -> Iterator[tuple[int, int]]:
        """(begin, end) of all parts where the template's words could still align; the best window of each part follows it."""
        template = self.words[key]
        size, need = len(template), len(template) - int(MISSING * len(template))
        width, slack = size + max(1, int(ADDED * size)), int(MISSING * size)
        left = Counter(template)
        if sum((left & Counter(words)).values()) < need:
            return
        # how often each word may still be counted, as the window moves on by one word
        held, places = 0, []
        for k, word in enumerate(words):
            if word in left:
                held += left[word] > 0
                left[word] -= 1
            if k >= width and (gone := words[k - width]) in left:
                left[gone] += 1
                held -= left[gone] > 0
            if held >= need:
                places.append((max(0, k + 1 - width), held))
        part = []
        for k, place in enumerate(places):
            part.append(place)
            if k + 1 == len(places) or places[k + 1][0] > place[0] + width:
                best = max(part, key=lambda x: x[1])[0]
                for begin, end in ((part[0][0], place[0] + width), (best, best + width)):
                    yield max(0, begin - slack), min(len(words), end + slack)
                part = []

    def differences(self, words: list[str], key: tuple[str, str]) -> tuple[tuple[str, ...], tuple[str, ...], int, int]:
        """Template words that the block lacks, block words inside the aligned part that the template lacks, and that part."""
        template = self.words[key]
        moves = SequenceMatcher(None, template, words, autojunk=False).get_opcodes()
        same = [k for k, m in enumerate(moves) if m[0] == "equal"]
        if not same:
            return tuple(template), (), 0, 0
        missing, added = [], []
        for k, (kind, a, b, c, d) in enumerate(moves):
            if kind != "equal":
                missing += template[a:b]
                if same[0] < k < same[-1]:
                    added += words[c:d]
                elif b > a:  # a replacement at an end takes the place of as many words
                    added += words[max(c, d - (b - a)) : d] if k < same[0] else words[c : min(d, c + b - a)]
        return tuple(missing), tuple(added), moves[same[0]][3], moves[same[-1]][4]

    def scan(self, text: str) -> list[Found]:
        """The licenses confirmed in a block, each form once; one empty result if there is none."""
        found = self.cache.get(text)
        if found is None:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            words, by_form = words_of(text), {}
            for begin in range(0, max(1, len(words) - OVERLAP_WORDS), PIECE_WORDS - OVERLAP_WORDS):
                for f in self._scan(words[begin : begin + PIECE_WORDS]):
                    by_form.setdefault((f.license, f.form), f)
            found = self.cache[text] = list(by_form.values()) or [Found(None, None, 0.0, (), ())]
        return found

    def _scan(self, words: list[str]) -> list[Found]:
        if len(words) < 3 or not TRIGGERS.search(" ".join(words)):
            return []
        places = {key: parts for key in self.words if (parts := list(self.windows(words, key)))}
        for key, reduction in self.ranked(words, places) if places else ():
            for first, last in places[key]:
                if confirmed := self.confirmed(words, key, first, last):
                    missing, added, begin, end = confirmed
                    return [*self._scan(words[:begin]), Found(*key, reduction, missing, added), *self._scan(words[end:])]
        return []

    def confirmed(self, words: list[str], key: tuple[str, str], first: int, last: int):
        """(missing, added, begin, end) if the template's wording stands between two places; begin and end are its own."""
        size = len(self.words[key])
        missing, added, begin, end = self.differences(words[first:last], key)
        if len(missing) > MISSING * size or len(added) > max(1, ADDED * size):
            return None
        if any(w in NAMES or any(map(str.isdigit, w)) for w in (*missing, *added)):
            return None
        after = " ".join(words[first + begin : first + end + FURTHER])
        if key[0] in EXCEPT and EXCEPT[key[0]].search(after):
            return None
        return missing, added, first + begin, first + end

    def named(self, text: str) -> list[Found]:
        """Licenses granted by name and version, in their order; for each grant all names are ranked and those that stand there confirmed."""
        out: dict[str, Found] = {}
        for window, licenses in grants(text):
            shares = {key[0]: reduction for key, reduction in self.ranked(window, NAME_TEMPLATES) if key[0] in licenses}
            for license in licenses:
                out.setdefault(license, Found(license, "name", shares[license], (), ()))
        return list(out.values())


def grants(text: str) -> Iterator[tuple[list[str], list[str]]]:
    """For each grant by name: the words around it, and the licenses that stand there by name and version. None behind a negation."""
    said = " ".join(words_of(FIELD.sub(" licenseis ", SENTENCE.sub(" sentenceend ", text))))
    for m in GRANT.finditer(said):
        before = said[max(0, m.start() - NEAR_SIGNS) : m.start()].rpartition("sentenceend")[2].split()[-NEAR_WORDS:]
        at, found = m.end(), []
        while name := NAME.match(said, at):
            found.append(next(k for k in PATTERNS if name[_group(k)]))
            last = name.end()
            # further names of the same grant
            more = MORE.match(said, last)
            at = more.end() if more else len(said)
        if found and not NEGATED.intersection(before):
            yield [*before, *said[m.start() : last].split()], list(dict.fromkeys(found))


def blocks_of(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of candidate blocks: lines with a trigger, few others between them, and wrapped lines at their ends."""
    lines, at = [], 0
    for line in text.splitlines(keepends=True):
        lines.append((at, at + len(line.rstrip(BREAKS)), bool(TRIGGERS.search(line))))
        at += len(line)
    hits = [k for k, line in enumerate(lines) if line[2]]
    done = at = 0
    while at < len(hits):
        first = last = hits[at]
        while at < len(hits) and hits[at] - last <= BRIDGE + 1:
            last = hits[at]
            at += 1
        begin, end = first, last
        while begin > max(done, first - BRIDGE) and lines[begin - 1][1] - lines[begin - 1][0] <= WRAPPED:
            begin -= 1
        while end + 1 < min(len(lines), last + BRIDGE + 1, hits[at] if at < len(hits) else len(lines)) and lines[end + 1][1] - lines[end + 1][0] <= WRAPPED:
            end += 1
        done = end + 1
        yield lines[begin][0], lines[end][1]


def licenses_of(scanner: Scanner, block: str) -> list[Found]:
    """What the wording of notices confirms, and further licenses that are granted by name."""
    found = [f for f in scanner.scan(block) if f.license]
    have = {f.license for f in found}
    found += [f for f in scanner.named(block) if f.license not in have]
    return found or [Found(None, None, 0.0, (), ())]


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: dict = TEMPLATES) -> DataFrame:
    """(doc_id, start, end, license, form, reduction, missing, added): a row for each license of each candidate block, in code points."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).where(F.col("text").rlike(TRIGGER))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            ids, places, found = [], [], []
            for k, text in enumerate(batch.column("text")):
                text = text.as_py()
                for start, end in blocks_of(text):
                    for f in licenses_of(scanner, text[start:end]):
                        ids.append(k)
                        places.append((start, end))
                        found.append(f)
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(ids, pa.int64())),
                    pa.array([p[0] for p in places], pa.int32()),
                    pa.array([p[1] for p in places], pa.int32()),
                    pa.array([f.license for f in found], pa.string()),
                    pa.array([f.form for f in found], pa.string()),
                    pa.array([f.reduction for f in found], pa.float64()),
                    pa.array([list(f.missing) for f in found], words),
                    pa.array([list(f.added) for f in found], words),
                ],
                names=["doc_id", "start", "end", "license", "form", "reduction", "missing", "added"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, start int, end int, license string, form string, reduction double, missing array<string>, added array<string>"
    )


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "start", "end", "license", "form", F.round("reduction", 4).alias("reduction"),
        F.size("missing").alias("n_missing"), F.size("added").alias("n_added"),
    )

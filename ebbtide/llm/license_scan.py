"""License scans by conditional compression.

Units of a text are its lines, cut after sentences. A unit is a candidate if most of its
words occur in the templates; a block is a run of candidates with a license stem in it.
Each block is compressed plain and with every template as a zstandard raw dictionary; the
templates rank by how many bytes they save. In this order they are compared with the block
word by word; one is confirmed if its wording differs little enough, and in none of the
words that tell licenses apart (versions, Lesser, Affero, NonCommercial and the like). The
first confirmed one whose telling words are all in the block wins; a block that leaves some
out, such as a line of a notice, goes by the other sentences of its block, else by the only
license that it can be, and is no notice if several can. Blocks come from whole texts; a
text without any license stem is skipped without cutting it.

Defined results: a null or empty text has no block; equal notices are found each time;
equal savings rank by license name; rows are independent, so repeated rows and further
columns pass; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.shared import ROW, map_texts, table



def _gnu(kind: str, version: str, what: str = "program", stop: str = ";") -> tuple[str, str]:
    """The standard notice of a GNU license, without and with its last paragraph."""
    notice = (
        f"This {what} is free software{':' if version == '3' else ';'} you can redistribute it and/or modify it under the "
        f"terms of the GNU {kind} as published by the Free Software Foundation{stop} either version {version} of the License, "
        f"or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"GNU {kind} for more details."
    )
    copy = f" You should have received a copy of the GNU {kind} along with this {what}"
    if version == "3":
        return notice, f"{notice}{copy}. If not, see <https://www.gnu.org/licenses/>."
    address = "Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
    return notice, f"{notice}{copy}; if not, write to the Free Software Foundation, {address}"


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    f"{_BSD_2} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Wordings of common licenses and notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU General Public License for more details.",
        _gnu(_GPL, "3", stop=",")[1],
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", *_gnu(_GPL, "2")),
    "LGPL-2.1": _gnu(_LGPL, "2.1", "library"),
    "LGPL-3.0": _gnu(_LGPL, "3", stop=","),
    "AGPL-3.0": _gnu(_AGPL, "3", stop=","),
    "BSD-3-Clause": (_BSD_3, _BSD_3 + _BSD_DISCLAIMER),
    "BSD-2-Clause": (_BSD_2, _BSD_2 + _BSD_DISCLAIMER),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0.",),
    "all-rights-reserved": ("All rights reserved.",),
}
STEMS = ("licen", "copyright", "permission", "warrant", "redistribut", "public domain", "rights reserved", "creative commons")

SHARE = 0.6  # of a unit's words that must occur in templates
DIFFERENT = 0.15  # of the words that may differ
LEAST_WORDS = 3
LEVEL = 3

UNIT = re.compile(r"(?<=[.!?;:])\s+|\n+")
WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")

# Words that tell licenses apart, wherever they stand, and short forms after "by" or "cc".
TELLING = ("lesser", "affero", "noncommercial", "sharealike", "noderiv", "neither", "endorse", "advertising")
SHORT = {"nc": "noncommercial", "sa": "sharealike", "nd": "noderiv"}
NUMBER = re.compile(r"v?(\d+(?:\.\d+)*)")
BEFORE_NUMBER = re.compile(r"(?:.*-)?(?:versions?|v|[al]?gpl|mpl)")
BEFORE_POINT = re.compile(r"(?:.*-)?(?:licen[sc]e|cc0?|by|nc|sa|nd|attribution|noncommercial|sharealike|noderiv\w*)")
WITH_NUMBER = re.compile(r"(?:.*-)?(?:licen[sc]es?|[al]?gpl|mpl|cc0|by|nc|sa|nd)-?v?(\d+(?:\.\d+)*)(?:\D.*)?")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def telling(own: list[str]) -> list[frozenset[str]]:
    """For each word, what in it tells licenses apart: names and version numbers."""
    out, before = [], ""
    for w in own:
        joined, pair = w.replace("-", ""), (before + w).replace("-", "")
        found = {t for t in TELLING if t in joined or t in pair and t not in before.replace("-", "")}
        parts = re.split(r"[-.]", w)
        if "by" in parts or before in ("by", "cc"):
            found |= {SHORT[p] for p in parts if p in SHORT}
        if w == "library" and before == "gnu":
            found.add("library")
        number = NUMBER.fullmatch(w)
        if number and not (BEFORE_NUMBER.fullmatch(before) or "." in w and BEFORE_POINT.fullmatch(before)):
            number = None
        if number := number or WITH_NUMBER.fullmatch(w):
            found.add(re.sub(r"(\.0)+$", "", number[1]))
        out.append(frozenset(found))
        before = w
    return out


@dataclass(frozen=True)
class Notice:
    license: str
    text: str
    saved: int  # bytes that the template saves
    missing: tuple[str, ...]  # words of the template that the block lacks
    added: tuple[str, ...]  # words of the block that the template lacks


def _packer(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    data = None
    if dictionary is not None:
        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]]) -> None:
        pairs = [(name, text) for name, texts in templates.items() for text in texts]
        self.templates = [(name, words(text), _packer(text.lower().encode())) for name, text in pairs]
        self.telling = {tuple(own): frozenset().union(*telling(own)) for _, own, _ in self.templates}
        self.vocabulary = {w for _, own, _ in self.templates for w in own}
        self.named = {name: any(self.telling[tuple(words(t))] for t in texts) for name, texts in templates.items()}
        self.plain = _packer(None)

    def blocks(self, text: str) -> list[str]:
        """Runs of units made of the words of templates, with a license stem in them."""
        low = text.lower()
        if not any(stem in low for stem in STEMS):
            return []
        runs, run = [], []
        for unit in UNIT.split(text):
            own = words(unit)
            if own and sum(w in self.vocabulary for w in own) >= SHARE * len(own):
                run.append(unit.strip())
            elif own:
                runs.append(run)
                run = []
        runs.append(run)
        joined = (" ".join(r) for r in runs if r)
        return [b for b in joined if any(stem in b.lower() for stem in STEMS)]

    def candidates(self, block: str) -> list[tuple[Notice, bool]]:
        """Templates whose wording the block has, the most saving one first, and whether
        all their telling words are in it."""
        own, raw = words(block), block.lower().encode()
        if len(own) < LEAST_WORDS:
            return []
        size = len(self.plain.compress(raw))
        ranked = sorted(
            ((size - len(packer.compress(raw)), name, template) for name, template, packer in self.templates),
            key=lambda r: (-r[0], r[1], len(r[2])),
        )
        told = frozenset().union(*telling(own))
        out = []
        for saved, name, template in ranked:
            needed = self.telling[tuple(template)]
            if saved <= 0 or not told <= needed:
                continue
            missing, added, inside = differences(template, own)
            lacks = frozenset().union(*telling(template)[inside]) - told
            if not lacks and len(missing) + len(added) <= DIFFERENT * len(own):
                out.append((Notice(name, block, saved, missing, added), needed <= told))
        return out

    def notice(self, block: str) -> Notice | None:
        """The best template whose wording the block has, or none."""
        return chosen(self.candidates(block), set())

    def notices(self, block: str) -> list[Notice]:
        """The notice of a block, or those of its sentences where it is no single one."""
        if (whole := self.notice(block)) is not None:
            return [whole]
        parts = [p for p in UNIT.split(block) if p]
        if len(parts) < 2:
            return []
        found = [self.candidates(p) for p in parts]
        told = {n.license for part in found for n, stated in part if stated and self.named[n.license]}
        return [n for n in (chosen(part, told) for part in found) if n is not None]

    def scan(self, text: str) -> list[Notice]:
        return [n for block in self.blocks(text) for n in self.notices(block)]


def chosen(found: list[tuple[Notice, bool]], told: set[str]) -> Notice | None:
    """The first of the candidates whose license the block tells elsewhere, else the first
    whose telling words are all there, else the only license that is left."""
    for pick in ([n for n, _ in found if n.license in told], [n for n, stated in found if stated]):
        if pick:
            return pick[0]
    return found[0][0] if len({n.license for n, _ in found}) == 1 else None


def differences(template: list[str], own: list[str]) -> tuple[tuple[str, ...], tuple[str, ...], slice]:
    """Words that are missing from, and added to, the part of the template that the block
    covers, from its first to its last common word, and that part."""
    steps = SequenceMatcher(None, template, own, autojunk=False).get_opcodes()
    equal = [s for s in steps if s[0] == "equal"]
    if not equal:
        return tuple(template), tuple(own), slice(0, len(template))
    first, last = equal[0][1], equal[-1][2]
    missing = [w for tag, a, b, _, _ in steps if tag != "equal" for w in template[max(a, first) : min(b, last)]]
    added = [w for tag, _, _, c, d in steps if tag != "equal" for w in own[c:d]]
    return tuple(missing), tuple(added), slice(first, last)


@lru_cache(maxsize=2)
def _scanner(templates: tuple[tuple[str, tuple[str, ...]], ...]) -> Scanner:
    return Scanner(dict(templates))


NOTICES = (
    "n_blocks bigint, notices array<struct<license:string,text:string,saved:bigint,"
    "missing:array<string>,added:array<string>>>"
)


def scan(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    row: Column | None = None,
) -> DataFrame:
    """Rows ``(doc, n_blocks, notices)``: number of candidate blocks, confirmed notices in
    the order of the text."""
    fixed = tuple((k, tuple(v)) for k, v in templates.items())

    def start():
        scanner = _scanner(fixed)

        def work(texts):
            out = [], []
            for raw in texts:
                whole = raw.decode("utf-8", "replace") if raw else ""
                blocks = scanner.blocks(whole)
                found = [n for b in blocks for n in scanner.notices(b)]
                out[0].append(len(blocks))
                out[1].append(
                    [
                        {"license": n.license, "text": n.text, "saved": n.saved, "missing": list(n.missing), "added": list(n.added)}
                        for n in found
                    ]
                )
            return list(out)

        return work

    return map_texts(docs, F.col(text), start, T.StructType.fromDDL(NOTICES), row)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), row=F.col("doc_id"))
    return found.select(
        F.col(ROW).alias("doc_id"),
        "n_blocks",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.license")), ",").alias("licenses"),
        F.array_join(F.transform("notices", lambda n: n["text"]), "\n").alias("notices"),
    )

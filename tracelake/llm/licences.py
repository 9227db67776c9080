"""License texts found by template markup compiled to token automata.

A template is license wording with two kinds of regions: ``<<beginOptional>> .. <<endOptional>>``
may be left out, and ``<<var;name;least;most>>`` stands for any ``least`` to ``most`` words.
Everything else is mandatory. A compiled automaton has one state per word; reading a word
moves all live states at once (bits of one integer), optional regions are jumps, replaceable
ones are states that take any word. It accepts only where all mandatory words stand, in
order, with nothing between them. Templates are whole: a license that lacks or alters a condition or the
disclaimer is not accepted. Notices that name a license are templates of their own; of all acceptances
from one place the longest counts.

The automata run only from places where a template's first ``LEAD`` words stand, found by
word hashes over a whole block. Beside them, short fixed phrases are counted everywhere.

Defined results: a null or empty text has no words, no places and score 0; repeated rows give
repeated results; other columns are not read by :func:`scan`, and an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.blocks import LOWER, Hashes, Spans, Texts, blocks

LEAD = 3
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

# Phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Names that give a label of the method's own, without being a fixed phrase.
NAMES = (("the mit license", "mit"),)

# Public license wording, marked up. Whole texts: what is not marked is mandatory.
MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
    <<var;holders;1;20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
    ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"""
ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND <<var;holders;1;20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
    INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;holders;1;20>> BE LIABLE FOR ANY SPECIAL,
    DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
    ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"""
BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY <<var;holders;1;20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
    LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
    <<var;holders;1;20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
    LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
    ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
    OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""
BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: <<var;number;0;1>> Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. <<var;number;0;1>> Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
FOUNDATION = """ as published by the Free Software Foundation"""
WARRANTY_NOTICE = """This <<var;thing;1;1>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
    warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the """
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files<<beginOptional>> (the "Software")<<endOptional>>, to deal in <<var;thing;1;3>> without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies or substantial portions of the Software. """ + MIT_WARRANTY),
    ("mit-0", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files<<beginOptional>> (the "Software")<<endOptional>>, to deal in <<var;thing;1;3>> without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so. """ + MIT_WARRANTY),
    ("isc", """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. """ + ISC_WARRANTY),
    ("0bsd", """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without
        fee is hereby granted. """ + ISC_WARRANTY),
    ("bsd-2-clause", BSD_CONDITIONS + " " + BSD_WARRANTY),
    ("bsd-3-clause", BSD_CONDITIONS + """ <<var;number;0;1>> Neither the name of <<var;holder;1;20>> nor the names of <<var;whose;1;4>> may be used
        to endorse or promote products derived from this software without specific prior written permission. """ + BSD_WARRANTY),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will <<var;holders;1;12>> be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: <<var;number;0;1>> The origin of
        this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
        an acknowledgment in the product documentation would be appreciated but is not required. <<var;number;0;1>> Altered source versions must be
        plainly marked as such, and must not be misrepresented as being the original software. <<var;number;0;1>> This notice may not be removed or
        altered from any source distribution"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and
        by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
        in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
        under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
        THE USE OR OTHER DEALINGS IN THE SOFTWARE"""),
    # notices that put a work under a license by name; whole as well
    ("apache-2", """Licensed under the Apache License, Version 2.0<<beginOptional>> (the "License")<<endOptional>>; you may not use this file except in
        compliance with the License. You may obtain a copy of the License at <<var;address;5;8>> Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
        express or implied. See the License for the specific language governing permissions and limitations under the License"""),
    ("apache-2", """Licensed under <<beginOptional>>the <<endOptional>><<beginOptional>>terms of the <<endOptional>>Apache License<<beginOptional>>,
        Version<<endOptional>> 2.0"""),
    ("mit", """Released under <<beginOptional>>the <<endOptional>><<beginOptional>>terms of the <<endOptional>>MIT License"""),
    ("mit", "Licensed under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    *((label, f"""This <<var;thing;1;1>> is free software<<beginOptional>>: you<<endOptional>><<beginOptional>>; you<<endOptional>> can redistribute it and/or
        modify it under the terms of the GNU {name}General Public License{FOUNDATION}{which}. {WARRANTY_NOTICE}GNU {name}General Public License
        for more details""")
      for name, label, which in (
          ("", "gpl-2", "; either version 2 of the License, or (at your option) any later version"),
          ("", "gpl-3", "<<beginOptional>>,<<endOptional>> either version 3 of the License, or (at your option) any later version"),
          ("", "gpl-2-only", "; version 2<<beginOptional>> of the License<<endOptional>>"),
          ("Lesser ", "lgpl-2.1", "; either version 2.1 of the License, or (at your option) any later version"),
          ("Lesser ", "lgpl-3", "<<beginOptional>>,<<endOptional>> either version 3 of the License, or (at your option) any later version"),
          ("Affero ", "agpl-3", "<<beginOptional>>,<<endOptional>> either version 3 of the License, or (at your option) any later version"))),
    *((label, f"""Licensed under the <<beginOptional>>terms of the <<endOptional>>GNU {name}General Public License<<beginOptional>>,<<endOptional>>
        <<beginOptional>>version <<endOptional>>{v}{number}""")
      for v in ("", "v", "v ")
      for name, label, number in (("", "gpl-3", "3"), ("", "gpl-2", "2"), ("Lesser ", "lgpl-3", "3"), ("Lesser ", "lgpl-2.1", "2.1"), ("Affero ", "agpl-3", "3"))),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
        file, You can obtain one at <<var;address;3;8>>"""),
    *(("epl-2", f"""This program and the accompanying materials are made available under the terms of the Eclipse Public License
        {v}2.0 which <<var;verb;1;2>> available at""") for v in ("", "v", "v ")),
    ("cc-by-nc", "Licensed under CC BY-NC<<beginOptional>>-SA<<endOptional>><<beginOptional>>-ND<<endOptional>><<beginOptional>> <<var;version;2;2>><<endOptional>>"),
    *((label, f"""{start} under <<beginOptional>>the terms of <<endOptional>><<var;article;0;1>> Creative Commons {name} 4.0 International
        <<beginOptional>>Public <<endOptional>>License""")
      for start in ("Licensed", "This work is licensed")
      for label, name in (("cc-by", "Attribution"), ("cc-by-sa", "Attribution-ShareAlike"), ("cc-by-nc", "Attribution-NonCommercial"),
                          ("cc-by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("cc-by-nd", "Attribution-NoDerivatives"))),
)
#: Bodies of long licenses, each a file of its own below ``wordings``: from the first condition to the last.
BODIES = (("apache-2", "apache-2"), ("gpl-2", "gpl-2"), ("gpl-3", "gpl-3"), ("lgpl-2.1", "lgpl-2.1"), ("lgpl-3", "lgpl-3"), ("mpl-2", "mpl-2"),
          ("epl-2", "epl-2"), ("cc0", "cc0"), ("cc-by-sa", "cc-by-sa-4"))


@lru_cache(maxsize=1)
def all_templates() -> tuple[tuple[str, str], ...]:
    """Short licenses, notices, and the bodies of long ones; read where the job is defined and sent along."""
    home = resources.files("tracelake.llm") / "wordings"
    return TEMPLATES + tuple((label, (home / f"{name}.txt").read_text("utf-8")) for label, name in BODIES)


def words_of(text: str | bytes) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text
    return WORD.findall(raw.translate(bytes(LOWER)))


@dataclass(frozen=True)
class Automaton:
    """States are bits; bit i reads the i-th word of the template, the last bit accepts."""

    label: str
    lead: tuple[bytes, ...]
    takes: dict[bytes, int]
    any_word: int
    jumps: tuple[tuple[int, int], ...]
    accept: int

    def _close(self, live: int) -> int:
        for a, b in self.jumps:
            if live >> a & 1:
                live |= 1 << b
        return live

    def longest(self, words) -> int:
        """Words that the longest accepted beginning of ``words`` has, 0 if none."""
        live, best = self._close(1), 0
        for n, w in enumerate(words, 1):
            live = self._close((live & (self.takes.get(w, 0) | self.any_word)) << 1)
            if not live:
                break
            if live >> self.accept & 1:
                best = n
        return best


def compile_template(label: str, markup: str) -> Automaton:
    takes: dict[bytes, int] = {}
    any_word, jumps, opened, at, lead = 0, [], [], 0, []
    mandatory = True
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<beginOptional>>":
            opened.append(at)
            mandatory = mandatory and len(lead) >= LEAD
        elif part == "<<endOptional>>":
            if not opened:
                raise ValueError(f"{label}: an optional region ends that did not begin")
            jumps.append((opened.pop(), at))
        elif part.startswith("<<var;"):
            _, _, least, most = part[2:-2].split(";")
            mandatory = mandatory and len(lead) >= LEAD
            for i in range(int(most)):
                any_word |= 1 << at
                if i >= int(least):
                    jumps.append((at, at + 1))
                at += 1
        elif part.startswith("<<"):
            raise ValueError(f"{label}: unknown markup {part}")
        else:
            for w in words_of(part):
                if mandatory and len(lead) < LEAD:
                    lead.append(w)
                takes[w] = takes.get(w, 0) | 1 << at
                at += 1
    if opened or at == 0:
        raise ValueError(f"{label}: an optional region does not end, or there are no words")
    if not lead:
        raise ValueError(f"{label}: a template begins with mandatory words")
    return Automaton(label, tuple(lead), takes, any_word, tuple(sorted(jumps)), at)


def _hash(words: tuple[bytes, ...] | list[bytes]) -> np.ndarray:
    body = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return Hashes(body).of(np.append(0, end[:-1]), end)


def _stands(h: np.ndarray, row_last: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Places where the words stand one after another inside one row."""
    at = np.flatnonzero(h == want[0])
    at = at[at + len(want) <= row_last[at]]
    for i in range(1, len(want)):
        at = at[h[at + i] == want[i]]
    return at


class Matcher:
    def __init__(self, templates, phrases=PHRASES, names=NAMES):
        self.automata = [compile_template(*t) for t in templates]
        self.leads: dict[tuple[bytes, ...], list[Automaton]] = {}
        for a in self.automata:
            self.leads.setdefault(a.lead, []).append(a)
        self.lead_hashes = {k: _hash(k) for k in self.leads}
        self.phrases, self.names = ([(words_of(p), label, _hash(words_of(p))) for p, label in listed] for listed in (phrases, names))

    def __call__(self, texts: Texts) -> dict[str, list]:
        low = Texts(LOWER[texts.data], texts.offsets)
        words: Spans = low.runs(_IS_WORD[low.data])
        h = Hashes(low.data).of(words.start, words.end)
        n_words = words.per_row
        row = words.row
        row_last = words.first[1:][row]
        body = low.data.tobytes()
        word = lambda i: body[words.start[i]:words.end[i]]
        base: list[list[tuple[int, int, str]]] = [[] for _ in range(len(texts))]
        found: list[list[tuple[int, int, str]]] = [[] for _ in range(len(texts))]
        named: list[list[tuple[int, int, str]]] = [[] for _ in range(len(texts))]
        for listed, places in ((self.phrases, base), (self.names, named)):
            for want, label, key in listed:
                for i in _stands(h, row_last, key).tolist():
                    if [word(i + k) for k in range(len(want))] == want:
                        first = int(words.first[row[i]])
                        places[row[i]].append((i - first, i - first + len(want), label))
        # of all acceptances from one place the longest counts
        longest: dict[int, tuple[int, set[str]]] = {}
        for lead, key in self.lead_hashes.items():
            for i in _stands(h, row_last, key).tolist():
                for a in self.leads[lead]:
                    n = a.longest(word(k) for k in range(i, int(row_last[i])))
                    if n and n >= longest.get(i, (0,))[0]:
                        longest[i] = (n, {a.label} | (longest[i][1] if i in longest and longest[i][0] == n else set()))
        for i, (n, labels) in longest.items():
            first = int(words.first[row[i]])
            found[row[i]] += [(i - first, i - first + n, label) for label in sorted(labels)]
        out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")}
        for r in range(len(texts)):
            places = [b[0] for b in base[r]]
            every = sorted({*base[r], *named[r], *found[r]})
            covered, end = 0, 0
            for a, b, _ in every:
                covered += max(0, b - max(a, end))
                end = max(end, b)
            out["n_words"].append(int(n_words[r]))
            out["n_base"].append(len(places))
            out["first_word"].append(min(places, default=None))
            out["last_word"].append(max(places, default=None))
            out["base_labels"].append(",".join(sorted({b[2] for b in base[r]})))
            out["labels"].append(",".join(sorted({m[2] for m in every})))
            out["score"].append(covered / int(n_words[r]) if covered else 0.0)
            out["matches"].append([{"first_word": a, "end_word": b, "label": x} for a, b, x in sorted(found[r])])
        return out


MATCHES = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string())]))


def scan(docs: DataFrame, templates=None, phrases=PHRASES) -> DataFrame:
    """Places, labels and the share of words in license wording (``score``) of every row, and the accepted ``matches``."""
    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, matches array<struct<first_word:long,end_word:long,label:string>>")
    kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "matches": MATCHES}

    templates = templates or all_templates()

    def run(batches):
        match = Matcher(templates, phrases)
        for batch in batches:
            for rows, texts in blocks(batch):
                got = match(texts)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in got.items())],
                                                 ["doc_id", *got])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)

"""Licence notices found by patience alignment.

A text's words are aligned with each licence template: words that occur exactly once in both
are anchors, the longest increasing subsequence of the anchors is kept, and the gaps between
neighbouring anchors are aligned in the same way, down to gaps without anchors, whose common
ends are matched. Coverage is the share of the template's words that are aligned. Besides
coverage, the words that tell licences apart (names, versions, by/nc/sa, the words of the
clause that another licence lacks) must be aligned, and no word that makes it another licence
(lesser, affero, noncommercial and so on) may stand between the aligned ones.

Templates: the whole texts of the MIT, MIT-0, BSD (two, three and four clauses), 0BSD, ISC, zlib,
NCSA, Boost and Unlicense licences; the notices that the Apache, GNU and Mozilla licences ask for;
and sentences that name one of these, Creative Commons, Eclipse, EU, Artistic, Python or WTFPL
licences. Long texts that are not repeated with software (GPL, Apache, MPL, Creative Commons) are
known by their notices only, and a licence without a template is not reported.

A text is not aligned as a whole: the words of a notice occur elsewhere too, and a notice may
occur twice. A stretch can only reach the wanted coverage if it holds enough words of the
template, so stretches of somewhat more than the template's length with enough of them are
found first (exactly, by counting), best first and without overlap, and each is aligned.

One narrow pass over the whole texts; memory is that of one batch.

Defined results: a row per notice found; texts without one, null and empty texts give none.
Words compare without case. Repeated rows give repeated results; an empty table gives an
empty result. Of templates that cover the same stretch, the one with more aligned words, less
its missing ones, is reported, ties going to the template named first. Other input columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

# fixed values: wording of public licence notices
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
}
_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the \"Software\"), to deal {} the Software without restriction, including without limitation the "
          "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
          "persons to whom the Software is furnished to do so")
_NO_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE {0} BE "
                "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
                "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS {1} THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. {}"
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ADVERTISING = ("All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
                "product includes software developed by the organization. ")
_ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
            "from this software without specific prior written permission. ")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} License as published by the "
        "Free Software Foundation, {2}. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} License for more details. You "
        "should have received a copy of the GNU {1} License along with this {0}.")
_TEXTS = {
    "MIT": [_GRANT.format("in") + ", subject to the following conditions: The above copyright notice and this permission notice shall be included "
            "in all copies or substantial portions of the Software. " + _NO_WARRANTY.format("AUTHORS OR COPYRIGHT HOLDERS", "IN")],
    "MIT-0": [_GRANT.format("in") + ". " + _NO_WARRANTY.format("AUTHORS OR COPYRIGHT HOLDERS", "IN")],
    "NCSA": [_GRANT.format("with") + ", subject to the following conditions: Redistributions of source code must retain the above copyright notice, "
             "this list of conditions and the following disclaimers. Redistributions in binary form must reproduce the above copyright notice, "
             "this list of conditions and the following disclaimers in the documentation and/or other materials provided with the distribution. "
             "Neither the names of the organization nor the names of its contributors may be used to endorse or promote products derived from "
             "this Software without specific prior written permission. " + _NO_WARRANTY.format("CONTRIBUTORS OR COPYRIGHT HOLDERS", "WITH")],
    "BSD-2-Clause": [_BSD.format("")],
    "BSD-3-Clause": [_BSD.format(_ENDORSE)],
    "BSD-4-Clause": [_BSD.format(_ADVERTISING + _ENDORSE)],
    "ISC": [_ISC.format(", provided that the above copyright notice and this permission notice appear in all copies")],
    "0BSD": [_ISC.format("")],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You "
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
             "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this "
             "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
             "product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be "
             "plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered "
             "from any source distribution."],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
                "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
                "so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license "
                "grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and "
                "all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object "
                "code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
                "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
                "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER "
                "LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
                "DEALINGS IN THE SOFTWARE."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                  "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                  "non-commercial, and by any means.",
                  "This is free and unencumbered software released into the public domain."],
}
#: Licence -> its names in a sentence; (the) is left out of names that take no article.
_NAMES = {
    "MIT": ["MIT License", "Expat License"], "MIT-0": ["MIT No Attribution License", "MIT-0 License"], "BSD": ["BSD License"],
    "0BSD": ["0BSD License", "BSD 0-Clause License", "BSD Zero Clause License"], "BSD-4-Clause": ["BSD 4-Clause License", "BSD-4-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "ISC": ["ISC License"], "Zlib": ["zlib License"], "NCSA": ["University of Illinois/NCSA Open Source License"], "Unlicense": ["Unlicense"],
    "BSL-1.0": ["Boost Software License", "Boost Software License, Version 1.0"], "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public License"],
    "Python-2.0": ["Python Software Foundation License", "PSF License"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero License"],
}
for _name, _full, _short, _versions in (
        ("GPL", "GNU General Public License", "GPL", "1 2 3"), ("LGPL", "GNU Lesser General Public License", "LGPL", "2.1 3"),
        ("LGPL", "GNU Library General Public License", "LGPL", "2"), ("AGPL", "GNU Affero General Public License", "AGPL", "1 3"),
        ("GFDL", "GNU Free Documentation License", "GFDL", "1.1 1.2 1.3"), ("Apache", "Apache License", "Apache", "1.0 1.1 2.0"),
        ("MPL", "Mozilla Public License", "MPL", "1.0 1.1 2.0"), ("EPL", "Eclipse Public License", "EPL", "1.0 2.0"),
        ("EUPL", "European Union Public License", "EUPL", "1.1 1.2"), ("Artistic", "Artistic License", "Artistic", "1.0 2.0")):
    _NAMES.setdefault(_name, []).append(_full)
    for _v in _versions.split():
        _id = f"{_name}-{_v if '.' in _v else _v + '.0'}"
        _spelt = [f"{_short}-{_v}", f"{_short} {_v}", f"{_short} v{_v}", f"{_short} version {_v}", f"{_short}v{_v}", f"GNU {_short}v{_v}", f"GNU {_short} v{_v}",
                  f"GNU {_short} version {_v}"]
        _spelt += [] if "." in _v else [f"{_short}-{_v}.0", f"{_short}-{_v}.0-or-later", f"{_short}-{_v}.0-only", f"{_short}v{_v}+"]
        _NAMES.setdefault(_id, []).extend(
            [f"{_full}, version {_v}", f"{_full} {_v}", f"{_full} v{_v}", f"{_full}, v. {_v}", f"{_full} {_v} or later", f"version {_v} of the {_full}",
             *(x for x in _spelt if not (x.startswith("GNU") and "GNU" not in _full)), f"{_short}-{_v} License", f"{_short} {_v} License"])
        if "GNU" in _full and _name != "GFDL":
            _what = "library" if _name == "LGPL" else "program"
            for _until in (f"either version {_v} of the License, or (at your option) any later version", f"version {_v} of the License"):
                _TEXTS.setdefault(_id, []).append(_GNU.format(_what, _full[4:-8], _until))
                _TEXTS[_id].append(_GNU.format(_what, _full[4:-8], _until).split(". This")[0])
_NAMED = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
for _parts in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _long = [_NAMED[x] for x in _parts.split("-")]
        _longs = {y for x in ("-".join(_long), " ".join(_long)) for y in (x, x.replace("NonC", "Non-C").replace("ShareA", "Share-A"),
                                                                         x.replace("NonC", "Non-C").replace("ShareA", "Share A"),
                                                                         x.replace("NoDerivatives", "NoDerivs"))}
        _NAMES[f"CC-{_parts}-{_v}".upper()] = sorted(
            {f"CC {_parts} {_v}", f"CC-{_parts}-{_v}", f"CC-{_parts} {_v}", f"CC {_parts.replace('-', ' ')} {_v}", f"CC {_parts}-{_v}"}) + sorted(
            {f"Creative Commons {x} {v} License" for x in _longs for v in (_v, f"{_v} International", f"{_v} Unported")} | {
                f"Creative Commons {x} {_v}" for x in _longs})
for _name, _texts in _TEXTS.items():
    TEMPLATES.setdefault(_name, []).extend(x for x in _texts if x not in TEMPLATES[_name])
for _name, _names in _NAMES.items():
    TEMPLATES.setdefault(_name, []).extend(
        y for x in _names for y in ([f"{f} the {x}." for f in ("Released under", "Licensed under", "Distributed under", "This work is licensed under")]
                                    + [f"{f} {x}." for f in ("Released under", "Licensed under")]) if y not in TEMPLATES[_name])
SENTENCE = 20  # words; in templates of so many, all words that are not in FILLER tell licences apart
FILLER = frozenset("""released licensed distributed available under the a an this work program project software code file is are of in to and or
for with it terms license licence version v international unported university open source into free any later""".split())
TELLING = frozenset("""mit bsd isc apache gnu general public lesser library affero mozilla mpl eclipse boost zlib creative commons cc attribution
sublicense neither endorse promote advertising acknowledgement fee misrepresented unencumbered transmit third-parties contributors provided
permission subject disclaimers appear""".split())
#: Words that, between the words of a notice, make it another licence's.
OTHER = frozenset("""lesser library affero noncommercial non-commercial sharealike share-alike noderivatives noderivs no-derivatives no-derivs
nc sa nd by-nc by-sa by-nd by-nc-sa by-nc-nd""".split())
MIN_COVERAGE = 0.8
SLACK = 1.25  # a stretch's length in templates
WORD = re.compile(r"\w+(?:[.\-]\w+)*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (sorted by their first part) that increases in both."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        back.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(b)
            ends.append(i)
        else:
            tails[k], ends[k] = b, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment of two word lists: matched positions, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        seen_a: dict[str, int] = {}
        for i in range(alo, ahi):
            seen_a[a[i]] = -1 if a[i] in seen_a else i
        seen_b: dict[str, int] = {}
        for j in range(blo, bhi):
            seen_b[b[j]] = -1 if b[j] in seen_b else j
        both = [(i, seen_b[w]) for w, i in seen_a.items() if i >= 0 and seen_b.get(w, -1) >= 0]
        anchors = _increasing(sorted(both))
        out += anchors
        if anchors:
            at, bt = alo, blo
            for i, j in [*anchors, (ahi, bhi)]:
                todo.append((at, i, bt, j))
                at, bt = i + 1, j + 1
    return sorted(out)


def telling(template: list[str]) -> frozenset[str]:
    """The words of a template that tell its licence from others."""
    if len(template) <= SENTENCE:
        return frozenset(w for w in template if w not in FILLER)
    return frozenset(w for w in template if w in TELLING or any(c.isdigit() for c in w))


class Scanner:
    """Templates prepared for scanning."""

    def __init__(self, templates=None, min_coverage: float = MIN_COVERAGE):
        self.min_coverage = min_coverage
        self.templates = [(name, list(ws)) for name, ws in dict.fromkeys(
            (name, tuple(words(t))) for name, texts in (templates or TEMPLATES).items() for t in texts)]
        self.telling = [telling(ws) for _, ws in self.templates]
        self.always = 0  # templates to scan for in every text; others by their longest telling word
        self.keyed: dict[str, list[int]] = {}
        for k, told in enumerate(self.telling):
            if told:
                self.keyed.setdefault(max(told, key=lambda w: (len(w), w)), []).append(k)
            else:
                self.always |= 1 << k
        self.counts = [Counter(ws) for _, ws in self.templates]
        self.vocabulary: dict[str, int] = {}
        for i, (_, ws) in enumerate(self.templates):
            for w in ws:
                self.vocabulary[w] = self.vocabulary.get(w, 0) | (1 << i)

    def stretches(self, k: int, ws: list[str], hits: list[int], size: int, need: int):
        """(first, after last) hit numbers of disjoint stretches of at most ``size`` words that
        share ``need`` words or more with template ``k`` (repeated words as often as both have
        them, which no alignment can exceed): the fullest first, then the shortest, then the
        earliest."""
        most, held, share, found, j = self.counts[k], {}, 0, [], 0
        for i in range(len(hits)):
            while j < len(hits) and hits[j] < hits[i] + size:
                w = ws[hits[j]]
                held[w] = held.get(w, 0) + 1
                share += held[w] <= most[w]
                j += 1
            if share >= need:
                seen, end = Counter(), i
                for x in range(i, j):  # leave out what follows the last word that counts
                    seen[ws[hits[x]]] += 1
                    if seen[ws[hits[x]]] <= most[ws[hits[x]]]:
                        end = x + 1
                found.append((-share, hits[end - 1] - hits[i], i, end))
            w = ws[hits[i]]
            share -= held[w] <= most[w]
            held[w] -= 1
        taken: list[tuple[int, int]] = []
        for _, _, i, j in sorted(found):
            if all(j <= x or i >= y for x, y in taken):
                taken.append((i, j))
        return taken

    def is_named(self, k: int, ws: list[str], lo: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether the words that tell template ``k`` from other licences are aligned, and no word
        of another licence stands between the aligned ones."""
        template = self.templates[k][1]
        if not self.telling[k] <= {template[j] for _, j in pairs}:
            return False
        if not self.telling[k]:
            return True
        held, short = {i for i, _ in pairs}, len(template) <= SENTENCE
        between = (ws[lo + i] for i in range(pairs[0][0], pairs[-1][0]) if i not in held)
        return not any(w in OTHER or (short and any(c.isdigit() for c in w)) for w in between)

    def scan(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(licence, first word, after last word, aligned words, coverage) of each notice."""
        ws = words(text)
        present, live = set(ws), self.always
        for w in self.keyed.keys() & present:
            for k in self.keyed[w]:
                if self.telling[k] <= present:
                    live |= 1 << k
        if not live:
            return []
        by: dict[int, list[int]] = {}
        masks = [(i, m & live) for i, m in enumerate(map(self.vocabulary.get, ws)) if m]
        for i, m in masks:
            while m:
                low = m & -m
                by.setdefault(low.bit_length() - 1, []).append(i)
                m ^= low
        found = []
        for k in sorted(by):
            name, template = self.templates[k]
            need = -(-len(template) * self.min_coverage // 1)
            if len(by[k]) < need:
                continue
            for i, j in self.stretches(k, ws, by[k], int(len(template) * SLACK) + 1, int(need)):
                lo, hi = by[k][i], by[k][j - 1] + 1
                pairs = align(ws[lo:hi], template)
                if len(pairs) >= self.min_coverage * len(template) and self.is_named(k, ws, lo, pairs):
                    found.append((len(pairs), k, name, lo + pairs[0][0], lo + pairs[-1][0] + 1, len(pairs) / len(template)))
        out: list[tuple[str, int, int, int, float]] = []
        for n, _, name, lo, hi, share in sorted(found, key=lambda x: (len(self.templates[x[1]][1]) - 2 * x[0], x[1], x[3])):
            if all(hi <= o[1] or lo >= o[2] for o in out):
                out.append((name, lo, hi, n, share))
        return sorted(out, key=lambda o: o[1])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """A row per notice: id, ``license, first_word, last_word, aligned, coverage``."""
    scanner = Scanner(templates, min_coverage)

    def run(batches):
        for batch in batches:
            out = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)) for hit in scanner.scan(text.as_py())]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                 pa.array([x - 1 for x in cols[3]], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.float64())],
                names=["id", "license", "first_word", "last_word", "aligned", "coverage"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, license string, first_word long, last_word long, aligned long, coverage double").withColumnRenamed(
        "id", id_col)

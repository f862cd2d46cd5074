"""License scans: normalised text against license templates by the Dice coefficient over word bigrams.

Only built-in functions; each row is judged by itself, so nothing is shuffled and no template is joined.

Texts are lower-cased (A-Z), cut at line ends and behind sentence ends, and read as words of a-z and 0-9.
Segments that begin with "copyright" name holders and are left out, as are segments without a word pair. A
segment belongs to a template if at least half of its bigrams are the template's; neighbouring segments that
do make a passage. A passage whose number of distinct bigrams cannot reach the threshold with the template's
(a / b outside [t / (2 - t), (2 - t) / t]) is not compared; the others match if

    2 * |common bigrams| / (|bigrams of the passage| + |bigrams of the template|) >= THRESHOLD.

So a license stands out of a longer text, with paragraphs, holders and small changes, and two licenses in a
row are told apart. Of matches that overlap, the one with the higher coefficient stays, then the larger
template, then the first name.

Defined results: null and empty texts have no segments and no matches; rows are judged one by one, whatever
their doc_id.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Texts of licenses and of the notices that stand for them.
TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "All-rights-reserved": "All rights reserved.",
}
#: The license of three clauses is that of two with one more before the disclaimer.
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace(
    " THIS SOFTWARE IS PROVIDED",
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED",
)
NAMES = {
    "MIT": ["the MIT License"],
    "ISC": ["the ISC License"],
    "BSD-2-Clause": ["the BSD 2-Clause License"],
    "BSD-3-Clause": ["the BSD 3-Clause License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC0-1.0": ["CC0 1.0"],
}
NOTICES = ("Licensed under {}.", "Released under {}.", "Distributed under the terms of {}.", "This work is licensed under {}.", "This project is licensed under {}.")


def _segments(text: str) -> list[list[str]]:
    """Word lists of a template's segments, as `scan` makes them of a column."""
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text)
    found = [re.findall(r"[a-z0-9]+", s) for s in re.sub(r"([.;:!?])[ \t]+", r"\1\n", lower).split("\n")]
    return [w for w in found if len(w) > 1 and w[0] != "copyright"]


def templates() -> list[tuple[str, list[str]]]:
    """(name, distinct bigrams), pairs of words in one segment, of every text and of each notice with each name."""
    texts = list(TEXTS.items()) + [(name, notice.format(form)) for name, forms in NAMES.items() for form in forms for notice in NOTICES]
    return [(name, sorted({f"{a} {b}" for w in _segments(text) for a, b in zip(w, w[1:], strict=False)})) for name, text in texts]


def _bigrams(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_segments, matches) for each row of docs (doc_id, text).

    `matches` is an array of (first, last, name, dice, n_bigrams): numbers of the first and the last segment
    among those with a word pair, from 0; the license; the coefficient; the bigrams of the template.
    """
    known = templates()
    every = sorted({b for _, bigrams in known for b in bigrams})
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.translate(F.coalesce(docs["text"], F.lit("")), letters, letters.lower())
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.split(F.regexp_replace(text, r"([.;:!?])[ \t]+", "$1\n"), "\n").alias("parts"))
    words = F.filter(
        F.transform("parts", lambda s: F.filter(F.split(s, "[^a-z0-9]+"), lambda w: w != "")),
        lambda w: (F.size(w) > 1) & (F.get(w, F.lit(0)) != "copyright"),
    )
    rows = rows.select("doc_id", F.transform(words, _bigrams).alias("segments"))
    hits = lambda b: F.size(F.filter(b, lambda x: x.isin(every)))
    rows = rows.select(
        "doc_id",
        F.size("segments").cast("bigint").alias("n_segments"),
        F.filter(
            F.transform("segments", lambda b, i: F.when(hits(b) * 2 >= F.size(b), F.struct(i.alias("at"), b.alias("bigrams")))),
            lambda s: s.isNotNull(),
        ).alias("likely"),
    )
    found = F.flatten(F.array(*[_passages(F.col("likely"), name, bigrams, threshold) for name, bigrams in known]))
    kind = "array<struct<first: int, last: int, name: string, dice: double, n_bigrams: int>>"
    # One pair alone cannot match anything: the smallest template has two.
    some = (F.size("likely") > 1) | F.exists("likely", lambda s: F.size(s.bigrams) > 1)
    rows = rows.select("doc_id", "n_segments", F.when(some, found).otherwise(F.array().cast(kind)).alias("found"))
    return rows.select("doc_id", "n_segments", F.array_sort(_best(F.col("found"))).alias("matches"))


def _passages(likely: Column, name: str, bigrams: list[str], threshold: float) -> Column:
    """Matches of one template among the likely segments."""
    size = len(bigrams)
    own = F.filter(likely, lambda s: F.size(F.filter(s.bigrams, lambda x: x.isin(bigrams))) * 2 >= F.size(s.bigrams))
    # (passages so far, the last one open): a segment joins the last passage if it is its neighbour.
    empty = F.array().cast("array<struct<first: int, last: int, bigrams: array<string>>>")

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["first"].alias("first"), s["at"].alias("last"), F.concat(last["bigrams"], s["bigrams"]).alias("bigrams"))
        new = F.struct(s["at"].alias("first"), s["at"].alias("last"), s["bigrams"].alias("bigrams"))
        joins = (F.size(done) > 0) & (s["at"] == F.get(done, F.size(done) - 1)["last"] + 1)
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(new)))

    sets = F.transform(F.aggregate(own, empty, step), lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), F.array_distinct(p["bigrams"]).alias("b")))
    bounded = F.filter(sets, lambda p: F.size(p["b"]).between(threshold / (2 - threshold) * size, (2 - threshold) / threshold * size))
    scored = F.transform(
        bounded,
        lambda p: F.struct(
            p["first"].alias("first"), p["last"].alias("last"), F.lit(name).alias("name"),
            (F.size(F.filter(p["b"], lambda x: x.isin(bigrams))) * 2.0 / (F.size(p["b"]) + size)).alias("dice"), F.lit(size).alias("n_bigrams"),
        ),
    )
    return F.filter(scored, lambda m: m["dice"] >= threshold)


def _best(found: Column) -> Column:
    """Matches that no overlapping match is better than."""
    rank = lambda m: F.struct(-m["dice"], -m["n_bigrams"], m["name"])
    beaten = lambda m: F.exists(found, lambda o: (o["first"] <= m["last"]) & (m["first"] <= o["last"]) & (rank(o) < rank(m)))
    return F.array_distinct(F.filter(found, lambda m: ~beaten(m)))

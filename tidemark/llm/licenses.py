"""Licence scan by the Dice coefficient over word bigrams, in DataFrame expressions only.

Licence notices are compared with windows of a text's word sequence, so a notice
is found wherever its lines are broken and whatever stands around it. The best
window begins at a pair of words that the notice has, after one that it has
not, and ends at one that it has, so only such places are tried. A notice of b
bigrams can only reach a Dice coefficient of t with a set of b*t/(2-t) to
b*(2-t)/t bigrams: a window ends when it holds more different ones, however
many pairs that takes. Texts that hold none of a notice's anchors, long words
or bigrams, share too few of its bigrams and are not cut up at all.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short notices by SPDX name, which the SQL compares too.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                "the License, or any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0."),
    ("All-Rights-Reserved", "All rights reserved."),
]
_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
          "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
          "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
          "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
          "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
          "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
          "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
          "POSSIBILITY OF SUCH DAMAGE.")  # fmt: skip
_BSD_2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
          "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
          "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
          "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
          "other materials provided with the distribution. ")  # fmt: skip
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
          "promote products derived from this software without specific prior written permission. ")  # fmt: skip
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
              "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
              "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
              "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
              "subject to the following conditions: ")  # fmt: skip
_MIT_REST = ("The above copyright notice and this permission notice shall be included in all copies or substantial "
             "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
             "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
             "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
             "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
             "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")  # fmt: skip


def _gnu(name: str, version: str, what: str) -> str:
    """The notice that the GNU licences ask to be put at the start of a file."""
    return (
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as "
        f"published by the Free Software Foundation; either version {version} of the License, or (at your option) "
        f"any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"{name} for more details. You should have received a copy of the {name} along with this {what}"
    )


_GNU = [
    ("GPL-2.0", "GNU General Public License", "2", "program", "Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "program", "Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "library", "Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "library", "Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "program", "Version 3, 19 November 2007"),
]
_CC = [
    (f"CC-{code}-{version}", f"{code} {version}", f"{name} {version} {place}")
    for code, name in (
        ("BY", "Attribution"),
        ("BY-SA", "Attribution-ShareAlike"),
        ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    )
    for version, place in (("4.0", "International"), ("3.0", "Unported"))
]
# Whole texts of short licences; of long ones the title and the standard header, which stands in their text too.
STANDARD: list[tuple[str, str]] = [
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_GRANT + _MIT_REST),
    ("BSD-2-Clause", _BSD_2 + _AS_IS),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
            "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
            "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute "
             "it freely, subject to the following restrictions: 1. The origin of this software must not be "
             "misrepresented; you must not claim that you wrote the original software. If you use this software in a "
             "product, an acknowledgment in the product documentation would be appreciated but is not required. "
             "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
             "original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    *((label, _gnu(name, version, what)) for label, name, version, what, _ in _GNU),
    *((label, f"{name} {title}") for label, name, _, _, title in _GNU),
    *((label, f"Licensed under the {name}, version {version}.") for label, name, version, _, _ in _GNU),
    *((label, f"Licensed under the {name} v{version}.") for label, name, version, _, _ in _GNU),
    *((label, f"Licensed under CC {short}.") for label, short, _ in _CC),
    *((label, f"Licensed under a Creative Commons {name} License.") for label, _, name in _CC),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
]
THRESHOLD = 0.8
_LONG_WORD = 7
# How often the length that is looked through for further pairs is made four times as long.
_STEPS = 8
_NOTICE = "license: string, bigrams: array<string>, n: int, needed: int, most: int"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9\x80-\U0010FFFF]+", text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def template_bigrams(text: str) -> list[str]:
    words = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The sizes that a set can have to reach ``threshold`` with a set of ``size``."""
    return ceil(size * threshold / (2 - threshold) - 1e-9), floor(size * (2 - threshold) / threshold + 1e-9)


def anchors(bigrams: list[str], threshold: float, known: Sequence[str] = ()) -> list[str]:
    """Long words and bigrams of which any piece similar enough holds at least one.

    What is not covered by them, or by those ``known``, is less than such a
    piece must share.
    """
    needed = size_bounds(len(bigrams), threshold)[0]
    left, chosen = {b for b in bigrams if not any(w in (b, *b.split()) for w in known)}, []
    while len(left) >= needed:
        words = {w for b in left for w in b.split() if len(w) >= _LONG_WORD}
        chosen.append(max(words or left, key=lambda w: (sum(w in b.split() for b in left), len(w), w)))
        left = {b for b in left if chosen[-1] not in (b, *b.split())}
    return chosen


def _split(text: Column) -> Column:
    """The words of a text, lower-cased and without punctuation."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN), lambda w: w != "")


def _pairs(items: Column, join: Callable[[Column, Column], Column]) -> Column:
    rest = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, 1, rest), F.slice(items, 2, rest), join)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value made once."""
    return F.transform(F.array(value), then)[0]


def _placed(text: Column) -> Column:
    """Every word bigram of a text in order, and the lines of its two words."""
    lines = F.transform(
        F.split(text, "\n"), lambda line, i: F.transform(_split(line), lambda w: F.struct(w.alias("w"), i.alias("i")))
    )

    def joined(a: Column, b: Column) -> Column:
        return F.struct(F.concat_ws(" ", a["w"], b["w"]).alias("pair"), a["i"].alias("first"), b["i"].alias("last"))

    return _let(F.flatten(lines), lambda w: _pairs(w, joined))


def _repeats(placed: Column) -> Column:
    """Per place (from 0) where its pair stood before (-1: nowhere) and stands next (the number of places)."""
    ordered = F.sort_array(F.transform(placed, lambda x, i: F.struct(x["pair"].alias("pair"), i.alias("at"))))

    def linked(all_: Column) -> Column:
        def link(x: Column, i: Column) -> Column:
            before, after = F.get(all_, i - 1), F.get(all_, i + 1)
            return F.struct(
                x["at"].alias("at"),
                F.when(before["pair"] == x["pair"], before["at"]).otherwise(-1).alias("before"),
                F.when(after["pair"] == x["pair"], after["at"]).otherwise(F.size(all_)).alias("after"),
            )

        return F.sort_array(F.transform(all_, link))

    return _let(ordered, linked)


def _windows(notice: Column, placed: Column, hits: Column, before: Column, after: Column) -> Column:
    """The best windows from each start for a notice: of any end, and of ends in the start's line.

    A set of pairs is judged by its shortest window, in which the first pair
    does not come again, so the windows of all starts with one pair together
    are no longer than the text. A pair is new in a window if it stood before
    its start only. A start after one more of the notice's pairs is not tried,
    unless that pair stands in the window already or in an earlier line.
    """
    most, needed = notice["most"], notice["needed"]

    def distinct(start: Column, length: Column) -> Column:
        return F.size(F.filter(F.slice(before, start + 1, length), lambda b: b < start))

    def reach(start: Column) -> Column:
        """Length of the windows to try: until the pair comes again, or too many others have come."""
        limit = F.get(after, start) - start
        length = limit
        for step in reversed(range(_STEPS)):
            longest = most * (2 * 4**step)
            length = F.when(limit <= longest, limit).when(distinct(start, longest) > most, longest).otherwise(length)
        return length

    def enough(at: Column, j: Column) -> Column:
        """As many of the notice's pairs as a window needs may follow before too many others do."""
        start, last = F.get(at, j), F.get(at, j + needed - 1)
        length = last - start + 1
        return (F.get(after, start) > last) & (
            (length <= most) | (distinct(start, F.least(length, 4 * most)) <= most)
        )

    def begins(at: Column, x: Column) -> Column:
        start = x["start"]
        return (
            (start == 0)
            | (F.coalesce(F.get(at, x["j"] - 1), F.lit(-1)) != start - 1)
            | (F.get(placed, start - 1)["first"] != F.get(placed, start)["first"])
            | (F.get(after, start - 1) < start + x["reach"])
        )

    def best(at: Column, x: Column) -> Column:
        start, line = x["start"], F.get(placed, x["start"])["first"]
        ends = F.filter(F.slice(at, x["j"] + 1, x["reach"]), lambda p: p < start + x["reach"])

        def seen(ends: Column) -> Column:
            def one(p: Column, i: Column) -> Column:
                from_ = F.when(i == 0, start).otherwise(F.get(ends, i - 1) + 1)
                new = F.filter(F.slice(before, from_ + 1, p - from_ + 1), lambda b: b < start)
                return F.struct(
                    p.alias("at"),
                    F.size(new).alias("more"),
                    (F.get(before, p) < start).cast("int").alias("held"),
                    (F.get(placed, p)["last"] == line).alias("inside"),
                )

            return F.transform(ends, one)

        def step(done: Column, next_: Column) -> Column:
            size, shared = done["size"] + next_["more"], done["shared"] + next_["held"]
            dice = 2.0 * shared / (size + notice["n"])
            better, inside = dice > done["dice"], next_["inside"] & (dice > done["line_dice"])
            return F.struct(
                size.alias("size"),
                shared.alias("shared"),
                F.when(better, dice).otherwise(done["dice"]).alias("dice"),
                F.when(better, next_["at"]).otherwise(done["end"]).alias("end"),
                F.when(inside, dice).otherwise(done["line_dice"]).alias("line_dice"),
                F.when(inside, next_["at"]).otherwise(done["line_end"]).alias("line_end"),
            )

        def match(dice: Column, end: Column, line: Column) -> Column:
            return F.struct(
                start.alias("start"),
                end.alias("end"),
                notice["license"].alias("license"),
                dice.alias("dice"),
                line.cast("int").alias("line"),
            )

        zero, none = F.lit(0), F.lit(0.0)
        first = F.struct(
            zero.alias("size"),
            zero.alias("shared"),
            none.alias("dice"),
            zero.alias("end"),
            none.alias("line_dice"),
            zero.alias("line_end"),
        )
        return _let(
            F.aggregate(_let(ends, seen), first, step),
            lambda b: F.array(
                match(b["dice"], b["end"], F.lit(None)), match(b["line_dice"], b["line_end"], line)
            ),
        )

    def tried(at: Column) -> Column:
        likely = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda j: enough(at, j))
        starts = F.transform(
            likely,
            lambda j: F.struct(j.alias("j"), F.get(at, j).alias("start"), reach(F.get(at, j)).alias("reach")),
        )
        return F.flatten(F.transform(F.filter(starts, lambda x: begins(at, x)), lambda x: best(at, x)))

    own = F.filter(hits, lambda h: F.array_contains(notice["bigrams"], h["pair"]))
    return _let(F.transform(own, lambda h: h["at"]), tried)


def _unbeaten(found: Column) -> Column:
    """Matches, sorted by start, without those of which another licence matches half of the words better.

    They are cut into stretches of starts as long as the longest match, so that
    only the stretches beside its own can hold what beats a match.
    """

    def beaten(x: Column, near: Column) -> Column:
        return F.exists(
            near,
            lambda y: (y["license"] != x["license"])
            & (y["dice"] > x["dice"])
            & (2 * (F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]) + 1) >= x["end"] - x["start"] + 1),
        )

    def stretch(i: Column, longest: Column) -> Column:
        return F.floor(F.get(found, i)["start"] / longest)

    def cut(longest: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(found) - 1),
            lambda i: (i == 0) | (stretch(i, longest) != stretch(i - 1, longest)),
        )
        return _let(
            first,
            lambda first: F.transform(
                first, lambda i, k: F.slice(found, i + 1, F.coalesce(F.get(first, k + 1), F.size(found)) - i)
            ),
        )

    def kept(parts: Column) -> Column:
        def of(part: Column, k: Column) -> Column:
            none = F.slice(part, 1, 0)
            near = F.concat(F.coalesce(F.get(parts, k - 1), none), part, F.coalesce(F.get(parts, k + 1), none))
            return _let(near, lambda near: F.filter(part, lambda x: ~beaten(x, near)))

        return F.flatten(F.transform(parts, of))

    longest = F.array_max(F.transform(found, lambda x: x["end"] - x["start"] + 1))
    return F.when(F.size(found) > 0, _let(_let(longest, cut), kept))


def _matches(text: Column, notices: Column, every: list[str], threshold: float) -> Column:
    """All windows of a text that match a notice, without those that another licence matches better."""

    def found(placed: Column, hits: Column, met: Column) -> Column:
        def within(near: Column) -> Column:
            return _let(
                F.transform(near, lambda x: x["before"]),
                lambda before: _let(
                    F.transform(near, lambda x: x["after"]),
                    lambda after: F.flatten(
                        F.transform(met, lambda notice: _windows(notice, placed, hits, before, after))
                    ),
                ),
            )

        return F.filter(_let(_repeats(placed), within), lambda x: x["dice"] >= threshold)

    def of_hits(placed: Column, hits: Column) -> Column:
        shared = F.array_distinct(F.transform(hits, lambda h: h["pair"]))
        met = _let(
            shared,
            lambda s: F.filter(notices, lambda n: F.size(F.array_intersect(s, n["bigrams"])) >= n["needed"]),
        )
        all_ = _let(met, lambda met: F.when(F.size(met) > 0, found(placed, hits, met)))
        return _let(F.sort_array(all_), _unbeaten)

    def of_placed(placed: Column) -> Column:
        marked = F.transform(placed, lambda x, i: F.struct(i.alias("at"), x["pair"].alias("pair")))
        return _let(F.filter(marked, lambda h: h["pair"].isin(every)), lambda hits: of_hits(placed, hits))

    return _let(_placed(text), of_placed)


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES + STANDARD, threshold: float = THRESHOLD
) -> DataFrame:
    """A row per document and licence found in it: doc_id, license, dice, n_lines, first_line.

    ``dice`` is the best coefficient of any window of the text, however long,
    ``n_lines`` the number of lines with a match and ``first_line`` the first of
    them (from 0, null if only several lines together match). Of licences that
    match the same words only the one that matches best counts, all of them if
    equally well. Null and empty texts hold no licence; rows that share a doc_id
    count together; other columns are not read; an empty table gives no row, as
    do no templates.
    """
    notices = [(name, template_bigrams(text)) for name, text in templates]
    notices = [(name, found) for name, found in notices if found]
    every = sorted({b for _, found in notices for b in found})
    words: list[str] = []
    for _, found in sorted(notices, key=lambda notice: len(notice[1])):
        words += anchors(found, threshold, words)
    words = [w for w in words if not any(other != w and other in w for other in words)]
    bounds = [(name, found, *size_bounds(len(found), threshold)) for name, found in notices]
    rows = [
        {"license": name, "bigrams": found, "n": len(found), "needed": needed, "most": most}
        for name, found, needed, most in bounds
    ]
    # One constant, which Spark reads once while it plans.
    constant = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{_NOTICE}>>")
    spaced = F.regexp_replace(F.lower("text"), _BETWEEN, " ")

    def held(plain: Column) -> Column:
        return reduce(lambda a, b: a | b, (F.contains(plain, F.lit(w)) for w in words), F.lit(False))

    # One lambda argument holds the plain text, so that it is made once.
    texts = docs.select("doc_id", "text").where(F.exists(F.array(spaced), held))
    found = texts.select("doc_id", F.explode(_matches(F.col("text"), constant, every, threshold)).alias("x"))
    return found.groupBy("doc_id", F.col("x.license").alias("license")).agg(
        F.max("x.dice").alias("dice"),
        F.countDistinct("x.line").alias("n_lines"),
        F.min("x.line").cast("long").alias("first_line"),
    )

"""Licence scans: sparse TF-IDF cosine of notices, headers and licence files to templates, inherited along directories.

Lines are lists of tokens; lines without one, such as empty comment lines, do not count. Units of a file:

- notices: one to NOTICE_LINES adjacent lines anywhere, against one-line templates;
- headers: windows of adjacent lines that start among the first HEADER_STARTS, against whole licence texts and standard headers;
- a file named as a licence file: also its whole text, against the same.

The terms are those of the templates; their document
frequencies are counted over all lines. A unit's other tokens share one weight, that of a term that
occurs nowhere, so that prose around a notice lowers its cosine.

Exact filters come first. A cosine of at least ``least`` needs one of a template's heavier terms: the lighter ones, taken
together, stay below it for any unit. And it needs terms that hold ``least`` squared of the template's squared weight, hence
so many different terms at least; the terms of ordinary prose are many, but hold less.
Units that fail cannot reach the threshold and are not scored. The others are scored in their rows; of the tokens only the
templates' terms are stored, each once a line.

A file without a notice of its own takes the licence of the nearest directory above it that has a
licence file. Everything is Column expressions and joins.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.runtime import materialize

from .components import small
from .url_filter import LOWER, UPPER

# Licence names and their usual notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER "
    "OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation, either version {} of the License, or (at your option) any later version. This program is distributed "
    "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public "
    "License along with this program. If not, see "
)
# Licence texts and standard headers, without names and years.
TEXTS = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
            "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. " + _WARRANTY),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + _BSD_THIRD + _BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR "
            "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
            "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
            "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
            "THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   "to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                   "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the "
                   "License."),
    ("GPL-2.0", _GNU.format(2)),
    ("GPL-3.0", _GNU.format(3)),
]
#: Adjacent lines of a notice at most; lines in header windows, and the lines that they may start at.
NOTICE_LINES, HEADER_LINES, HEADER_STARTS = 3, (5, 8, 12, 16, 22, 32), 6
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
TOKEN = "[a-z0-9]+"


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TOKEN), F.lit(0))


def template_terms(templates: list[tuple[str, str]]) -> list[tuple[str, Counter]]:
    return [(name, Counter(re.findall(TOKEN, text.lower()))) for name, text in templates]


def weights(vocabulary: list[str], lines: int, held: dict[str, int]) -> tuple[dict[str, float], float]:
    """idf of each term, and the weight of all other tokens."""
    return {t: math.log((1 + lines) / (1 + held.get(t, 0))) + 1 for t in vocabulary}, math.log(1 + lines) + 1


def _shares(counts: Counter, idf: dict[str, float]) -> list[tuple[float, str]]:
    """(share of the template's squared weight, term), the lightest first."""
    weight = {t: (n * idf[t]) ** 2 for t, n in counts.items()}
    norm = sum(weight.values())
    return sorted((w / norm, t) for t, w in weight.items())


def needed(terms: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> list[str]:
    """Terms of which a unit must have one to reach ``least`` for any template."""
    out: set[str] = set()
    for _, counts in terms:
        spare = 0.0
        for share, t in _shares(counts, idf):
            spare += share
            if spare >= least * least * (1 - 1e-9):
                out.add(t)
    return sorted(out)


def fewest(counts: Counter, idf: dict[str, float], least: float) -> int:
    """Different terms of a template that a unit must have to reach ``least``."""
    held, n = 0.0, 0
    for share, _ in reversed(_shares(counts, idf)):
        if held >= least * least * (1 - 1e-9):
            break
        held, n = held + share, n + 1
    return n


def _directories(path: Column) -> Column:
    """All directories above a path, the nearest first; the last is ``''``."""
    parts = F.split(path, "/")
    n = F.size(parts) - 1
    return F.when(n == 0, F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(n, F.lit(0), F.lit(-1)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    )


def _words(lines: list[str]) -> Column:
    return F.array(*(F.lit(t) for t in lines))


def _window(start: Column, n) -> Column:
    """The tokens of ``n`` lines from line ``start`` on, counted from 0."""
    return F.flatten(F.slice("lines", start + 1, n))


def share_needed(least: float) -> float:
    """The share of a template's squared weight that a unit's terms must hold to reach ``least``, rounded to six decimals."""
    return (least - 1e-6) ** 2


def _enough(tokens: Column, terms: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> Column:
    """Whether the tokens have enough terms of some template, and these enough of its squared weight."""

    def test(own: Column, counts: Counter) -> Column:
        shares = F.expr(f"map({', '.join(f"'{t}', {share!r}D" for share, t in _shares(counts, idf))})")
        found = F.array_intersect(own, _words(sorted(counts)))
        share = F.aggregate(found, F.lit(0.0), lambda x, t: x + F.element_at(shares, t))
        return (F.size(found) >= fewest(counts, idf, least)) & (share >= share_needed(least))

    # the array of one makes the tokens be found once, not for each test
    known = F.array_intersect(tokens, _words(sorted({t for _, c in terms for t in c})))
    return F.exists(F.array(known), lambda own: functools.reduce(lambda x, y: x | y, [test(own, c) for _, c in terms]))


def _may_notice(terms: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> Column:
    """Whether NOTICE_LINES adjacent lines, by their terms ``known``, can hold a notice."""
    some = needed(terms, idf, least)

    def at(i: Column) -> Column:
        near = F.array(F.flatten(F.slice("known", i, NOTICE_LINES)))
        return F.exists(near, lambda own: F.arrays_overlap(own, _words(some)) & _enough(own, terms, idf, least))

    return (F.size("known") > 0) & F.exists(F.sequence(F.lit(1), F.size("known")), at)


def _is_licence(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1).rlike(LICENCE_FILE)


def _may_hold_text(terms: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> Column:
    """Whether the first lines of a file, or all of a licence file, by their terms ``known``, can hold a licence text."""
    first = F.slice("known", 1, HEADER_STARTS - 1 + max(HEADER_LINES))
    return _enough(F.flatten(F.when(F.coalesce(_is_licence("path"), F.lit(False)), F.col("known")).otherwise(first)), terms, idf, least)


def _notices(files: DataFrame, terms: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> DataFrame:
    """(path, tokens) of all windows of one to NOTICE_LINES lines with a needed term and enough terms of some template."""
    some = needed(terms, idf, least)
    marked = files.select("path", "lines", F.transform("lines", lambda t: F.arrays_overlap(t, _words(some))).alias("has"))
    at = F.filter(F.transform("has", lambda h, i: F.when(h, i)), lambda i: i.isNotNull())
    hits = marked.select("path", "lines", "has", F.explode(at).alias("at"))
    windows = F.array(*(F.struct((F.col("at") - k).alias("start"), F.lit(n).alias("n")) for n in range(1, NOTICE_LINES + 1) for k in range(n)))
    held = hits.select("path", "lines", "has", "at", F.inline(windows)).where("start >= 0 and start + n <= size(lines)")
    # a window with several such lines is listed with the first of them
    first = ~F.exists(F.slice("has", F.col("start") + 1, F.col("at") - F.col("start")), lambda h: h)
    units = held.where(first).select("path", _window(F.col("start"), F.col("n")).alias("tokens"))
    return units.where(_enough(F.col("tokens"), terms, idf, least))


def _texts(files: DataFrame, terms: list[tuple[str, Counter]], idf: dict[str, float], least: float) -> DataFrame:
    """(path, tokens) of header windows and whole licence files with enough terms of some template."""
    whole = files.where(_is_licence("path")).select("path", F.flatten("lines").alias("tokens"))
    reach = HEADER_STARTS - 1 + max(HEADER_LINES)
    heads = files.where(_enough(F.flatten(F.slice("lines", 1, reach)), terms, idf, least))
    places = F.array(*(F.struct(F.lit(i).alias("start"), F.lit(n).alias("n")) for i in range(HEADER_STARTS) for n in HEADER_LINES))
    # a window that reaches beyond the end is the rest of the file, once for each start
    ends = [0, *HEADER_LINES]
    held = heads.select("path", "lines", F.inline(places)).where("start < size(lines)")
    shorter = F.element_at(F.array(*(F.lit(e) for e in ends)), F.array_position(F.array(*(F.lit(n) for n in HEADER_LINES)), F.col("n")).cast("int"))
    held = held.where(F.col("start") + shorter < F.size("lines"))
    windows = held.select("path", _window(F.col("start"), F.col("n")).alias("tokens"))
    return whole.unionByName(windows).where(_enough(F.col("tokens"), terms, idf, least))


def _counted(tokens: Column) -> Column:
    """Array of (token, tf) of the different tokens."""

    def runs(words: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: ~F.get(words, i - 1).eqNullSafe(F.get(words, i - 2)))

        def lengths(at: Column) -> Column:
            return F.transform(at, lambda i, k: F.struct(F.get(words, i - 1).alias("token"), (F.coalesce(F.get(at, k + 1), F.size(words) + 1) - i).alias("tf")))

        return F.get(F.transform(F.array(heads), lengths), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(tokens)), runs), F.lit(0))


def _scored(units: DataFrame, terms: list[tuple[str, Counter]], idf: dict[str, float], other: float, least: float) -> DataFrame:
    """(path, license, score) of the units that reach ``least`` for a template."""
    weight = []
    for _, counts in terms:
        norm = math.sqrt(sum((m * idf[u]) ** 2 for u, m in counts.items()))
        weight.append({t: n * idf[t] / norm for t, n in counts.items()})
    of = ", ".join(f"'{t}', named_struct('idf', {v!r}D, 'weights', array({', '.join(f'{w.get(t, 0.0)!r}D' for w in weight)}))" for t, v in sorted(idf.items()))
    counted = units.select("path", _counted(F.col("tokens")).alias("counted"))
    known = F.transform("counted", lambda r: F.struct(r.tf.alias("tf"), F.element_at(F.expr(f"map({of})"), r.token).alias("of")))
    seen = counted.select("path", known.alias("known"))
    zero = F.lit(0.0)
    norm = F.sqrt(F.aggregate("known", zero, lambda x, r: x + F.pow(r.tf * F.coalesce(r.of.idf, F.lit(other)), 2)))

    def dot(k: int) -> Column:
        return F.aggregate("own", zero, lambda x, r: x + r.tf * r.of.idf * F.get(r.of.weights, F.lit(k)))

    dots = F.array(*(F.struct(dot(k).alias("dot"), F.lit(name).alias("license")) for k, (name, _) in enumerate(terms)))
    scored = seen.select("path", norm.alias("norm"), F.filter("known", lambda r: r.of.isNotNull()).alias("own")).select("path", "norm", F.inline(dots))
    return scored.select("path", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= least)


def scan(
    files: DataFrame, least: float = 0.8, templates: list[tuple[str, str]] = TEMPLATES, texts: list[tuple[str, str]] = TEXTS,
    path_col: str = "path", text_col: str = "text",
) -> DataFrame:
    """(path, license, score, via, found_in) of every row of ``files``.

    ``via`` is ``own`` for the licence of the best unit of the file itself, with its cosine rounded
    to six decimals; ``directory`` for one taken from the licence file in the directory
    ``found_in``, the nearest above; else ``none`` with nulls. Ties go to the first name in
    alphabetical order. Rows with one path are one file. Of several licence files in a directory
    the one with the best unit counts.

    Reads only the two named columns, so extra columns cannot clash. A null or empty text has no
    notice. A null path has no directory: such rows are one file without a place. Repeated rows
    stay; an empty table gives an empty result.
    """
    rows = files.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    short, long = template_terms(templates), template_terms(texts)
    vocabulary = sorted({t for _, c in [*short, *long] for t in c})
    lines = F.filter(F.transform(F.split("text", "\n"), tokens_of), lambda t: F.size(t) > 0)
    lined = rows.select("path", lines.alias("lines"))

    # the template terms of all lines, found once: texts are cut into tokens again only where these allow a unit
    marks = materialize(lined.select("path", F.transform("lines", lambda t: F.array_intersect(t, _words(vocabulary))).alias("known")), "marks")
    # document frequencies over all lines; '' counts the lines themselves
    held = {
        r["term"]: r["n"]
        for r in marks.select(F.explode("known").alias("terms"))
        .select(F.explode(F.concat(F.array(F.lit("")), F.col("terms"))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("n")).collect()
    }
    idf, other = weights(vocabulary, held.pop("", 0), held)

    def among(could: Column) -> DataFrame:
        """The lines of the files of which some row could have a unit, told by a hash of the path: too many, never too few."""
        paths = materialize(marks.where(could).select(F.xxhash64("path").alias("hash")).distinct(), "paths")
        some = rows.join(small(paths), F.xxhash64("path") == F.col("hash"), "left_semi")
        return some.select("path", lines.alias("lines"))

    notices = _scored(_notices(among(_may_notice(short, idf, least)), short, idf, least), short, idf, other, least)
    whole = _scored(_texts(among(_may_hold_text(long, idf, least)), long, idf, least), long, idf, other, least)
    scored = (
        notices.unionByName(whole).groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
        .select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))
    )
    own = materialize(scored, "licensed")

    parent = F.element_at(_directories(F.col("path")), 1)
    places = (
        own.where(F.col("path").isNotNull() & _is_licence("path")).groupBy(parent.alias("found_in"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")).select("found_in", F.col("b.license").alias("license"))
    )
    homes = rows.where("path is not null").select(parent.alias("home")).distinct()
    above = homes.select("home", F.posexplode(_directories(F.concat("home", F.when(F.col("home") != "", F.lit("/x")).otherwise(F.lit("x"))))).alias("up", "found_in"))
    nearest = (
        above.join(places, "found_in").groupBy("home").agg(F.min(F.struct("up", "found_in", "license")).alias("b"))
        .select("home", F.col("b.license").alias("from_license"), "b.found_in")
    )
    out = rows.select("path", parent.alias("home")).join(own.select(F.col("path").alias("own_path"), "license", "score"), F.col("path").eqNullSafe(F.col("own_path")), "left")
    return out.join(nearest, "home", "left").select(
        "path",
        F.coalesce("license", "from_license").alias("license"),
        "score",
        F.when(F.col("license").isNotNull(), "own").when(F.col("from_license").isNotNull(), "directory").otherwise("none").alias("via"),
        F.when(F.col("license").isNull(), F.col("found_in")).alias("found_in"),
    )

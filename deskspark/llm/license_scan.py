"""Licence scan: units of text compared with licence templates by the Dice coefficient over word bigrams.

A unit is a line or a block between blank lines (the whole text where there is none), or a window inside the text.  Units are normalised to words
of a-z and 0-9.  Dice >= t needs a unit size between t/(2-t) and (2-t)/t times a template's, so units outside the bounds
of every template are dropped before any bigram is made, and each template is compared only within its own bounds.

Windows find notices that share their line or paragraph with other text.  A match holds at least t/(2-t) of a template's
bigrams, so of any set of more than the other 2(1-t)/(2-t) of them (the *anchors*, the longest ones) at least one occurs.  Every
place of an anchor puts a window of the template's length where the template would lie, and the window is judged like the other units.

All of it is one projection without a shuffle; the template list is a literal of fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import ascii_lower, let, read, require

THRESHOLD = 0.8

#: Names and wording of the licence notices that are looked for.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                         "governing permissions and limitations under the License.",
    "mit": "Released under the MIT License.",
    "mit-notice": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the Software), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
                 "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
               "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mit-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the Software), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
                "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
                "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
                "of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
                "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
                "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
                "THE SOFTWARE.",
    "isc-full": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS "
                "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
                "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
                "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
                "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-full": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                  "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                  "the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY "
                  "THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
                  "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                  "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
                  "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
                  "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
                  "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "rights-reserved": "All rights reserved. No part of this work may be reproduced without written permission.",
}


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def template_bigrams(templates: dict[str, str]) -> dict[str, list[str]]:
    out = {}
    for name, text in templates.items():
        words = _plain_words(text)
        out[name] = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
    return out


def anchors(templates: dict[str, str], threshold: float) -> list[tuple[str, str, int, int]]:
    """(template, bigram, its place from 0, words of the template) for the bigrams of which a match holds at least one."""
    out = []
    for name, text in sorted(templates.items()):
        words = _plain_words(text)
        grams = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        distinct = sorted({*grams}, key=lambda g: (-len(g), g))
        chosen = {*distinct[:math.floor(len(distinct) * 2 * (1 - threshold) / (2 - threshold) + 1e-9) + 1]}
        out += [(name, g, i, len(words)) for i, g in enumerate(grams) if g in chosen]
    return out


def windows(text: Column, templates: dict[str, str], threshold: float) -> Column:
    """array<struct<license, at, dice>>: the windows of the whole text that reach the threshold, by template and first word (from 1)."""
    grams, marked = template_bigrams(templates), anchors(templates, threshold)
    names = sorted(grams)
    by = {}
    for name, gram, place, _ in marked:
        by.setdefault(gram, []).append((names.index(name) + 1, place))
    at = F.create_map(*[x for g, places in sorted(by.items()) for x in (
        F.lit(g), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(o).alias("o")) for t, o in places]))])
    sizes = {name: n for name, _, _, n in marked}
    long = F.array(*[F.lit(sizes[n]) for n in names])
    sets = F.array(*[F.array(*map(F.lit, grams[n])) for n in names])

    def judged(g, s):
        # the window's distinct bigrams, at the text's begin the part of it that there is
        first = F.greatest(s["at"], F.lit(1))
        own = F.array_distinct(F.slice(g, first, F.element_at(long, s["t"]) - 1 + F.least(s["at"], F.lit(1)) - 1))
        of = F.element_at(sets, s["t"])
        return F.struct(F.element_at(F.array(*map(F.lit, names)), s["t"]).alias("license"), s["at"].alias("at"),
                        (F.size(F.array_intersect(own, of)) * 2.0 / (F.size(own) + F.size(of))).alias("dice"))

    def of(w):
        return let(F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(1))),
                              lambda a, b: F.concat(a, F.lit(" "), b)), found)

    def found(g):
        hits = F.filter(F.transform(g, lambda x, i: F.when(x.isin([*by]), F.struct(x.alias("x"), (i + 1).alias("i")))), lambda h: h.isNotNull())
        starts = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(at, h["x"]), lambda a: F.struct(
            a["t"].alias("t"), (h["i"] - a["o"]).alias("at"))))))
        return let(starts, lambda some: F.filter(F.transform(some, lambda s: judged(g, s)), lambda m: m["dice"] >= threshold))

    return let(unit_words(ascii_lower(F.coalesce(text, F.lit("")))), of)


def unit_words(unit: Column) -> Column:
    return F.regexp_extract_all(unit, F.lit("[a-z0-9]+"), F.lit(0))


def matches(text: Column, templates: dict[str, str], threshold: float) -> Column:
    """array<struct<license, dice>>: for each unit of ``text`` the best template (ties: first name) with Dice >= threshold."""
    grams = template_bigrams(templates)
    all_grams = sorted({x for g in grams.values() for x in g})
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    # a unit of n distinct bigrams has n + 1 words or more; repeated bigrams only shorten the set, so only the lower bound
    # holds for the word count before bigrams are made
    fewest = int(min(len(g) for g in grams.values()) * low)

    def bigrams(w):
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - 1),
                                            lambda i: F.concat(F.element_at(w, i), F.lit(" "), F.element_at(w, i + 1))))

    def scored(g, hit):
        each = [F.when((F.size(g) >= len(t) * low) & (F.size(g) <= len(t) * high),
                       F.struct((F.size(F.array_intersect(hit, F.array(*map(F.lit, t)))) * 2.0 / (F.size(g) + len(t))).alias("dice"),
                                F.lit(name).alias("license")))
                for name, t in sorted(grams.items())]
        best = F.array_sort(F.filter(F.array(*each), lambda x: x["dice"] >= threshold),
                            lambda a, b: F.when(a["dice"] > b["dice"], -1).when(a["dice"] < b["dice"], 1)
                            .when(a["license"] < b["license"], -1).when(a["license"] > b["license"], 1).otherwise(0))
        return F.get(best, F.lit(0))

    def judged(w):
        # the bigrams that no template has only count towards the size; hits under threshold/2 * (size + least template) can't reach it
        def within(g):
            return let(F.filter(g, lambda x: x.isin(all_grams)), lambda hit: F.when(
                F.size(hit) * 2.0 >= threshold * (F.size(g) + min(len(t) for t in grams.values())), scored(g, hit)))
        return F.when(F.size(w) > max(fewest, 1), let(bigrams(w), within))

    def of(unit):
        return let(unit_words(unit), judged)

    low_text = ascii_lower(F.coalesce(text, F.lit("")))

    def units(t):
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(x) > 0)
        blocks = F.filter(F.split(t, r"\n[\x20\x09\x0D]*\n", -1), lambda x: F.instr(x, "\n") > 0)
        return F.filter(F.transform(F.concat(lines, blocks), of), lambda m: m.isNotNull())

    return let(low_text, units)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_matches (lines and blocks that match a template), n_windows (matching windows), licenses (names of both,
    sorted, comma-joined), best_dice (0 without a match) and flagged.

    A null or empty text has no units; equal best scores go to the first name; windows that overlap count each; repeated rows are scanned alike; an empty
    table gives an empty result; other columns are not looked at; whole texts are read, whatever their length."""
    require(docs, "doc_id", "text")
    used = templates or TEMPLATES
    found = docs.select("doc_id", matches(F.col("text"), used, threshold).alias("m"), windows(F.col("text"), used, threshold).alias("w"))
    names = F.concat(F.transform("m", lambda x: x["license"]), F.transform("w", lambda x: x["license"]))
    dice = F.concat(F.transform("m", lambda x: x["dice"]), F.transform("w", lambda x: x["dice"]))
    return found.select("doc_id", F.size("m").cast("long").alias("n_matches"), F.size("w").cast("long").alias("n_windows"),
                        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("licenses"),
                        F.coalesce(F.array_max(dice), F.lit(0.0)).alias("best_dice"), ((F.size("m") > 0) | (F.size("w") > 0)).alias("flagged"))


def op7_license_scan(spark, sf_dir):
    return license_scan(read(spark, sf_dir, "documents"))


def oracle(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    values = ", ".join("('{}', {})".format(n, "[" + ", ".join(f"'{x}'" for x in g) + "]")
                       for n, g in sorted(template_bigrams(templates or TEMPLATES).items()))
    marked = ", ".join(f"('{n}', '{g}', {o}, {k})" for n, g, o, k in anchors(templates or TEMPLATES, threshold))
    return rf"""
WITH t(license, g) AS (VALUES {values}),
an(license, x, o, k) AS (VALUES {marked}),
d AS (SELECT row_number() OVER () AS r, doc_id,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
u AS (SELECT r, unnest(list_concat(list_filter(string_split(x, chr(10)), lambda y: length(y) > 0),
             list_filter(string_split_regex(x, '\n[\x20\x09\x0D]*\n'), lambda y: contains(y, chr(10))))) AS unit FROM d),
w AS (SELECT r, row_number() OVER () AS k, regexp_extract_all(unit, '[a-z0-9]+') AS ws FROM u),
b AS (SELECT r, k, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM w WHERE len(ws) > 1),
s AS (SELECT r, k, license, len(list_intersect(b.g, t.g)) * 2.0::DOUBLE / (len(b.g) + len(t.g)) AS dice
      FROM b, t WHERE len(b.g) >= len(t.g) * {threshold / (2 - threshold)!r}::DOUBLE AND len(b.g) <= len(t.g) * {(2 - threshold) / threshold!r}::DOUBLE),
m AS (SELECT r, k, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice FROM s WHERE dice >= {threshold} GROUP BY r, k),
ww AS MATERIALIZED (SELECT r, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) AS g FROM (SELECT r, regexp_extract_all(x, '[a-z0-9]+') AS ws FROM d)),
st AS (SELECT DISTINCT r, license, k, p - o AS pl FROM (SELECT r, unnest(g) AS x, generate_subscripts(g, 1) AS p FROM ww) JOIN an USING (x)),
wd AS (SELECT r, license, len(list_intersect(own, t.g)) * 2.0::DOUBLE / (len(own) + len(t.g)) AS dice
       FROM (SELECT r, license, list_distinct(g[greatest(pl, 1):pl + k - 2]) AS own FROM st JOIN ww USING (r)) JOIN t USING (license)),
wm AS (SELECT * FROM wd WHERE dice >= {threshold}),
a AS (SELECT r, sum(m) AS n, sum(1 - m) AS nw, string_agg(DISTINCT license, ',' ORDER BY license) AS l, max(dice) AS best
      FROM (SELECT r, license, dice, 1 AS m FROM m UNION ALL SELECT r, license, dice, 0 FROM wm) GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(nw, 0)::BIGINT AS n_windows, coalesce(l, '') AS licenses, coalesce(best, 0)::DOUBLE AS best_dice,
       n IS NOT NULL AS flagged
FROM d LEFT JOIN a USING (r)
"""

"""Licence scans: Dice coefficient over word bigrams between normalised text units and licence templates.

All of it is DataFrame expressions inside the row, so nothing is shuffled.  Units are the lines of a text and, if there
are several, the whole of it.  A unit declares the licence whose template it is most like.  A unit is compared only with templates that its number of distinct bigrams lets reach the
threshold: with n and m bigrams the coefficient is at most 2 min(n, m) / (n + m).

Licences that no such unit declares are looked for in paragraphs of several lines and in runs of words as long as the
template, wherever they begin or end.  A run can reach the threshold only if the text holds the least number of the
template's bigrams that :func:`size_bounds` gives, so it holds one of any set of as many as the others plus one; few texts
pass that.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Notices by which texts declare their licences, as the licences' publishers word them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-2-Clause", "This software is released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "This software is released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)


# Whole licence texts, without the lines that name the copyright's holder.
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
_MIT = _GRANT + (
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_NOTICE = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
_MIT_END = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_END = (
    '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BOOST = (
    "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization "
    'obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including "
    "the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in "
    "part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object "
    'code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_POSTGRESQL = (
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written "
    "agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all "
    "copies. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, "
    "INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF THIS SOFTWARE AND ITS DOCUMENTATION, EVEN IF THE COPYRIGHT HOLDER HAS BEEN ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE. THE COPYRIGHT HOLDER SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN \"AS IS\" BASIS, AND THE "
    "COPYRIGHT HOLDER HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
    "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
    "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
    "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
    'under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
    "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
    "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
    "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
    "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
FULL_TEXTS: tuple[tuple[str, str], ...] = (
    ("0BSD", _ISC + _ISC_END),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
    ("BSL-1.0", _BOOST),
    ("ISC", _ISC + _ISC_NOTICE + _ISC_END),
    ("MIT", _MIT + _MIT_NOTICE + _MIT_END),
    ("MIT-0", _MIT + ". " + _MIT_END),
    ("PostgreSQL", _POSTGRESQL),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
)


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """The least and most bigrams of a unit that can reach ``threshold`` against a template of ``n``."""
    ratio = threshold / (2 - threshold)
    return math.ceil(n * ratio - 1e-9), math.floor(n / ratio + 1e-9)


def _keys(grams: list[str], low: int) -> list[str]:
    """Bigrams of which any text has one that holds ``low`` of ``grams``; long ones are rare."""
    return sorted(grams, key=len, reverse=True)[: len(grams) - low + 1]


def _literals(templates: Sequence[tuple[str, str]], threshold: float) -> Column:
    rows = []
    for name, text in templates:
        grams = template_bigrams(text)
        if grams:
            low, high = size_bounds(len(grams), threshold)
            rows.append(
                F.struct(
                    F.lit(name).alias("license"),
                    F.lit(len(grams)).alias("n"),
                    F.lit(low).alias("low"),
                    F.lit(high).alias("high"),
                    F.array(*map(F.lit, grams)).alias("grams"),
                    F.lit(len(template_words(text))).alias("words"),
                    F.array(*map(F.lit, _keys(grams, low))).alias("keys"),
                )
            )
    return F.array(*rows)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.8,
    full_texts: Sequence[tuple[str, str]] = FULL_TEXTS,
) -> DataFrame:
    """Licences that each row of ``docs(doc_id, text, ...)`` declares.

    Returns doc_id, n_units (lines that hold a character, and the whole text if it has several lines), license (of the
    best match, null without one; ties to the smaller name), dice (its coefficient), licenses (distinct names, sorted,
    comma-joined; empty without any).  Each unit declares the licence of the template that it is most like (ties to the
    smaller name), if that reaches ``threshold``.  Lines and the whole text are units for ``templates``; where a text has
    enough of another licence's bigrams in all, paragraphs of several lines and runs of words as long as that licence's
    templates are units for ``templates`` and ``full_texts``.  Null and empty texts have no units; repeated rows count each;
    an empty table gives an empty result.  Templates are literals of the plan: some hundreds at most.
    """
    if not any(template_bigrams(t) for _, t in templates):
        raise ValueError("no template has two words")
    every = [*templates, *full_texts]
    table, wide = _literals(templates, threshold), _literals(every, threshold)
    least = min(size_bounds(len(g), threshold)[0] for _, t in every if (g := template_bigrams(t)))
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    units = F.when(F.size(lines) > 1, F.concat(lines, F.array(text))).otherwise(lines)
    held_by = [(g, size_bounds(len(g), threshold)[0]) for _, t in every if (g := template_bigrams(t))]
    keys = F.array(*map(F.lit, sorted({k for g, low in held_by for k in _keys(g, low)})))
    none = F.array().cast("array<struct<less:double,license:string>>")

    def grams(words: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1))))

    def worded(texts: Column) -> Column:
        """Words of the texts that have enough of them."""
        split = F.transform(texts, lambda u: F.filter(F.split(u, "[^a-z0-9]+"), lambda w: w != ""))
        return F.filter(split, lambda w: F.size(w) > F.lit(max(least, 1)))

    def match(b: Column, t: Column) -> Column:
        return F.struct((-2.0 * F.size(F.array_intersect(b, t["grams"])) / (F.size(b) + t["n"])).alias("less"), t["license"].alias("license"))

    def best(b: Column, among: Column) -> Column:
        """What a unit of these bigrams declares; null for nothing."""
        fit = F.filter(among, lambda t: (F.size(b) >= t["low"]) & (F.size(b) <= t["high"]))
        return F.array_min(F.filter(F.transform(fit, lambda t: match(b, t)), lambda m: m["less"] <= -threshold))

    def declared(units: Column, among: Column) -> Column:
        return F.filter(F.transform(units, lambda b: best(b, among)), lambda m: m.isNotNull())

    def runs(words: Column, t: Column) -> Column:
        """Runs of the template's length that hold enough of its bigrams and begin with one, or end the text."""

        def starts(hits: Column) -> Column:
            firsts = F.filter(
                F.sequence(F.lit(0), F.size(hits) - t["low"]), lambda k: F.get(hits, k + t["low"] - 1) - F.get(hits, k) <= t["words"] - 2
            )
            return F.array_distinct(F.transform(firsts, lambda k: F.least(F.get(hits, k), F.size(words) - t["words"])))

        hits = F.filter(
            F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.array_contains(t["grams"], F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)))
        )
        run = F.when(F.size(words) >= t["words"], _let(hits, lambda h: F.when(F.size(h) >= t["low"], starts(h))))
        return F.transform(F.coalesce(run, F.array().cast("array<int>")), lambda s: grams(F.slice(words, s + 1, t["words"])))

    def beyond(words: Column, b: Column, found: Column) -> Column:
        """Matches of licences not found yet, of a text of these words and bigrams."""
        held = F.transform(found, lambda m: m["license"])
        fit = F.filter(
            wide,
            lambda t: (F.size(b) >= t["low"])
            & ~F.array_contains(held, t["license"])
            & F.arrays_overlap(b, t["keys"])
            & (F.size(F.array_intersect(t["grams"], b)) >= t["low"]),
        )
        blocks = F.filter(F.split(text, r"\n[^\S\n]*(?:\n[^\S\n]*)+"), lambda p: F.contains(p, F.lit("\n")))
        return F.when(
            F.arrays_overlap(b, keys),
            _let(
                fit,
                lambda f: F.when(
                    F.size(f) > 0,
                    declared(F.concat(F.transform(worded(blocks), grams), F.flatten(F.transform(f, lambda t: runs(words, t)))), wide),
                ).otherwise(none),
            ),
        ).otherwise(none)

    def matches(words: Column, units: Column) -> Column:
        """Of all units; the last is the whole text."""
        whole = _let(declared(units, table), lambda m: F.concat(m, beyond(F.element_at(words, -1), F.element_at(units, -1), m)))
        return F.when(F.size(units) > 0, whole).otherwise(none)

    found = _let(worded(F.col("units")), lambda w: _let(F.transform(w, grams), lambda g: matches(w, g)))
    first = F.array_min("found")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), units.alias("units"))
        .select("doc_id", F.size("units").cast("long").alias("n_units"), found.alias("found"))
        .select(
            "doc_id",
            "n_units",
            first["license"].alias("license"),
            (-first["less"]).alias("dice"),
            F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: m["license"]))), ",").alias("licenses"),
        )
    )


def oracle(threshold: float = 0.8) -> str:
    """DuckDB SQL for :func:`scan_licenses` over ``documents``, without its pruning."""
    rows = ", ".join(
        "('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in template_bigrams(text)))  # names and bigrams hold no quotes
        for name, text in TEMPLATES
    )
    return f"""
WITH t(license, grams) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS k, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
l AS (SELECT k, doc_id, text, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS lines FROM d),
u AS (SELECT k, doc_id, CASE WHEN len(lines) > 1 THEN list_append(lines, text) ELSE lines END AS units FROM l),
w AS (SELECT k, j, regexp_extract_all(unit, '[a-z0-9]+') AS w FROM (SELECT k, unnest(units) AS unit, unnest(range(len(units))) AS j FROM u)),
g AS (SELECT k, j, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM w WHERE len(w) > 1),
m AS (
    SELECT g.k, g.j, t.license, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
    FROM g, t WHERE len(g.grams) <= 2 * len(t.grams) AND len(t.grams) <= 2 * len(g.grams)
),
e AS (SELECT k, arg_min(license, (-dice, license)) AS license, max(dice) AS dice FROM m WHERE dice >= {threshold} GROUP BY k, j),
b AS (SELECT k, arg_min(license, (-dice, license)) AS license, max(dice) AS dice, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM e GROUP BY k)
SELECT u.doc_id, len(u.units)::BIGINT AS n_units, b.license, b.dice, coalesce(b.licenses, '') AS licenses FROM u LEFT JOIN b USING (k)
"""

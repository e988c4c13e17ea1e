"""License scans: MinHash bands over text windows retrieve templates, shingles verify.

Templates are statements, notices and license texts, grouped by length.  A match
holds at least 0.75 of its template's shingles, and so one word of a set that
hits more than a quarter of them; texts and places without such a word cannot
match and are passed over.  Windows lie on a grid of the group's length and reach
one length to either side, so they overlap, and every match with an anchor word
lies whole inside the window of that word's cell.  A text has at most one window
a cell, whatever it repeats.

A window and a template meet if one of 128 MinHash values is equal (bands of one
row).  The smallest similarity a match can have with its window is 1 in 13, at
which they miss each other with probability 4e-5; longer templates stand out
more.  Matches are then verified, each template for itself: a share of at least
0.75 of the template's shingles is in the window.  Only matches that share places
of the text compete, so different statements in one window all stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let

WIDTH = 5
HASHES = 128
PERCENT = 75
WORDS = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"

# Statements, notices and texts by which common licenses are declared.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    (
        "ISC",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    (
        "BSD-2-Clause",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ),
    (
        "BSD-3-Clause",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def _shingles(words: Column) -> Column:
    """Distinct shingles; the whole sequence if it is shorter than one."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - WIDTH + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(WIDTH)), " ")))


def _minhash(shingles: Column) -> Column:
    places = F.sequence(F.lit(1), F.lit(HASHES))
    return let(shingles, lambda sh: F.transform(places, lambda k: F.array_min(F.transform(sh, lambda s: F.xxhash64(s, k)))))


def _cover(words: list[str]) -> list[str]:
    """Words that hit more than a quarter of a template's shingles, long ones first, since short ones are everywhere.

    A match lacks a quarter of the shingles at most, so it holds one of the words.
    """
    spans = [set(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)]
    missed, found = spans, []
    while 100 * len(missed) >= PERCENT * len(spans):
        best = max(sorted(set().union(*missed)), key=lambda w: (min(len(w), 8), sum(w in s for s in missed), len(w)))
        found.append(best)
        missed = [s for s in missed if best not in s]
    return found


def _matched(win: Column, start: Column, shingles: Column) -> Column:
    """Places of the text where a template's shingles are, and which ones they are."""
    last = F.greatest(F.size(win) - WIDTH + 1, F.lit(1))
    at = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct((start + i - 1).alias("p"), F.array_position(shingles, F.array_join(F.slice(win, i, F.lit(WIDTH)), " ")).cast("int").alias("k")),
    )
    return F.filter(at, lambda x: x["k"] > 0)


def _enough(found: Column, n: Column) -> Column:
    return F.size(F.array_distinct(F.transform(found, lambda x: x["k"]))) * 100 >= PERCENT * n


def _statements(found: Column, n: Column, words: Column) -> Column:
    """A template's matched places, in order, parted into its statements."""
    place = "struct<p:int,k:int>"
    none = F.struct(F.array().cast(f"array<array<{place}>>").alias("done"), F.array().cast(f"array<{place}>").alias("at"))

    def step(acc, x):
        at, first = acc["at"], F.get(acc["at"], F.lit(0))
        # a statement ends where it begins again, or is half as long again as its template
        ends = (F.size(at) > 0) & ((x["p"] - first["p"] >= words * 1.5) | ((x["k"] == first["k"]) & _enough(at, n)))
        begun = F.struct(F.concat(acc["done"], F.array(at)).alias("done"), F.array(x).alias("at"))
        return F.when(ends, begun).otherwise(F.struct(acc["done"].alias("done"), F.concat(at, F.array(x)).alias("at")))

    return F.filter(F.aggregate(found, none, step, lambda acc: F.concat(acc["done"], F.array(acc["at"]))), lambda at: _enough(at, n))


def _settled(hits: DataFrame) -> DataFrame:
    """Of hits that share places the one with most places, then with the largest share, then the first by template stays."""
    line = Window.partitionBy("doc_id", "d").orderBy("lo", "hi", "template")
    apart = F.col("lo") > F.max("hi").over(line.rowsBetween(Window.unboundedPreceding, -1))
    rows = hits.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("island", F.sum("apart").over(line))
    each = F.struct((-F.size("places")).alias("less"), (-F.col("share")).alias("short"), "template", "lo", "license_id", "share", "places")
    ranked = rows.groupBy("doc_id", "d", "island").agg(F.sort_array(F.collect_list(each)).alias("all"))

    def step(kept, x):
        return F.when(F.exists(kept, lambda y: F.arrays_overlap(y["places"], x["places"])), kept).otherwise(F.concat(kept, F.array(x)))

    kept = F.aggregate("all", F.slice("all", 1, 0), step)
    return ranked.select("doc_id", F.explode(kept).alias("b")).select("doc_id", "b.license_id", "b.share")


def _windows(size: int, anchors: Column) -> Column:
    """Windows of a text's words ``w`` round the cells of ``size`` words that hold an anchor."""
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains(anchors, F.get(F.col("w"), i)))
    cells = F.array_distinct(F.transform(at, lambda i: F.floor(i / size).cast("int")))

    def around(cell):
        start = F.greatest((cell - 1) * size, F.lit(0)) + 1
        return F.struct(F.lit(size).alias("size"), start.alias("start"), F.slice(F.col("w"), start, (cell + 2) * size - start + 1).alias("win"))

    return F.transform(cells, around)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, license_id, matches, containment``: the licenses each document states.

    ``matches`` counts the statements, ``containment`` is the best of their shares
    of the template's shingles.  Null, empty and wordless texts state none.  Of
    templates that match at one place the one with most shingles there counts,
    then that of the largest share, then the first of the list: a text wins over
    a statement or clause it holds.  Rows of one id, or without an
    id, are one document, and a text that it repeats counts once.  Other columns
    are not read; an empty table or no template gives an empty result.  Texts of any
    length are searched whole.  A template of fewer than five words is an error.
    """
    import re

    spark = docs.sparkSession
    groups: dict[int, list] = {}
    for n, (name, body) in enumerate(templates):
        words = re.findall(WORDS, body.lower())
        if len(words) < WIDTH:
            raise ValueError(f"a template needs {WIDTH} words: {body!r}")
        size = WIDTH
        while size < len(words):
            size *= 2
        groups.setdefault(size, []).append((n, name, words))
    wanted = sorted({w for g in groups.values() for _, _, ws in g for w in _cover(ws)})
    if not wanted:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit("").alias("license_id"), F.lit(0).cast("bigint").alias("matches"), F.lit(0.0).alias("containment")).limit(0)
    low = F.lower(F.col(text))
    some = F.lit(False)
    for w in wanted:
        some = some | F.contains(low, F.lit(w))
    texts = docs.filter(some).select(F.col(id_col).alias("doc_id"), F.col(text).alias("t"))
    worded = texts.select("doc_id", F.xxhash64("t").alias("d"), _words(F.col("t")).alias("w")).filter(F.size("w") > 0)
    spots = [_windows(size, F.array(*[F.lit(w) for w in sorted({w for _, _, ws in group for w in _cover(ws)})])) for size, group in sorted(groups.items())]
    rows = worded.select("doc_id", "d", F.explode(F.concat(*spots)).alias("x")).select("doc_id", "d", "x.*")
    rows = rows.withColumn("sh", _shingles(F.col("win"))).withColumn("bands", _minhash(F.col("sh")))
    known = spark.createDataFrame([(size, n, name, " ".join(ws)) for size, g in groups.items() for n, name, ws in g], "size int, template int, license_id string, body string")
    known = known.withColumn("tsh", _shingles(F.split("body", " "))).withColumn("tbands", _minhash(F.col("tsh")))
    known = known.select("size", "template", "license_id", "tsh", "tbands", F.size("tsh").alias("n"), F.size(F.split("body", " ")).alias("words"))
    # every window against the templates of its length: as many rows as these, and only the similar ones leave
    met = rows.join(F.broadcast(known), "size").filter(F.exists(F.zip_with("bands", "tbands", lambda a, b: a == b), lambda x: x))
    verified = met.filter(F.size(F.array_intersect("sh", "tsh")) * 100 >= PERCENT * F.col("n"))
    verified = verified.withColumn("at", _matched(F.col("win"), F.col("start"), F.col("tsh")))
    # windows overlap: their places are put together before statements are told apart
    found = verified.groupBy("doc_id", "d", "template", "license_id", "n", "words").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"), F.max_by("at", F.struct(F.size("at"), -F.col("start"))).alias("best")
    )
    found = found.withColumn("all", _statements(F.col("at"), F.col("n"), F.col("words")))
    # one that is spread too widely to be told apart stays as its best window has it
    hits = found.withColumn("hit", F.explode(F.when(F.size("all") > 0, F.col("all")).otherwise(F.array("best"))))
    hits = hits.select(
        *("doc_id", "d", "template", "license_id", "n"),
        F.transform("hit", lambda x: x["p"]).alias("places"),
        (F.size(F.array_distinct(F.transform("hit", lambda x: x["k"]))) / F.col("n")).alias("share"),
    )
    hits = _settled(hits.withColumn("lo", F.array_min("places")).withColumn("hi", F.array_max("places")))
    return hits.groupBy("doc_id", "license_id").agg(F.count("*").alias("matches"), F.max("share").alias("containment"))


_PLACE = "STRUCT(p BIGINT, k BIGINT)"
#: Every place of every template's shingles in the whole text: no windows, no MinHash.
SQL = f"""
WITH tp(t, name, body) AS (VALUES {", ".join("({}, '{}', '{}')".format(n, name, body.replace("'", "''")) for n, (name, body) in enumerate(TEMPLATES))}),
tw AS (SELECT t, name, regexp_extract_all(lower(body), '{WORDS}') AS w FROM tp),
tg AS (SELECT t, name, CAST(len(w) AS BIGINT) AS words, unnest(range(1, len(w) - {WIDTH - 2})) AS k, w FROM tw),
ts AS (SELECT t, name, words, array_to_string(w[k:k + {WIDTH - 1}], ' ') AS gram, min(k) AS k FROM tg GROUP BY ALL),
tn AS (SELECT t, name, words, count(*) AS n FROM ts GROUP BY ALL),
d AS (SELECT doc_id, text, row_number() OVER () AS id FROM (SELECT DISTINCT doc_id, text FROM documents)),
dw AS (SELECT id, regexp_extract_all(lower(coalesce(text, '')), '{WORDS}') AS w FROM d),
dp AS (SELECT id, w, unnest(range(1, len(w) - {WIDTH - 2})) AS p FROM dw),
dg AS (SELECT id, p, array_to_string(w[p:p + {WIDTH - 1}], ' ') AS gram FROM dp),
a AS (SELECT id, ts.t, list({{'done': CAST([] AS {_PLACE}[][]), 'at': [CAST({{'p': p, 'k': k}} AS {_PLACE})]}} ORDER BY p) AS xs FROM dg JOIN ts USING (gram) GROUP BY id, ts.t),
r AS (SELECT id, t, name, n, list_reduce(xs, lambda acc, x: CASE WHEN x['at'][1]['p'] - acc['at'][1]['p'] >= words * 1.5
      OR (x['at'][1]['k'] = acc['at'][1]['k'] AND len(list_distinct(list_transform(acc['at'], lambda v: v['k']))) * 100 >= {PERCENT} * n)
    THEN {{'done': list_append(acc['done'], acc['at']), 'at': x['at']}} ELSE {{'done': acc['done'], 'at': list_concat(acc['at'], x['at'])}} END) AS s FROM a JOIN tn USING (t)),
u AS (SELECT id, t, name, n, unnest(list_append(s['done'], s['at'])) AS hit FROM r),
h AS (SELECT *, list_transform(hit, lambda v: v['p']) AS places, len(list_distinct(list_transform(hit, lambda v: v['k']))) / n AS share FROM u),
g AS (SELECT id, list([{{'name': name, 'share': share, 'places': places}}] ORDER BY len(places) DESC, share DESC, t, places[1]) AS xs FROM h WHERE share * 100 >= {PERCENT} GROUP BY id),
b AS (SELECT id, unnest(list_reduce(xs, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: list_has_any(y['places'], x[1]['places']))) > 0 THEN acc ELSE list_concat(acc, x) END)) AS x FROM g)
SELECT doc_id, x['name'] AS license_id, count(*) AS matches, max(x['share']) AS containment FROM b JOIN d USING (id) GROUP BY doc_id, license_id
"""

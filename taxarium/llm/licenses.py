"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies; DataFrame operations only.

A window holds twice as many words as a template and one starts every template length, so each
occurrence lies whole in a window.  A band is one minimum hash.  A window that holds a template to
THRESHOLD has at least a certain Jaccard similarity with it, a sixth for templates of one shingle
and over a third for long ones; templates of each length get as many bands as bring the
probability that such a window shares none below LOST.  Exact shingle containment then decides.
Windows without a shingle of any template have similarity zero and get no bands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, id_back
from .passages import document_key, hits, numbered, once, reference, shingles, text_words, window_shingles

THRESHOLD = 0.8
#: The probability that a window of least similarity is not retrieved.
LOST = 1e-8
#: Template shingles and template lengths up to which they are part of the plan, so that no text is shuffled.
PLAN_SHINGLES, PLAN_LENGTHS = 10_000, 50
#: Notices to look for.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("reserved", "All rights reserved. No part of this publication may be reproduced"),
    (
        "apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS.",
    ),
    (
        "bsd-2-clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "zlib-text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    ("unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "template_id string, text string")


def bands(threshold: float) -> Column:
    """How many bands templates and windows of n words and shingles of k take."""
    t, w = F.col("n") - F.col("k") + 1, 2 * F.col("n") - F.col("k") + 1
    held = F.ceil(t * threshold - 1e-6)
    return F.ceil(F.lit(math.log(LOST)) / F.log(1 - held / (t + w - held))).cast("int")


def signature(sh: Column, threshold: float) -> Column:
    """(band, least hash) of a shingle list, for each band."""
    least = lambda s, i: F.array_min(F.transform(s, lambda h: F.xxhash64(h, i)))
    return once(F.array_distinct(sh), lambda s: F.transform(F.sequence(F.lit(1), bands(threshold)), lambda i: F.struct(i.alias("band"), least(s, i).alias("h"))))


def windows_in_place(docs: DataFrame, marks: list) -> DataFrame:
    """_id, _x, start, n, k, sh of the windows that hold one of the marks (n, k, h), cut within each document's row."""
    by_size: dict[int, dict[int, list[int]]] = {}
    for r in marks:
        by_size.setdefault(r["k"], {}).setdefault(r["n"], []).append(r["h"])
    sizes = sorted(by_size)
    rows = text_words(docs, *document_key()).select("_id", "_x", F.size("w").alias("m"), *(shingles("w", k).alias(f"s{k}") for k in sizes))
    found = None
    for k in sizes:
        known = sorted({h for hs in by_size[k].values() for h in hs})
        holds = F.exists(f"s{k}", lambda h: h.isin(known))
        found = holds if found is None else found | holds
    cuts = []
    for k in sizes:
        known = sorted({h for hs in by_size[k].values() for h in hs})
        places = F.filter(F.transform(f"s{k}", lambda h, at: F.struct(h.alias("h"), at.alias("at"))), lambda p: p["h"].isin(known))
        cuts.append(once(places, lambda ps: F.concat(*(_cut(ps, n, k, hs) for n, hs in sorted(by_size[k].items())))))
    windows = rows.filter(found).select("_id", "_x", F.explode(F.concat(*cuts)).alias("v"))
    return windows.select("_id", "_x", "v.start", "v.n", "v.k", "v.sh").filter(F.size("sh") > 0)


def _cut(places: Column, n: int, k: int, hashes: list[int]) -> Column:
    """The windows of 2n words, one each n words, that the places (h, at) with these hashes fall into."""
    ats = F.transform(F.filter(places, lambda p: p["h"].isin(hashes)), lambda p: F.floor(p["at"] / n).cast("int"))
    starts = F.filter(F.array_distinct(F.concat(ats, F.transform(ats, lambda i: i - 1))), lambda i: i >= 0)
    length = lambda start: F.greatest(F.least(F.lit(2 * n), F.col("m") - start) - (k - 1), F.lit(0))
    return F.transform(starts, lambda i: F.struct((i * n).alias("start"), F.lit(n).alias("n"), F.lit(k).alias("k"), F.slice(f"s{k}", i * n + 1, length(i * n)).alias("sh")))


def windows_by_join(docs: DataFrame, ref: DataFrame, scratch: Scratch) -> DataFrame:
    """The same windows for reference tables of any size: texts meet their windows in a shuffle."""
    found = hits(docs, ref).withColumn("i", F.floor(F.col("at") / F.col("n")).cast("int"))
    found = found.select("_id", "_x", "n", "k", F.explode(F.array(F.col("i"), F.col("i") - 1)).alias("i")).filter("i >= 0").distinct()
    return window_shingles(docs, scratch.save(found.select("_id", "_x", (F.col("i") * F.col("n")).alias("start"), "n", "k", (2 * F.col("n")).alias("span"))))


def scan(docs: DataFrame, table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """_id, _x, template_id, start, n_words, containment: each document's best window for each template it holds.

    Among windows that hold as much the first counts; start is the window's first word.  Null texts
    and empty ones hold nothing; repeated rows (one id, one text) give one result; a very long text
    is one word list of its row; empty tables give no result; extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    ref = scratch.save(reference(table, "template_id"))
    marks = ref.select("n", "k", F.explode("sh").alias("h")).distinct().limit(PLAN_SHINGLES + 1).collect()
    small = len(marks) <= PLAN_SHINGLES and len({(r["n"], r["k"]) for r in marks}) <= PLAN_LENGTHS
    windows = windows_in_place(docs, marks) if small and marks else windows_by_join(docs, ref, scratch)
    windows = scratch.save(windows)
    index = ref.select("template_id", "n", F.explode(signature(F.col("sh"), threshold)).alias("b")).select("template_id", "n", "b.*")
    probe = windows.select("_id", "_x", "start", "n", F.explode(signature(F.col("sh"), threshold)).alias("b")).select("_id", "_x", "start", "n", "b.*")
    pairs = probe.join(index, ["n", "band", "h"]).select("_id", "_x", "start", "n", "template_id").distinct()
    whole = ref.select("template_id", numbered(F.col("sh")).alias("t"))
    checked = pairs.join(windows.select("_id", "_x", "start", "n", numbered(F.col("sh")).alias("s")), ["_id", "_x", "start", "n"]).join(whole, "template_id")
    checked = checked.withColumn("containment", F.size(F.array_intersect("t", "s")) / F.size("t")).filter(F.col("containment") >= threshold)
    best = checked.groupBy("_id", "_x", "template_id").agg(F.max_by(F.struct("start", "n", "containment"), F.struct("containment", -F.col("start"))).alias("b"))
    best = scratch.save(best.select("_id", "_x", "template_id", "b.start", F.col("b.n").alias("n_words"), "b.containment"))
    scratch.keep_only(best)
    return best


def report(docs: DataFrame, table: DataFrame) -> DataFrame:
    return scan(docs, table).select(id_back("_id").alias("doc_id"), "template_id", F.col("start").cast("long").alias("start_word"), F.col("n_words").cast("long").alias("n_words"), "containment")


_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in NOTICES)
SQL = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
tw AS (SELECT template_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM (VALUES {_VALUES}) t(template_id, text)),
ds AS (SELECT doc_id, unnest(range(0, len(w) - 4)) AS p, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM dw WHERE len(w) >= 5),
t AS (SELECT template_id, len(w) AS n, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM tw),
tc AS (SELECT template_id, n, s, count(*) AS c FROM t GROUP BY ALL),
hit AS (SELECT doc_id, template_id, n, p, s, c FROM ds JOIN tc USING (s)),
win AS (SELECT *, (p // n - d) * n AS st FROM hit, (VALUES (0), (1)) x(d) WHERE p // n - d >= 0 AND p <= (p // n - d) * n + 2 * n - 5),
k AS (SELECT doc_id, template_id, n, st, s, least(count(*), max(win.c)) AS held FROM win GROUP BY doc_id, template_id, n, st, s),
r AS (SELECT doc_id, template_id, n, st, CAST(sum(held) AS DOUBLE) / CAST(n - 4 AS DOUBLE) AS containment FROM k GROUP BY doc_id, template_id, n, st)
SELECT doc_id, template_id, CAST(st AS BIGINT) AS start_word, CAST(n AS BIGINT) AS n_words, containment
FROM r WHERE containment >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, template_id ORDER BY containment DESC, st) = 1
"""

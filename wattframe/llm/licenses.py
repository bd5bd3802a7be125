"""License scans by MinHash bands over overlapping text windows, verified by exact shingle containment.

Templates are a table of notices and of whole short licenses. Texts and templates become five-word shingles, hashed. For each
size class a text's windows of `width` shingles start every half width, so a template of the class (at most half a width)
lies whole in some window; templates beyond the widest class have a class of their own, four times their size. SEEDS
minimums of a window are one-row bands; windows that share a band with a template are candidates.
A template that is contained at 0.75 in such a window shares at least 0.75 * t / (width + t) of their union with
it, and t is at least a quarter of the width (whole widths for the smallest class), so 64 bands miss it with a chance
under 1e-3 at the worst and under 1e-6 for whole copies of half a width. A candidate is confirmed exactly, once, at its first
common band: the share of the template's shingles in the window is 0.75 or more.

Filters that can't drop a match come first. Of each template's words a few are chosen such that under 0.75 of its shingles
are without any: a text without any of these words contains no template and isn't cut into words. Only windows around
shingles that some template has get minimums, and only bands that some template has leave their row. Windows are slices of a
text's shingles, numbered by class and start, so work grows with the text, whatever words it repeats.

Everything is Spark SQL functions. Templates are broadcast and stand in the plan: their number and size are checked. Only matches
are shuffled (ids, no texts) and their rows are as many as matches. Words: lower-cased runs of a-z and 0-9; any other
character parts words.

Null texts match nothing; very long texts are scanned whole; every row gives one row; repeated ids share their matches.
A null id matches nothing in the result, since matches join by id. Extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed public license texts: (license, text).
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-2.0", "Licensed under CC BY-NC 2.0"),
    ("cc-by-nc-3.0", "Licensed under CC BY-NC 3.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
SHINGLE = 5
SEEDS = 64
CONTAINED = 0.75
#: Window widths in shingles; a template belongs to the first class that holds it in half a width.
WIDTHS = [2, 8, 32, 128]
#: Most templates that are broadcast; a longer table is refused.
MOST_TEMPLATES = 500
#: Most shingles of all templates.
MOST_SHINGLES = 50_000


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def marker_words(templates: list[tuple[str, str]]) -> list[str]:
    """Words such that every template has under CONTAINED of its shingles without any of them; the longest words first."""
    chosen: set[str] = set()
    for _, text in templates:
        words = template_words(text)
        shingles = [set(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]
        for w in sorted(set(words), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(not (s & chosen) for s in shingles) < CONTAINED * len(shingles):
                break
            chosen.add(w)
    return sorted(chosen)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+", -1), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Hashes of five consecutive words; of all words if they are fewer."""
    many = F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), many), lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(SHINGLE)), " ")))


def _minimums(shingles: Column) -> Column:
    """The least hash of each seed."""
    return F.transform(F.sequence(F.lit(1), F.lit(SEEDS)), lambda seed: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, seed))))


def _around(places: Column, n: int, width: int, classes: int) -> Column:
    """Numbers (first shingle * classes + n) of the windows of class n that hold one of the places (from 1)."""
    step = max(1, width // 2)

    def windows(place: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((place - width) / step).cast("long"))
        return F.transform(F.sequence(first, F.floor((place - 1) / step)), lambda k: k * (step * classes) + n)

    return F.array_distinct(F.flatten(F.transform(places, windows)))


def template_table(spark, templates: list[tuple[str, str]]) -> DataFrame:
    """license, number, size class (width), shingles and minimums of each template."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    rows = [(name, n, text) for n, (name, text) in enumerate(templates) if template_words(text)]
    shingles = spark.createDataFrame(rows, "license string, template int, text string").withColumn("shingles", F.array_distinct(_shingles(_words(F.col("text")))))
    width = F.lit(None).cast("int")
    for w in reversed(WIDTHS):
        width = F.when(F.size("shingles") * 2 <= w, w).otherwise(width)
    return shingles.select("license", "template", F.coalesce(width, 4 * F.size("shingles")).alias("width"), "shingles", _minimums(F.col("shingles")).alias("minimums"))


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and matches: array of (license, word), word being the first word (from 0) of the first window that holds it, by word."""
    templates = TEMPLATES if templates is None else templates
    known = template_table(docs.sparkSession, templates)
    held = known.select("width", "shingles", "minimums").collect()
    widths = sorted({r.width for r in held})
    wanted = sorted({x for r in held for x in r.shingles})
    if len(wanted) > MOST_SHINGLES:
        raise ValueError(f"more than {MOST_SHINGLES} shingles of templates")
    lows = sorted({x for r in held for x in r.minimums})
    markers = marker_words(templates)
    marked = F.lit(False)
    for w in markers:
        marked = marked | F.contains(F.col("lowered"), F.lit(w))
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(text_col, F.lit(""))).alias("lowered")).filter(marked)
    rows = rows.select("id", _words(F.col("lowered")).alias("words")).select("id", _shingles(F.col("words")).alias("shingles"))
    places = F.filter(F.transform("shingles", lambda x, i: F.when(x.isin(wanted), i + 1)), lambda i: i.isNotNull())
    rows = rows.select("id", "shingles", places.alias("places"))
    number = F.flatten(F.array(*[_around(F.col("places"), n, w, len(widths)) for n, w in enumerate(widths)])) if widths else F.array().cast("array<bigint>")
    width = F.array(*map(F.lit, widths)) if widths else F.array().cast("array<int>")

    def window(k: Column) -> Column:
        start, wide = F.floor(k / len(widths)), F.get(width, (k % len(widths)).cast("int"))
        return F.struct(wide.alias("width"), start.alias("start"), F.slice("shingles", (start + 1).cast("int"), wide).alias("window"))

    # Outer, and filtered after that: else the optimizer would repeat the whole expression in a filter before each explode.
    windows = rows.select("id", F.explode_outer(F.transform(number, window) if widths else F.array().cast("array<struct<width:int,start:bigint,window:array<bigint>>>")).alias("w")).filter("w is not null").select("id", "w.*")
    windows = windows.withColumn("minimums", _minimums(F.col("window")))
    shared = F.filter(F.transform("minimums", lambda x, i: F.struct((i + 1).alias("seed"), x.alias("low"))), lambda m: m["low"].isin(lows))
    asked = windows.select("*", F.explode_outer(shared).alias("m")).filter("m is not null").select("id", "width", "start", "window", "minimums", "m.seed", "m.low")
    bands = F.broadcast(known.select("license", F.col("shingles").alias("wanted"), "width", F.col("minimums").alias("its"), F.posexplode("minimums").alias("at", "low")).select("license", "wanted", "width", "its", (F.col("at") + 1).alias("seed"), "low"))
    hits = asked.join(bands, ["width", "seed", "low"])
    once = F.array_position(F.zip_with("minimums", "its", lambda a, b: a == b), True) == F.col("seed")
    share = F.size(F.array_intersect("wanted", "window")) / F.size("wanted")
    every = hits.filter(once).filter(share >= CONTAINED).select("id", "license", F.col("start").cast("int").alias("word"))
    first = every.groupBy("id", "license").agg(F.min("word").alias("word"))
    matches = first.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("word", "license"))).alias("matches"))
    none = F.array().cast("array<struct<word:int,license:string>>")
    return docs.select(F.col(id_col).alias("id")).join(matches, "id", "left").select(F.col("id").alias(id_col), F.coalesce("matches", none).alias("matches"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, F.size("matches").cast("long").alias("n_licenses"), F.array_join(F.array_sort(F.transform("matches", lambda m: m["license"])), ",").alias("licenses"), F.coalesce(F.try_element_at("matches", F.lit(1))["word"], F.lit(-1)).cast("long").alias("first_word"))

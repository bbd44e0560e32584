"""Licence scan by Dice coefficient over word bigrams (operator 6), with
DataFrame functions only.

Units are every line of a document, the whole document if it has several lines, and
windows of a template's length in the words of the document, so that notices which are
wrapped over lines, or stand inside a longer line or text, are found.  A unit and a licence template are compared by the sets of their word
bigrams: ``2 |A n B| / (|A| + |B|)``.  A coefficient of at least ``t`` needs sizes
within ``t / (2 - t)`` of each other, which prunes templates (and whole
documents) before any set is built.  Before that a unit must hold an anchor:
a match shares so many bigrams with its template that it cannot miss all those
around the template's anchor words.  Windows start where an anchor bigram of a
template (its rarest, as many as a match can't miss all of) places the template's first
word; of overlapping windows the best one is told.  All work happens within the row;
nothing is shuffled.

Normalisation: lower case, runs of anything but letters and digits are one blank.

Defined results: null and empty texts, and units of fewer than two words, match
nothing.  Every template that reaches the threshold is a row of its own.  Rows
that repeat an id are scanned one by one.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Public licence notices and texts, by licence (before the slash).
TEMPLATES = {
    "Apache-2.0/line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT/line": "Released under the MIT License.",
    "MIT/project": "This project is licensed under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-3.0/line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "BSD/line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0/notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0/line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/line": "Licensed under CC BY-NC 4.0.",
}


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def anchor_words(sets: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold holds one at least.

    A match of a template with ``n`` bigrams shares ``least`` of them or more, so
    any ``n - least + 1`` of them include a shared one.  Long words are taken
    until so many bigrams hold one; a word that holds a chosen one counts too."""
    chosen: list[str] = []
    for bigrams_ in sorted(sets.values(), key=len):
        n = len(bigrams_)
        least = max(1, math.ceil(threshold / 2 * (n + math.ceil(n * threshold / (2 - threshold) - 1e-9)) - 1e-9))
        words = sorted({w for b in bigrams_ for w in b.split(" ")}, key=lambda w: (-len(w), w))
        held = lambda: sum(any(c in w for c in chosen for w in b.split(" ")) for b in bigrams_)
        for w in words:
            if held() > n - least:
                break
            if not any(c in w for c in chosen):
                chosen.append(w)
    return [w for w in chosen if not any(c != w and c in w for c in chosen)]


def window_anchors(text: str, threshold: float) -> tuple[int, dict[str, int]]:
    """Bigrams of a template's text in a row, and its anchor bigrams with the place of
    each: so many that a window which reaches the threshold holds one, long words first."""
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    row = [f"{a} {b}" for a, b in zip(words, words[1:])]
    n = len(set(row))
    need = n - math.ceil(n * threshold / (2 - threshold) - 1e-9) + 1
    once = sorted((b for b in set(row) if row.count(b) == 1), key=lambda b: (-max(map(len, b.split(" "))), b))
    return len(row), {b: row.index(b) for b in once[:need]}


def has_anchor(unit: Column, anchors: list[str]) -> Column:
    found = F.lit(False)
    for w in anchors:
        found = found | F.contains(unit, F.lit(w))
    return found


def normalise(text: Column) -> Column:
    """Every run of marks is one blank (``text`` is in lower case)."""
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def bigrams(words: Column) -> Column:
    n = F.size(words)
    return F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """``id, line_no`` (-1: the whole document, -2: a window), ``first_word`` (of a
    window), ``template, license, shared, unit_bigrams, dice`` of every match."""
    sets = {name: template_bigrams(t) for name, t in (TEMPLATES if templates is None else templates).items()}
    sets = {name: s for name, s in sets.items() if s}
    ratio = threshold / (2 - threshold)
    least = min((math.ceil(len(s) * ratio - 1e-9) for s in sets.values()), default=1)
    most = max((math.floor(len(s) / ratio + 1e-9) for s in sets.values()), default=0)
    known = sorted({b for s in sets.values() for b in s})
    anchors = anchor_words(sets, threshold)
    # generated columns are computed once a row, whatever filters name them
    texts = docs.select(F.col(id_col).alias("id"), F.explode(F.array(F.lower(F.col(text_col)))).alias("low"))
    texts = texts.where(has_anchor(F.col("low"), anchors))
    rows = texts
    whole = F.when(F.contains("low", F.lit("\n")), F.array("low")).otherwise(F.array().cast("array<string>"))
    rows = rows.select("id", F.posexplode(F.concat(F.split("low", "\n"), whole)).alias("line_no", "unit"))
    rows = rows.where(has_anchor(F.col("unit"), anchors)).select(
        "id", F.when(F.contains("unit", F.lit("\n")), -1).otherwise(F.col("line_no")).alias("line_no"),
        F.split(normalise(F.col("unit")), " ").alias("words"))
    rows = rows.where(F.size("words") > least)  # distinct bigrams are fewer than words
    # a unit has at least as many distinct bigrams as distinct words, less one
    rows = rows.where((F.col("line_no") >= 0) | (F.size(F.array_distinct("words")) <= most + 1))
    rows = rows.where(F.exists(bigrams(F.col("words")), lambda b: b.isin(known)) if known else F.lit(False))
    rows = rows.select("id", "line_no", F.array_distinct(bigrams(F.col("words"))).alias("found"))
    rows = rows.select("id", "line_no", F.size("found").alias("unit_bigrams"),
                       F.filter("found", lambda b: b.isin(known)).alias("hits") if known else F.array().alias("hits"))
    rows = rows.where(F.col("unit_bigrams").between(least, most))
    matches = [F.struct(F.lit(name).alias("template"), F.lit(len(s)).alias("size"),
                        F.when(F.col("unit_bigrams").between(math.ceil(len(s) * ratio - 1e-9), math.floor(len(s) / ratio + 1e-9)),
                               F.size(F.array_intersect("hits", F.array(*[F.lit(b) for b in s])))).otherwise(0).alias("shared"))
               for name, s in sets.items()]
    if not matches:
        matches = [F.struct(F.lit("").alias("template"), F.lit(1).alias("size"), F.lit(0).alias("shared"))]
    rows = rows.select("id", "line_no", "unit_bigrams", F.explode(F.array(*matches)).alias("m"))
    dice = 2.0 * F.col("m.shared") / (F.col("unit_bigrams") + F.col("m.size"))
    units = rows.where(dice >= threshold).select(
        "id", "line_no", F.lit(None).cast("int").alias("first_word"), F.col("m.template").alias("template"), F.split_part(F.col("m.template"), F.lit("/"), F.lit(1)).alias("license"),
        F.col("m.shared").alias("shared"), "unit_bigrams", F.round(dice, 9).alias("dice"))
    return units.unionByName(window_matches(texts, sets, TEMPLATES if templates is None else templates, threshold))


def window_matches(texts: DataFrame, sets: dict[str, list[str]], templates: dict[str, str], threshold: float) -> DataFrame:
    """Matches of windows in the whole texts (``id, low``)."""
    anchors = {name: window_anchors(templates[name], threshold) for name in sets}
    every = sorted({b for _, places in anchors.values() for b in places})
    words = texts.select("id", F.split(normalise(F.col("low")), " ").alias("words")).where(F.size("words") > 1)
    rows = words.select("id", F.explode(F.array(bigrams(F.col("words")))).alias("row"))
    hit = lambda b, i: F.when(b.isin(every) if every else F.lit(False), F.struct(b.alias("b"), i.alias("i")))
    rows = rows.select("id", "row", F.explode(F.array(F.filter(F.transform("row", hit), lambda x: x.isNotNull()))).alias("hits"))
    rows = rows.where(F.size("hits") > 0)
    found = []
    for name, bag in sets.items():
        length, places = anchors[name]
        of = F.array(*[F.lit(b) for b in bag])
        place = F.create_map(*[F.lit(x) for item in places.items() for x in item])
        last = F.greatest(F.lit(0), F.size("row") - length)
        start = lambda x: F.greatest(F.lit(0), F.least(x["i"] - F.try_element_at(place, x["b"]), last))
        mine = F.filter("hits", lambda x: x["b"].isin(list(places)))
        starts = F.array_distinct(F.transform(mine, start))

        def window(s):
            part = F.slice("row", s + 1, F.lit(length))
            shared, size = F.size(F.array_intersect(part, of)), F.size(F.array_distinct(part))
            return F.struct(F.lit(name).alias("template"), F.lit(length).alias("length"), s.alias("first_word"), shared.alias("shared"),
                            size.alias("size"), (2.0 * shared / (size + len(bag))).alias("dice"))
        found.append(F.filter(F.transform(starts, window), lambda w: w["dice"] >= threshold))
    if not found:
        rows, found = rows.where(F.lit(False)), [F.array(F.struct(
            F.lit("").alias("template"), F.lit(0).alias("length"), F.lit(0).alias("first_word"), F.lit(0).alias("shared"),
            F.lit(0).alias("size"), F.lit(0.0).alias("dice")))]
    rows = rows.select("id", F.explode(F.array(F.concat(*found))).alias("found")).where(F.size("found") > 0)

    def beaten(w):
        return F.exists("found", lambda o: (o["template"] == w["template"])
                        & (F.abs(o["first_word"] - w["first_word"]) < w["length"])
                        & ((o["dice"] > w["dice"]) | ((o["dice"] == w["dice"]) & (o["first_word"] < w["first_word"]))))
    rows = rows.select("id", F.explode(F.filter("found", lambda w: ~beaten(w))).alias("w"))
    return rows.select(
        "id", F.lit(-2).alias("line_no"), "w.first_word", "w.template", F.split_part(F.col("w.template"), F.lit("/"), F.lit(1)).alias("license"),
        "w.shared", F.col("w.size").alias("unit_bigrams"), F.round("w.dice", 9).alias("dice"))


def op6_license_scan(spark, sf_dir):
    """Every licence match in the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).withColumnRenamed("id", "doc_id")


def op6_sql() -> str:
    values = ", ".join("('{}', ['{}'])".format(n, "', '".join(template_bigrams(t))) for n, t in TEMPLATES.items())
    places = ", ".join(f"('{n}', {length}, '{b}', {q})" for n, t in TEMPLATES.items()
                       for length, a in [window_anchors(t, THRESHOLD)] for b, q in a.items())
    return rf"""
WITH t(template, b) AS (VALUES {values}),
a(template, length, bigram, place) AS (VALUES {places}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS norm
  FROM documents
),
u AS (
  SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS unit FROM (SELECT doc_id, string_split(norm, chr(10)) AS l FROM d)
  UNION ALL
  SELECT doc_id, -1, replace(norm, chr(10), ' ') FROM d WHERE contains(norm, chr(10))
), w AS (
  SELECT doc_id, line_no, list_filter(string_split(unit, ' '), lambda x: x <> '') AS w FROM u
), b AS (
  SELECT doc_id, line_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS found FROM w WHERE len(w) > 1
), m AS (
  SELECT doc_id, line_no, template, len(list_intersect(found, t.b)) AS shared, len(found) AS unit_bigrams, len(t.b) AS size
  FROM b JOIN t ON list_has_any(found, t.b)
), dw AS (
  SELECT rid, doc_id, list_filter(string_split(replace(norm, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM d
), dr AS (
  SELECT rid, doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS r FROM dw WHERE len(w) > 1
), h AS (
  SELECT DISTINCT x.rid, a.template, a.length, greatest(0, least(x.i - a.place, greatest(0, x.n - a.length))) AS s
  FROM (SELECT rid, len(r) AS n, unnest(r) AS bigram, unnest(range(len(r))) AS i FROM dr) x JOIN a USING (bigram)
), c AS (
  SELECT h.rid, dr.doc_id, h.template, h.length, h.s, len(list_intersect(list_distinct(r[s + 1:s + length]), t.b)) AS shared,
         len(list_distinct(r[s + 1:s + length])) AS unit_bigrams, len(t.b) AS size
  FROM h JOIN dr USING (rid) JOIN t USING (template)
), p AS (
  SELECT *, 2.0::DOUBLE * shared / (unit_bigrams + size) AS dice FROM c WHERE 2.0::DOUBLE * shared / (unit_bigrams + size) >= 0.8::DOUBLE
)
SELECT doc_id, line_no, CAST(NULL AS INTEGER) AS first_word, template, split_part(template, '/', 1) AS license, shared, unit_bigrams,
       round(2.0::DOUBLE * shared / (unit_bigrams + size), 9) AS dice
FROM m WHERE 2.0::DOUBLE * shared / (unit_bigrams + size) >= 0.8
UNION ALL
SELECT doc_id, -2, CAST(s AS INTEGER), template, split_part(template, '/', 1), shared, unit_bigrams, round(dice, 9)
FROM p WHERE NOT EXISTS (
  SELECT 1 FROM p o WHERE o.rid = p.rid AND o.template = p.template AND abs(o.s - p.s) < p.length
    AND (o.dice > p.dice OR (o.dice = p.dice AND o.s < p.s)))"""

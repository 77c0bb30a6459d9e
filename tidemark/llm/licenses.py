"""License scans with built-in functions only.

The whole text (unit 0) and each of its lines (units 1, 2, ...) are normalised to
lower-case words. Licence templates are word-bigram sets; the Dice coefficient
2 * common / (n + m) of a unit and a template cannot reach `MIN_DICE` unless the smaller
set has at least `MIN_DICE / (2 - MIN_DICE)` of the larger one's size. That bound discards
units with too few words before their bigrams are built, then units of the wrong size, and
templates before they are compared.

Lines cut a wrapped licence, and a notice inside a longer line is diluted by its neighbours.
So passages are compared too: every window of consecutive words of the text, across lines,
of up to `MOST_WORDS` times a template's words. Per template the window of greatest
coefficient is taken at each start; of windows that overlap, the best one stays, and it is
told unless it touches a line (or stands in a whole text) already matched by that licence.
A passage must share `MIN_DICE / (2 - MIN_DICE)` of the template's bigrams. So a text is
searched only if it holds one of a few rare words without which too many bigrams are
missing, then only for templates of which it holds enough bigrams: neither test can lose a
passage.

Everything happens inside the row (no shuffle, nothing to skew).

Edge cases: null and empty texts, and units of fewer than two words, match nothing; equal
coefficients go to the first template name; repeated rows are judged one by one.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filled, table

MIN_DICE = 0.8
# everyday words, the last to be searched for
COMMON = frozenset("""0 1 2 3 4 a all an and any appear as associated author authors be by charge code
    conditions connection copies copy data direct following for form free from general granted hereby
    in included including into is it limited loss no not of on or other otherwise out particular
    performance person persons public regard rights released sell shall source special subject such
    terms that the this to under use version warranty whether whom with without work""".split())
MOST_WORDS = 1.5  # words of a passage, as a multiple of the template's

# Licence texts and notices, by SPDX name ("+" marks a whole licence).
TEMPLATES = {
    "ISC+": """Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT+": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        this software and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
        WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
        NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
        IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
               "version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_words(notice: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", notice.lower()).strip().split(" ")


def template_bigrams(notice: str) -> list[str]:
    w = template_words(notice)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def size_bounds(m: int, min_dice: float) -> tuple[int, int]:
    """Least and largest bigram count of a line that can reach `min_dice` with a template
    of `m` bigrams."""
    ratio = min_dice / (2 - min_dice)
    return math.ceil(m * ratio - 1e-9), math.floor(m / ratio + 1e-9)


def _templates(templates: dict[str, str], min_dice: float) -> Column:
    rows = []
    for name in sorted(templates):
        grams = template_bigrams(templates[name])
        low, high = size_bounds(len(grams), min_dice)
        rows.append(F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"),
                             F.lit(low).alias("low"), F.lit(high).alias("high")))
    return F.array(*rows)


def merged(bounds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of size ranges as few disjoint ones."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(bounds):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def line_matches(text: str | Column, templates: dict[str, str] = TEMPLATES,
                 min_dice: float = MIN_DICE) -> Column:
    """array<struct<line int, license string, dice double>>: the best template of every unit
    that reaches `min_dice`; 0 is the whole text, lines count from 1."""
    ranges = merged([size_bounds(len(template_bigrams(t)), min_dice) for t in templates.values()])
    low = ranges[0][0]
    known = _templates(templates, min_dice)

    def fits(size: Column) -> Column:
        out = F.lit(False)
        for a, b in ranges:
            out = out | size.between(a, b)
        return out

    # a unit with n distinct bigrams has more than n words, but repeats may hide any number
    # of them; units of few words leave here, the others when their bigrams are counted
    whole = filled(text)
    lines = F.transform(F.concat(F.array(whole), F.split(whole, "\n")), lambda line, i: F.struct(
        i.alias("line"),
        F.split(F.trim(F.regexp_replace(F.lower(line), "[^a-z0-9]+", " ")), " ").alias("words")))
    lines = F.filter(lines, lambda x: F.size(x["words"]) > low)
    lines = F.transform(lines, lambda x: F.struct(
        x["line"].alias("line"),
        F.array_distinct(F.zip_with(
            F.slice(x["words"], 1, F.size(x["words"]) - 1),
            F.slice(x["words"], 2, F.size(x["words"]) - 1),
            lambda a, b: F.concat_ws(" ", a, b))).alias("grams")))
    lines = F.filter(lines, lambda x: fits(F.size(x["grams"])))

    def best(x: Column) -> Column:
        near = F.filter(known, lambda t: F.size(x["grams"]).between(t["low"], t["high"]))
        scored = F.transform(near, lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(x["grams"], t["grams"]))
             / (F.size(x["grams"]) + F.size(t["grams"]))).alias("less"), t["name"].alias("name")))
        top = F.array_min(scored)
        return F.struct(x["line"].alias("line"), top["name"].alias("license"),
                        (-top["less"]).alias("dice"))

    return F.filter(F.transform(lines, best), lambda m: m["dice"] >= min_dice)


def least_common(m: int, min_dice: float) -> int:
    """Fewest bigrams of a template of `m` that a window reaching `min_dice` holds."""
    return math.ceil(m * min_dice / (2 - min_dice) - 1e-9)


def needed_words(templates: dict[str, str], min_dice: float) -> list[str]:
    """Words of which a text with a passage of any template holds at least one: for each
    template, without them too few of its bigrams are left. Words of few templates first,
    long ones first, everyday words last."""
    spread: dict[str, int] = {}
    for t in templates.values():
        for w in set(template_words(t)):
            spread[w] = spread.get(w, 0) + 1
    out: set[str] = set()
    for t in templates.values():
        left = {tuple(g.split(" ")) for g in template_bigrams(t)}
        least = least_common(len(left), min_dice)
        left = {g for g in left if not out & set(g)}
        for w in sorted(set(template_words(t)), key=lambda x: (x in COMMON, spread[x], -len(x), x)):
            if len(left) < least:
                break
            out.add(w)
            left = {g for g in left if w not in g}
    return sorted(out)


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    return F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                      lambda a, b: F.concat_ws(" ", a, b))


def _with(value: Column, f) -> Column:
    """`f` of the value, which is computed once however often `f` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def passage_matches(text: str | Column, templates: dict[str, str] = TEMPLATES,
                    min_dice: float = MIN_DICE) -> Column:
    """array<struct<first int, last int, license string, dice double>>: disjoint windows of
    consecutive words that reach `min_dice`, by their first word; lines count from 1."""
    whole = filled(text)
    rows = []
    for name in sorted(templates):
        grams = template_bigrams(templates[name])
        most = math.floor(MOST_WORDS * len(template_words(templates[name])) + 1e-9) - 1
        rows.append(F.struct(
            F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"),
            F.lit(least_common(len(grams), min_dice)).alias("least"), F.lit(most).alias("most")))
    known = F.array(*rows)
    every = F.array(*map(F.lit, sorted({g for t in templates.values() for g in template_bigrams(t)})))

    def windows(t: Column, grams: Column) -> Column:
        """The best window of the template at each of its bigrams in the text."""
        def at(i: Column) -> Column:
            seen = _with(F.slice(grams, i, t["most"]), lambda near: F.transform(
                near, lambda gram, k: F.struct(  # a repeat counts once
                    (F.array_position(near, gram) == k + 1).alias("new"),
                    F.array_contains(t["grams"], gram).alias("shared"), (i + k + 1).alias("end"))))

            def step(acc: Column, x: Column) -> Column:
                n = acc["n"] + x["new"].cast("int")
                c = acc["c"] + (x["new"] & x["shared"]).cast("int")
                dice = 2.0 * c / (n + F.size(t["grams"]))
                return F.struct(n.alias("n"), c.alias("c"), F.least(acc["best"], F.struct(
                    (-dice).alias("less"), x["end"].alias("end"))).alias("best"))
            return F.aggregate(
                seen, F.struct(F.lit(0).alias("n"), F.lit(0).alias("c"), F.struct(
                    F.lit(0.0).alias("less"), F.lit(0).alias("end")).alias("best")), step,
                lambda acc: F.struct(acc["best"]["less"].alias("less"), t["name"].alias("license"),
                                     i.alias("start"), acc["best"]["end"].alias("end")))
        starts = F.filter(F.sequence(F.lit(1), F.size(grams)),
                          lambda i: F.array_contains(t["grams"], F.element_at(grams, i)))
        return F.filter(F.transform(starts, at), lambda x: -x["less"] >= min_dice)

    def search(grams: Column) -> Column:
        near = _with(F.array_intersect(grams, every), lambda present: F.filter(
            known, lambda t: F.size(F.array_intersect(present, t["grams"])) >= t["least"]))
        return F.array_sort(F.flatten(F.transform(near, lambda t: windows(t, grams))))

    none = "array<struct<less:double,license:string,start:int,end:int>>"
    words = _words(whole)
    maybe = F.arrays_overlap(words, F.array(*map(F.lit, needed_words(templates, min_dice))))
    kept = F.aggregate(
        _with(_with(words, _bigrams), search), F.array().cast(none),
        lambda acc, x: F.when(F.exists(acc, lambda y: (x["start"] <= y["end"])
                                       & (y["start"] <= x["end"])), acc)
        .otherwise(F.concat(acc, F.array(x))))
    # the line of every word
    line = F.flatten(F.transform(F.split(whole, "\n"), lambda x, i: F.transform(
        F.filter(_words(x), lambda w: w != ""), lambda _: i + 1)))
    told = _with(kept, lambda k: F.when(F.size(k) > 0, _with(line, lambda at: F.transform(
        F.array_sort(F.transform(k, lambda x: F.struct(x["start"], x["end"], x["license"], -x["less"]))
                     .cast("array<struct<start:int,end:int,license:string,dice:double>>")),
        lambda x: F.struct(F.element_at(at, x["start"]).alias("first"),
                           F.element_at(at, x["end"]).alias("last"), x["license"], x["dice"])))))
    empty = F.array().cast("array<struct<first:int,last:int,license:string,dice:double>>")
    return F.coalesce(F.when(maybe, told), empty)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole text of `documents`, one row per document. In `matches`
    units are told by their number, passages by their first and last line (`3-9:MIT+`)."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", line_matches("text").alias("u"), passage_matches("text").alias("p"))
    more = F.filter("p", lambda p: ~F.exists("u", lambda u: (u["license"] == p["license"]) & (
        (u["line"] == 0) | u["line"].between(p["first"], p["last"]))))

    def told(unit: Column, x: Column) -> Column:
        return F.struct(x["license"].alias("license"), x["dice"].alias("dice"), unit.alias("unit"))
    found = found.select("doc_id", F.concat(
        F.transform("u", lambda x: told(x["line"].cast("string"), x)),
        F.transform(more, lambda x: told(F.concat_ws("-", x["first"], x["last"]), x))).alias("m"))
    top = F.array_min(F.transform("m", lambda x: F.struct((-x["dice"]).alias("less"),
                                                          x["license"].alias("name"))))
    return found.select(
        "doc_id", F.size("m").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(
            F.transform("m", lambda x: x["license"]))), ",").alias("licenses"),
        top["name"].alias("best_license"), F.round(-top["less"], 6).alias("best_dice"),
        F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["unit"], x["license"])),
                     ",").alias("matches"))


def _oracle() -> str:
    values = []
    for name in sorted(TEMPLATES):
        grams = template_bigrams(TEMPLATES[name])
        low, high = size_bounds(len(grams), MIN_DICE)
        listed = ", ".join(f"'{g}'" for g in grams)
        values.append(f"('{name}', [{listed}], {low}, {high})")
    rows = ",\n    ".join(values)
    return f"""
WITH known(license, grams, low, high) AS (VALUES
    {rows}),
docs AS (SELECT doc_id, row_number() OVER () AS rid,
                list_concat([coalesce(text, '')], string_split(coalesce(text, ''), chr(10))) AS lines
         FROM documents),
lines AS (SELECT rid, i - 1 AS line, string_split(trim(regexp_replace(lower(lines[i]),
                 '[^a-z0-9]+', ' ', 'g')), ' ') AS words
          FROM docs, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)),
grams AS (SELECT rid, line, list_distinct(list_transform(range(1, len(words)),
                 lambda i: words[i] || ' ' || words[i + 1])) AS g
          FROM lines WHERE len(words) >= 2),
scored AS (SELECT rid, line, license,
                  2.0 * len(list_intersect(g, grams))::DOUBLE / (len(g) + len(grams)) AS dice
           FROM grams JOIN known ON len(g) BETWEEN low AND high),
best AS (SELECT rid, line, arg_min(license, (-dice, license)) AS license, max(dice) AS dice
         FROM scored WHERE dice >= {MIN_DICE} GROUP BY rid, line),
summed AS (SELECT rid, count(*) AS n_matches,
                  string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                  arg_min(license, (-dice, license)) AS best_license,
                  round(max(dice), 6) AS best_dice,
                  string_agg(line || ':' || license, ',' ORDER BY line) AS matches
           FROM best GROUP BY rid)
SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses,
       best_license, best_dice, coalesce(matches, '') AS matches
FROM docs LEFT JOIN summed USING (rid)
"""


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLE_SQL = {"op4_license_scan": _oracle()}

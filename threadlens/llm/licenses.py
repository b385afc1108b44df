"""Licence scans: the Dice coefficient over word bigrams against licence templates.

Units of a text are its lines, its paragraphs of several lines, and the whole
text, normalised to lower-case words of letters and digits.  A unit with a
bigrams and a template with b share at least t (a + b) / 2 of them, so only
templates with t / (2 - t) <= a / b <= (2 - t) / t are compared, and units
outside the bounds of all templates, without any of a few words of which every
similar unit holds one, or without any template's bigram, leave before that.  Bigrams count as often as they occur.  Everything is an
expression over one row: nothing is shuffled.

Defined cases: a null or empty text has no units and no licence; units that
repeat in a text count once; of two templates with equal figures both are
reported; repeated rows are scanned alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least Dice coefficient of a match, in hundredths.
PERCENT = 80

# Notices and opening terms of common licences, under their SPDX names.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "Licensed under the GNU General Public License, version 2."),
    ("GPL", "Licensed under the GNU General Public License, version 3."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("BSD", "Licensed under the BSD License."),
    ("BSD", "Is licensed under the BSD License."),
    ("BSD", "Licensed under the BSD 2-Clause License."),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Is licensed under the ISC License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)


def template_grams() -> list[tuple[str, Counter]]:
    """(name, bigrams with counts) of every template."""
    out = []
    for name, text in TEMPLATES:
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        out.append((name, Counter(f"{a} {b}" for a, b in zip(words, words[1:]))))
    return out


def anchor_words(percent: int = PERCENT) -> list[str]:
    """Words of which every similar unit holds one.

    A similar unit shares at least t / (2 - t) of a template's bigrams.  Words
    are taken, those in most open bigrams first, until the bigrams with a
    chosen word are more than the rest of every template.
    """
    chosen: list[str] = []
    while True:
        left: Counter = Counter()
        for _, grams in template_grams():
            held = sum(k for g, k in grams.items() if set(g.split()) & set(chosen))
            if held * (200 - percent) <= sum(grams.values()) * (200 - 2 * percent):
                for g, k in grams.items():
                    for w in set(g.split()) - set(chosen):
                        if not set(g.split()) & set(chosen):
                            left[w] += k * (1000 if len(w) > 5 else 1)  # long words are rare in prose
        if not left:
            return sorted(chosen)
        chosen.append(min(left, key=lambda w: (-left[w], w)))


def units(text: Column) -> Column:
    """Distinct normalised units of a text, words separated by one space."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    lines = F.split(plain, "\n")
    joined = F.concat(F.filter(F.split(plain, "\n *\n"), lambda p: F.contains(p, F.lit("\n"))), F.array(plain))
    joined = F.transform(joined, lambda p: F.regexp_replace(p, "[ \n]+", " "))
    return F.array_distinct(F.transform(F.concat(lines, joined), lambda u: F.trim(u)))


def _grams(unit: Column) -> Column:
    words = F.split(unit, " ")
    n = F.size(words) - 1
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def scan(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with ``_found``: array of (name, dice, bigrams) of the units and templates that match."""
    grams = template_grams()
    sizes = [sum(c.values()) for _, c in grams]
    low, high = percent / (200 - percent) * min(sizes), (200 - percent) / percent * max(sizes)
    every = F.array(*[F.lit(g) for g in sorted({g for _, c in grams for g in c})])
    spaces = lambda u: F.length(u) - F.length(F.replace(u, F.lit(" "), F.lit("")))
    anchors = anchor_words(percent)
    anchored = lambda u: reduce(or_, [F.contains(u, F.lit(w)) for w in anchors])
    fitting = F.filter(units(F.col("text")), lambda u: spaces(u).between(low, high) & anchored(u))
    maybe = F.filter(F.transform(fitting, _grams), lambda g: F.arrays_overlap(g, every))
    # most texts hold no anchor and aren't cut up
    maybe = F.when(anchored(F.lower(F.col("text"))), maybe).otherwise(F.array().cast("array<array<string>>"))

    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(size).alias("size"), F.array(*[F.struct(F.lit(g).alias("g"), F.lit(k).alias("k")) for g, k in own.items()]).alias("grams"))
        for (name, own), size in zip(grams, sizes)])

    def compare(unit: Column):
        def with_template(t: Column) -> Column:
            n, size = F.size(unit), t["size"]
            fits = (n * (200 - percent) >= percent * size) & (n * percent <= (200 - percent) * size)
            shared = F.aggregate(t["grams"], F.lit(0), lambda a, g: a + F.least(g["k"], F.size(F.filter(unit, lambda x: x == g["g"]))))
            return F.struct(t["name"].alias("name"), F.when(fits, 2 * shared / (n + size)).otherwise(F.lit(0.0)).alias("dice"), n.alias("bigrams"))

        return F.transform(table, with_template)

    rows = docs.withColumn("_units", maybe)
    nothing = F.array().cast("array<struct<name:string,dice:double,bigrams:int>>")
    found = F.when(F.size("_units") > 0, F.filter(F.flatten(F.transform("_units", compare)), lambda m: m["dice"] * 100 >= percent)).otherwise(nothing)
    return rows.withColumn("_found", found).drop("_units")


def op6_license_dice(docs: DataFrame) -> DataFrame:
    """doc_id, matching units and templates, licence names (ascending, comma-joined) and the best coefficient of every document."""
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", F.size("_found").cast("long").alias("n_matches"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("_found", lambda m: m["name"])))).alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("_found", lambda m: m["dice"])), F.lit(0.0)), 6).alias("dice"))


def _sql() -> str:
    rows = [f"({t}, '{name}', {sum(own.values())}, '{g}', {k})" for t, (name, own) in enumerate(template_grams()) for g, k in own.items()]
    return rf"""
WITH tg(t, name, size, g, k) AS (VALUES {", ".join(rows)}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS plain FROM documents),
u AS (SELECT r, unnest(list_distinct(list_transform(
        string_split(plain, chr(10)) || list_transform(
          list_filter(regexp_split_to_array(plain, '\n *\n'), lambda p: contains(p, chr(10))) || [plain],
          lambda p: regexp_replace(p, '[ \n]+', ' ', 'g')), lambda x: trim(x)))) AS unit FROM d),
w AS (SELECT r, row_number() OVER () AS id, string_split(unit, ' ') AS words FROM u WHERE unit LIKE '% %'),
g AS (SELECT r, id, len(words) - 1 AS n, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS g FROM w),
c AS (SELECT r, id, n, g, count(*) AS k FROM g GROUP BY ALL),
m AS (SELECT r, id, n, t, name, size, sum(least(c.k, tg.k))::INTEGER AS shared FROM c JOIN tg USING (g) GROUP BY r, id, n, t, name, size),
f AS (SELECT r, name, 2 * shared / (n + size)::DOUBLE AS dice FROM m WHERE 2 * shared / (n + size)::DOUBLE * 100 >= {PERCENT}),
a AS (SELECT r, count(*) AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(dice) AS dice FROM f GROUP BY r)
SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses, round(coalesce(dice, 0.0), 6)::DOUBLE AS dice
FROM d LEFT JOIN a USING (r)
"""


OP6_SQL = _sql()

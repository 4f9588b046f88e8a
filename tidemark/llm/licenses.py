"""Licence scan: Dice coefficient over word bigrams against templates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rules import let

#: Least Dice coefficient of a match.
THRESHOLD = 0.8

# Public licence statements and notices, by SPDX name.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ),
    ("BSD-3-Clause", "Licensed under the 3-clause BSD License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


# Notices of further licences and versions, which `statements` are compared with as well.
NOTICES: tuple[tuple[str, str], ...] = TEMPLATES + (
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("BSD-2-Clause", "Licensed under the 2-clause BSD License."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public "
        "domain worldwide.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def normalised(text: Column) -> Column:
    """Lower case, with every run of other signs than letters and digits, but line breaks, as one space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def word_pairs(passage: Column) -> Column:
    """Pairs of neighbouring words of a normalised passage, in order."""
    words = F.filter(F.split(passage, r"[ \n]+"), lambda w: w != "")
    pairs = lambda w: F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(w[i], F.lit(" "), w[i + 1])))
    return let(words, lambda w: F.coalesce(pairs(w), F.array().cast("array<string>")))


def bigrams(passage: Column) -> Column:
    """Different pairs of neighbouring words of a normalised passage."""
    return F.array_distinct(word_pairs(passage))


def template_bigrams(templates: tuple[tuple[str, str], ...]) -> list[tuple[str, list[str]]]:
    out = []
    for name, text in templates:
        words = "".join(c.lower() if c.isalnum() else " " for c in text).split()
        out.append((name, list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))))
    return out


def needed_pairs(table: list[tuple[str, list[str]]], threshold: float = THRESHOLD) -> list[list[str]]:
    """For each template the pairs without which a text is not it.

    Those that end in a number, and those that templates of other licences lack
    which are as much like it as a match.
    """
    out = []
    for name, mine in table:
        like = [b for other, b in table if other != name and 2 * len({*mine} & {*b}) >= threshold * (len(mine) + len(b))]
        out.append([p for p in mine if any(c.isdigit() for c in p.split(" ")[1]) or any(p not in b for b in like)])
    return out


def license_statements(text: Column, templates: tuple[tuple[str, str], ...] = NOTICES, threshold: float = THRESHOLD) -> Column:
    """Array of ``license`` and ``dice``, by name, of the licences stated anywhere in a normalised text.

    A window is a run of neighbouring word pairs, up to the most different ones
    that reach ``threshold`` with the template; it may begin and end inside a line and go over lines. It
    states a licence if the Dice coefficient of its different pairs reaches
    ``threshold`` and it has the template's :func:`needed_pairs`, so that another
    version is no match. ``dice`` is the licence's best. The best window begins and ends with a
    pair of the template, so only these are tried, and only where a text has enough of them.
    """
    table = [(name, pairs) for name, pairs in template_bigrams(templates) if pairs]
    rows = []
    for (name, pairs), needed in zip(table, needed_pairs(table, threshold), strict=True):
        least = math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9)
        most = math.floor(len(pairs) * (2 - threshold) / threshold + 1e-9)
        strings = lambda x: F.array(*map(F.lit, x)).cast("array<string>")
        rows.append(F.struct(F.lit(name).alias("name"), strings(pairs).alias("pairs"), strings(needed).alias("needed"), F.lit(least).alias("least"), F.lit(most).alias("most")))
    every = F.array(*map(F.lit, dict.fromkeys(p for _, pairs in table for p in pairs)))

    def window(p: Column, t: Column, i: Column, j: Column) -> Column:
        dice = lambda w: F.size(F.array_intersect(w, t["pairs"])) * 2.0 / (F.size(w) + F.size(t["pairs"]))
        return let(F.array_distinct(F.slice(p, i + 1, j - i + 1)), lambda w: F.when(F.size(F.array_except(t["needed"], w)) == 0, dice(w)))

    def best(p: Column, t: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: F.array_contains(t["pairs"], F.get(p, i)))
        # fewer places than ``least`` are no match
        ends = lambda at, i, k: F.filter(F.slice(at, k + t["least"], t["most"]), lambda j: j < i + t["most"])
        starts = lambda at: F.transform(at, lambda i, k: F.array_max(F.transform(ends(at, i, k), lambda j: window(p, t, i, j))))
        return let(places, lambda at: F.array_max(starts(at)))

    def of(p: Column) -> Column:
        enough = lambda seen, t: (F.size(F.array_intersect(t["pairs"], seen)) >= t["least"]) & (F.size(F.array_except(t["needed"], seen)) == 0)
        likely = let(F.array_intersect(p, every), lambda seen: F.filter(F.array(*rows), lambda t: enough(seen, t)))
        return F.filter(F.transform(likely, lambda t: F.struct(t["name"].alias("license"), best(p, t).alias("dice"))), lambda x: x["dice"] >= threshold)

    top = lambda found: F.filter(found, lambda x: ~F.exists(found, lambda y: (x["license"] == y["license"]) & (x["dice"] < y["dice"])))
    return let(let(word_pairs(text), of), lambda found: F.array_sort(F.array_distinct(top(found))))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    notices: tuple[tuple[str, str], ...] = NOTICES,
) -> DataFrame:
    """``id_col``, ``license``, ``dice``, ``n_passages`` and ``statements`` of every row.

    Passages are the lines of a text and, where a text has blank lines, the
    paragraphs between them of more than one line. A passage's different word
    pairs are compared with those of each template whose size allows a Dice
    coefficient of ``threshold``: with a pairs here and b there, that is
    ``t b <= (2 - t) a`` and the other way round. ``dice`` is the best
    coefficient of at least ``threshold`` in the text and ``license`` its
    template's name (of equals the last by name); both are null if there is
    none. ``n_passages`` counts the passages that match. ``statements`` are all
    :func:`license_statements` of the text, inside lines and over them too; they
    are compared with ``notices`` and worked out only if the column is read. Null and empty texts
    match nothing; rows with null or repeated ids are rows like any other; other
    columns are not read. Everything is one projection: the templates, a list of
    fixed size, are constants in it.
    """
    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, pairs)).alias("pairs")) for name, pairs in template_bigrams(templates) if pairs
    ])
    least = min(len(pairs) for _, pairs in template_bigrams(templates) if pairs) * threshold / (2 - threshold)

    def best(mine: Column) -> Column:
        a = F.size(mine)
        near = F.filter(table, lambda t: (F.size(t["pairs"]) * threshold <= (2 - threshold) * a) & (a * threshold <= (2 - threshold) * F.size(t["pairs"])))
        dice = lambda t: F.size(F.array_intersect(mine, t["pairs"])) * 2.0 / (a + F.size(t["pairs"]))
        return F.array_max(F.transform(near, lambda t: F.struct(dice(t).alias("dice"), t["name"].alias("name"))))

    text = normalised(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    parts = lambda x: F.concat(
        F.split(x, "\n"), F.filter(F.split(x, r"\n *\n[ \n]*"), lambda p: F.rtrim(p).contains("\n") & x.rlike(r"\n *\n"))
    )
    # an upper bound of the number of pairs, before any is made
    roomy = lambda p: F.length(p) - F.length(F.translate(p, " \n", "")) >= F.lit(least) - 1
    passages = let(text, lambda x: F.filter(parts(x), roomy))
    scored = F.filter(F.transform(F.transform(passages, bigrams), best), lambda s: s["dice"] >= threshold)
    found = docs.select(
        F.col(id_col),
        let(scored, lambda s: F.struct(F.array_max(s).alias("best"), F.size(s).cast("long").alias("n"))).alias("_s"),
        license_statements(text, notices, threshold).alias("statements"),
    )
    return found.select(id_col, F.col("_s.best.name").alias("license"), F.col("_s.best.dice").alias("dice"), F.col("_s.n").alias("n_passages"), "statements")

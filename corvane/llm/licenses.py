"""Licence scanning by the Dice coefficient over word bigrams, with DataFrame functions only.

Units of a text, its lines and its paragraphs (runs of lines between blank ones), are
normalised and compared to licence templates: ``2 |A n B| / (|A| + |B|)`` of the sets of
word bigrams. With ``d`` the least likeness, sizes must satisfy ``min / max >= d / (2 - d)``,
so most units are dropped by their number of words before a bigram is made, and each of
the others meets only the templates of a fitting size. All of it happens inside a row:
nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

LEAST_DICE = 0.8

# Licence ids and the notices or texts they are known by.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                   "file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
                "of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Proprietary", "All rights reserved."),
]


def template_words(text: str) -> list[str]:
    """Lower-case words of letters and digits, as ``_words`` makes them."""
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    """Distinct word pairs side by side; words are at least two."""
    return F.array_distinct(F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.concat_ws(" ", a, b)))


def units(text: Column) -> Column:
    """Distinct lines and paragraphs of a text."""
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n")))


def scan(docs: DataFrame, least_dice: float = LEAST_DICE,
         templates: list[tuple[str, str]] | None = None, text: str = "text") -> DataFrame:
    """(doc_id, license, dice, licenses, n_matches) of each row of ``docs``.

    ``license`` and ``dice`` are of the most alike template, the first by id of equal ones;
    null and 0 without a match. ``licenses`` lists every matched id in order, comma-joined;
    ``n_matches`` counts the units that match a template. Null, empty and repeated rows
    are rows like others.
    """
    known = [(name, template_bigrams(body)) for name, body in templates or TEMPLATES]
    if any(not grams for _, grams in known):
        raise ValueError("a template needs two words")
    ratio = least_dice / (2 - least_dice)
    least = min(len(g) for _, g in known) * ratio
    # A unit has fewer distinct bigrams than words: units of too few words go unseen.
    body = F.coalesce(F.col(text), F.lit(""))
    worded = F.filter(F.transform(units(body), _words), lambda w: F.size(w) > least)
    every = F.array(*[F.lit(g) for g in sorted({g for _, grams in known for g in grams})])
    grams = F.filter(F.transform(worded, _bigrams), lambda g: F.arrays_overlap(g, every))
    number = {}
    for i, (name, gram) in enumerate(known):
        number.setdefault(len(gram), []).append((i, name, gram))

    def best(g: Column) -> Column:
        """(dice, name) of the most alike template of a fitting size, dice 0 without one."""
        found = F.array(*[
            F.struct(
                F.when((F.size(g) >= size * ratio) & (F.size(g) * ratio <= size),
                       2.0 * F.size(F.array_intersect(g, F.array(*[F.lit(x) for x in gram])))
                       / (F.size(g) + size)).otherwise(0.0).alias("dice"),
                F.lit(name).alias("name"))
            for size, group in number.items() for _, name, gram in group])
        return F.reduce(found, F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("name")),
                        lambda a, b: F.when((b["dice"] > a["dice"])
                                            | ((b["dice"] == a["dice"]) & (b["name"] < a["name"])), b)
                        .otherwise(a))

    hits = F.filter(F.transform(grams, best), lambda h: h["dice"] >= least_dice)
    top = F.array_sort("hits", lambda a, b: F.when(a["dice"] > b["dice"], -1)
                       .when(a["dice"] < b["dice"], 1).when(a["name"] < b["name"], -1)
                       .when(a["name"] > b["name"], 1).otherwise(0))
    return (docs.select("doc_id", hits.alias("hits")).withColumn("hits", top)
            .select("doc_id", F.get("hits", F.lit(0))["name"].alias("license"),
                    F.round(F.coalesce(F.get("hits", F.lit(0))["dice"], F.lit(0.0)), 6).alias("dice"),
                    F.array_join(F.sort_array(F.array_distinct(F.transform(
                        "hits", lambda h: h["name"]))), ",").alias("licenses"),
                    F.size("hits").cast("bigint").alias("n_matches")))

"""License scans: notices are found by MinHash bands over text windows and verified by their word shingles.

A template's shingles are cut into windows of WINDOW shingles, a text's too, at every position. A window's signature
under a hash function is its smallest value. A template of which 80 % of the shingles stand in a text has WINDOW
shingles in a row there that are untouched (else more than one in WINDOW would be missing), so one window is equal
and meets in every band: with windows at every position the collision is certain, not only likely.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
WINDOW = 4
# Bands of one row each: seeds of their hash functions.
BANDS = (11, 23)
CONTAINED = 0.8
# Notices by which licenses name themselves.
TEMPLATES = {
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
    "General Public License as published by the Free Software Foundation, either version 3 of the License",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def words_column(text: Column) -> Column:
    """Runs of letters, digits and signs beyond ASCII, lower-cased; none for NULL."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def anchors(templates: list[list[str]]) -> list[str]:
    """A few words of which every text that can match holds one.

    A match leaves SHINGLE + WINDOW - 1 words of its template in a row untouched (all words of a shorter template).
    Chosen greedily: the word that stands in most of these runs not yet covered, long words first.
    """
    reach = SHINGLE + WINDOW - 1
    runs = [set(t[i : i + reach]) for t in templates if t for i in range(max(1, len(t) - reach + 1))]
    out: list[str] = []
    while runs:
        count: dict[str, int] = {}
        for run in runs:
            for w in run:
                count[w] = count.get(w, 0) + 1
        best = max(count, key=lambda w: (len(w) > 6, count[w], len(w), w))
        out.append(best)
        runs = [run for run in runs if best not in run]
    return out


def shingles_column(words: Column, n: int = SHINGLE) -> Column:
    """Hashes of the n-word shingles, in order; none for fewer than n words."""
    out = F.transform(words, lambda w: F.xxhash64(w))
    size = F.greatest(F.size(words) - (n - 1), F.lit(0))
    first = F.slice(out, F.lit(1), size)
    for i in range(1, n):
        first = F.zip_with(first, F.slice(out, F.lit(i + 1), size), lambda a, b: F.xxhash64(a, b))
    return first


def signatures_column(shingles: Column, seed: int, width: int) -> Column:
    """Smallest value of every window of ``width`` shingles under one hash function."""
    h = F.transform(shingles, lambda x: F.xxhash64(x, F.lit(seed))) if width > 1 else shingles
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        size = F.greatest(F.size(h) - step, F.lit(0))
        h = F.zip_with(F.slice(h, F.lit(1), size), F.slice(h, F.lit(step + 1), size), lambda a, b: F.least(a, b))
        reach += step
    return h


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = [(name, words(text)) for name, text in templates.items()]
    return spark.createDataFrame(rows, "name string, words array<string>")


def _literals(df: DataFrame, column: Column) -> list[int]:
    """Distinct values out of the template table, which is as small as the list of templates."""
    return sorted({x for (xs,) in df.select(column).collect() for x in xs})


def scan(docs: DataFrame, templates: dict[str, str] | None = None, contained: float = CONTAINED) -> DataFrame:
    """Every row and column of ``docs`` with ``licenses``: structs (name, containment) of the notices in its whole
    text, sorted by name; an empty array where there are none, and for NULL, empty and short texts.

    Containment is the share of a template's distinct five-word shingles that the text has; ``contained`` of them
    must be there (above 0.75, or the windows would not guarantee retrieval). Templates of fewer than five words are
    their own only shingle and must occur as a whole; of fewer than WINDOW shingles, every shingle is a window.
    Repeated rows are judged alike. A column named licenses is replaced.
    """
    plain = docs.drop("licenses")
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates)
    shape = known.select("name", F.array_distinct(shingles_column(F.col("words"))).alias("h"), "words")
    made = shape.select("name", "words", "h", shingles_column(F.col("words")).alias("all")).collect()
    narrow = sorted({x for r in made if 0 < len(r.all) < WINDOW for x in r.all})
    wide = known.filter(F.size("words") >= SHINGLE + WINDOW - 1)
    bands = {s: _literals(wide, signatures_column(shingles_column(F.col("words")), s, WINDOW)) for s in BANDS}
    phrases = {r.name: " ".join(r.words) for r in made if 0 < len(r.words) < SHINGLE}

    low = F.lower("text")
    anchored = F.lit(False)
    for word in anchors([r.words for r in made]):
        anchored = anchored | low.contains(word)
    nothing = F.array().cast("array<string>")
    # Texts without an anchor cannot match and are not cut into words.
    cut = F.when(F.coalesce(anchored, F.lit(False)), words_column(F.col("text"))).otherwise(nothing)
    out = _settled(plain.select(F.struct("*").alias("row"), cut.alias("__words")))
    out = _settled(out.select("row", "__words", shingles_column(F.col("__words")).alias("__h")))
    within = lambda values: lambda x: x.isin(values)
    retrieved = F.exists("__h", within(narrow)) if narrow else F.lit(False)
    for seed, values in bands.items():
        if values:
            retrieved = retrieved | F.exists(signatures_column(F.col("__h"), seed, WINDOW), within(values))
    out = _settled(out.select("row", "__words", F.when(retrieved, F.array_distinct("__h")).alias("__distinct")))
    found = []
    for r in made:
        if r.h:
            both = F.size(F.array_intersect("__distinct", F.array(*[F.lit(x) for x in r.h])))
            share = F.when(F.col("__distinct").isNotNull(), both / len(r.h)).otherwise(0.0)
            found.append(F.when(share >= contained - 1e-9, F.struct(F.lit(r.name).alias("name"), share.alias("containment"))))
    text = F.concat(F.lit(" "), F.array_join("__words", " "), F.lit(" "))
    for name, phrase in phrases.items():
        found.append(F.when(text.contains(f" {phrase} "), F.struct(F.lit(name).alias("name"), F.lit(1.0).alias("containment"))))
    out = _settled(out.select("row", F.array_sort(F.array_compact(F.array(*found))).alias("licenses")))
    return out.select("row.*", "licenses")


def _settled(df: DataFrame) -> DataFrame:
    """The same rows, with every column worked out before a later step uses it.

    Without it the optimizer would put each step into every place of the next that names it, and a filter on the
    result would repeat the whole of it many times over. It does not reach below a generator, here one that yields the
    row itself.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))

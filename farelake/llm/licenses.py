"""License scan: MinHash bands over overlapping text windows find templates, exact shingle containment verifies them.

Everything is DataFrame functions. A text is its words (letters and digits, lower case); a template of n words has its
5-word shingles, or its whole sequence if it is shorter. A document holds a template if some window of it contains 0.8 or
more of the template's shingles.

Windows. For each template length n there are windows of n words and a quarter and a fifth more, beginning at each quarter
(short templates: n words, at each word), so that an occurrence lies whole in one of them. A window that holds a match
has, at the worst of all template lengths, Jaccard similarity 0.47 with the template (``worst_similarity``). With 32 bands
of two rows it then shares a band with a probability of over 0.9996; short templates need all their shingles, a similarity
of 1.

Where windows begin. To miss at most a fifth of its shingles, an occurrence must hold one of a few words that together lie
in more than a fifth of the template's shingles (``needed_words``). Only windows around such words are built: this loses no
match.

Edge cases: null and empty texts hold nothing; documents with equal id and text are one document; a null id is kept; a
template without words is left out; an empty table or an empty list of templates gives an empty result; only doc_id and
text are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .common import KEY, keyed

SHINGLE = 5
CONTAINMENT = 0.8
BANDS, ROWS = 32, 2

# Notices of public licenses.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at"),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def shingles_of(words: list[str], size: int = SHINGLE) -> list[str]:
    size = min(size, len(words))
    return sorted({" ".join(words[at:at + size]) for at in range(len(words) - size + 1)})


def window_of(words: int) -> tuple[int, int]:
    """(length, step) of the windows for templates of so many words."""
    slack = words // 4 if words > 7 else 0
    return words + slack + (words // 5 if words > 7 else 0), slack + 1


def worst_similarity(words: int) -> float:
    """Smallest Jaccard similarity of a template of so many words and a window that holds a match of it."""
    own = max(words - SHINGLE + 1, 1)
    shared = math.ceil(CONTAINMENT * own)
    return shared / (own + max(window_of(words)[0] - SHINGLE + 1, 1) - shared)


def needed_words(words: list[str]) -> set[str]:
    """Words of which every match has at least one: together they are in more shingles than a match may miss."""
    shingles = [set(shingle.split(" ")) for shingle in shingles_of(words)]
    may_miss = len(shingles) - math.ceil(CONTAINMENT * len(shingles))
    chosen: set[str] = set()
    # Long words are rare in texts. Ties in alphabetical order.
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(bool(chosen & shingle) for shingle in shingles) > may_miss:
            break
        chosen.add(word)
    return chosen


def _shingles(words: Column, size: int) -> Column:
    """Distinct shingles of an array of words."""
    count = F.greatest(F.size(words) - (size - 1), F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), count), lambda at: F.array_join(F.slice(words, at, size), " ")))


def _bands(shingles: Column) -> Column:
    """One number per band: the hash of its rows' smallest hashes."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    smallest = F.transform(F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), lambda row: F.array_min(
        F.transform(hashes, lambda h: F.xxhash64(h, row))))
    return F.transform(F.array(smallest), lambda rows: F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.xxhash64(
        band, *(rows[band * ROWS + at] for at in range(ROWS)))))[0]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, containment, first_word, windows) of every document and template that it holds.

    ``containment`` is that of the best window, ``first_word`` the first word of the first such window, ``windows`` the number
    of windows that match.
    """
    spark = docs.sparkSession
    known = {name: words for name, text in templates.items() if (words := words_of(text))}
    if not known:
        empty = "doc_id {}, license string, containment double, first_word int, windows long"
        return spark.createDataFrame([], empty.format(docs.schema["doc_id"].dataType.simpleString()))
    needed = sorted(set().union(*map(needed_words, known.values())))
    lengths = sorted({len(words) for words in known.values()})

    lower = F.lower("text")
    may_hold = F.lit(False)
    for word in needed:
        may_hold = may_hold | F.contains(lower, F.lit(word))
    found = keyed(docs.select("doc_id", "text")).where(may_hold)
    worded = found.select("doc_id", *KEY, F.regexp_extract_all(lower, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words"))
    marked = worded.withColumn("places", F.filter(
        F.transform("words", lambda word, at: F.when(word.isin(needed), at)), lambda at: at.isNotNull()))

    def windows(words: int) -> Column:
        length, step = window_of(words)
        starts = F.array_distinct(F.flatten(F.transform("places", lambda at: F.sequence(
            F.floor(F.greatest(at - (length - 1), F.lit(0)) / step).cast("int") * step, F.floor(at / step).cast("int") * step, F.lit(step)))))
        return F.transform(starts, lambda start: F.struct(
            F.lit(words).alias("length"), start.alias("start"), F.slice("words", start + 1, length).alias("part")))

    spread = marked.select("doc_id", *KEY, F.explode(F.concat(*(windows(n) for n in lengths))).alias("window")).select(
        "doc_id", *KEY, "window.*")
    shingled = spread.withColumn("shingles", F.when(F.col("length") >= SHINGLE, _shingles(F.col("part"), SHINGLE)).otherwise(
        F.array(F.array_join("part", " "))))
    banded = shingled.select("doc_id", *KEY, "length", "start", "shingles", F.posexplode(_bands(F.col("shingles"))).alias("band", "code"))

    rows = [(name, len(words), shingles_of(words)) for name, words in known.items()]
    table = spark.createDataFrame(rows, "license string, length int, wanted array<string>")
    # One row per template and band: the bound of the broadcast.
    retrieving = table.select("license", "length", "wanted", F.posexplode(_bands(F.col("wanted"))).alias("band", "code"))
    candidates = banded.join(F.broadcast(retrieving), ["length", "band", "code"])
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    verified = candidates.select("doc_id", *KEY, "license", "start", share.alias("containment")).where(F.col("containment") >= CONTAINMENT)
    # The bands that a window and a template share give one row each.
    single = verified.groupBy("doc_id", *KEY, "license", "start").agg(F.max("containment").alias("containment"))
    best = single.groupBy("doc_id", *KEY, "license").agg(
        F.max("containment").alias("containment"), F.min(F.struct((-F.col("containment")).alias("rank"), "start")).alias("first"),
        F.count("*").alias("windows"))
    return best.select("doc_id", "license", "containment", F.col("first.start").alias("first_word"), "windows")

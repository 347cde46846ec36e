"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a text, every run of lines without a blank one, and the whole text are compared with
every template; the best cosine counts. Document frequencies are those of all texts, for the words
of the templates; any other word has the weight of one that occurs nowhere. A document without a
licence of its own takes that of the licence file in its own directory or else in the nearest
directory above, found by joins on paths.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import Scratch, bounded_batches

THRESHOLD = 0.6
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([.-].*)?$"
TERM = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")

# The usual headers and opening words of public licences.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("To the extent possible under law, the author has dedicated all copyright to the public domain, CC0 1.0.",),
}
SPDX = re.compile(r"spdx-license-identifier:\s*([\w.+-]+)", re.I)


def terms(text: str) -> Counter:
    return Counter(TERM.findall(text.lower()))


def document_frequencies(batches, vocabulary: frozenset):
    """(word, documents) of the words of the templates, and the number of texts under the empty word."""
    import pyarrow as pa

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(1).to_pylist():
            counts[""] += 1
            counts.update(vocabulary.intersection(TERM.findall((text or "").lower())))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
    )


def weights_of(counts: Counter, idf: dict[str, float], unseen: float) -> dict[str, float]:
    return {w: (1 + math.log(n)) * idf.get(w, unseen) for w, n in counts.items()}


class Matcher:
    """Cosine of a segment to every template, by an index from words to templates; below ``threshold`` it may be 0."""

    def __init__(
        self, idf: dict[str, float], unseen: float, templates: dict[str, tuple[str, ...]], threshold: float = THRESHOLD
    ):
        self.idf, self.unseen, self.threshold = idf, unseen, threshold
        self.index: dict[str, list[tuple[int, float]]] = {}
        self.names: list[str] = []
        for name, texts in templates.items():
            for text in texts:
                vector = weights_of(terms(text), idf, unseen)
                length = math.sqrt(sum(v * v for v in vector.values()))
                for word, value in vector.items():
                    self.index.setdefault(word, []).append((len(self.names), value / length))
                self.names.append(name)
        self.vocabulary = frozenset(self.index)

    def best(self, words: list[str]) -> tuple[float, str | None]:
        hits = self.vocabulary.intersection(words)
        if not hits:
            return 0.0, None
        vector = weights_of(Counter(words), self.idf, self.unseen)
        square = sum(v * v for v in vector.values())
        # The cosine is at most the share of the segment's length that lies on known words.
        if sum(vector[w] ** 2 for w in hits) < self.threshold**2 * square:
            return 0.0, None
        dots = [0.0] * len(self.names)
        for word in hits:
            for template, value in self.index[word]:
                dots[template] += value * vector[word]
        top = max(range(len(dots)), key=lambda i: (dots[i], -i))
        return min(1.0, dots[top] / math.sqrt(square)), self.names[top]

    def scan(self, text: str) -> tuple[float, str | None]:
        """Best score and its licence; of equal ones the first in the order of the text."""
        if tag := SPDX.search(text):
            return 1.0, tag[1]
        best, lines, whole = (0.0, None), [], []

        def consider(words):
            nonlocal best
            if words:
                found = self.best(words)
                if found[0] > best[0]:
                    best = found

        for line in [*text.lower().split("\n"), ""]:
            words = TERM.findall(line)
            if words:
                consider(words)
                lines.append(words)
                whole.append(words)
            elif lines:
                if len(lines) > 1:
                    consider([w for x in lines for w in x])
                lines = []
        if len(whole) > 1:
            consider([w for x in whole for w in x])
        return best


def scan_batches(batches, matcher: Matcher, threshold: float):
    import pyarrow as pa

    for batch in batches:
        found = [matcher.scan(text or "") for text in batch.column(2).to_pylist()]
        names = [name if score >= threshold else None for score, name in found]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(names, pa.string()), pa.array([s for s, _ in found], pa.float64())],
            names=["doc_id", "path", "license", "score"],
        )


def own_licenses(rows: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, license, score) of rows (doc_id, path, text)."""
    vocabulary = frozenset(w for texts in templates.values() for t in texts for w in terms(t))
    count = functools.partial(document_frequencies, vocabulary=vocabulary)
    counted = rows.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    seen = {r["word"]: r["n"] for r in counted.collect()}  # one row for each word of the templates
    total = seen.pop("", 0)
    idf = {w: math.log((1 + total) / (1 + seen.get(w, 0))) + 1 for w in vocabulary}
    matcher = Matcher(idf, math.log(1 + total) + 1, templates, threshold)
    scan = functools.partial(scan_batches, matcher=matcher, threshold=threshold)
    return rows.mapInArrow(scan, "doc_id long, path string, license string, score double")


def directory(path):
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, path, license, score, basis, from_path.

    ``basis`` is ``own``, ``inherited`` or null. A licence file has a name as ``LICENSE`` or ``COPYING``
    and a licence by its text; of several in a directory the best score counts, then the first
    name. Null paths inherit nothing, null and empty texts have no licence of their own, score 0.
    Repeated rows give repeated rows; other columns are not looked at; an empty table gives none.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(path_col).cast("string").alias("path"),
        F.col(text_col).cast("string").alias("text"),
    )
    own = scratch.table(own_licenses(rows, templates, threshold))
    name = F.regexp_extract("path", r"[^/]*$", 0)
    files = own.filter(F.col("license").isNotNull() & name.rlike(LICENCE_FILE))
    best = F.max(F.struct("score", F.xxhash64("path").alias("_tie"), "license", "path")).alias("_best")
    given = files.groupBy(directory("path").alias("_dir")).agg(best).select("_dir", "_best.license", "_best.path")
    given = given.select("_dir", F.col("license").alias("_license"), F.col("path").alias("_from"))
    # Directories, not documents, look upwards: one row for each directory and each above it.
    places = own.filter("license is null and path is not null").select(directory("path").alias("dir")).distinct()
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.concat_ws("/", F.slice(steps, 1, n)))
    chain = places.select("dir", F.posexplode(F.array_distinct(above)).alias("depth", "up"))
    met = chain.join(given, F.col("up") == F.col("_dir"))
    nearest = met.groupBy("dir").agg(F.max(F.struct("depth", "_license", "_from")).alias("_near"))
    nearest = nearest.select(F.col("dir").alias("_at"), "_near._license", "_near._from")
    out = own.join(nearest, F.col("license").isNull() & (directory("path") == F.col("_at")), "left")
    inherited = F.col("license").isNull() & F.col("_license").isNotNull()
    return out.select(
        "doc_id",
        "path",
        F.coalesce("license", "_license").alias("license"),
        "score",
        F.when(inherited, "inherited").when(F.col("license").isNotNull(), "own").alias("basis"),
        F.when(inherited, F.col("_from")).when(F.col("license").isNotNull(), F.col("path")).alias("from_path"),
    )

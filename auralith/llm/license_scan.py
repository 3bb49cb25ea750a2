"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest ancestor directory.

A file with a licence cue, or with a licence file's name, has as segments its lines that hold a cue, its paragraphs that do (runs of lines with words), and
the whole file. Lines and paragraphs are compared with short notices, titles and the paragraphs of short licences, the whole file with full licence texts. Term counts
are damped by a logarithm; term weights come from all segments of the corpus: document frequencies of the templates' terms, counted in Spark. Other terms get the largest
weight, so that foreign words lower the cosine. A file's own licence is that of the full text that the whole file matches with SURE or more, else the best template of its
best segment, from MATCH on. A file without one inherits from the nearest directory above it whose licence file has one: a join on directory paths.

The full texts are the public licence texts in the folder `licences`, a file for each SPDX name.

Cases: null text has no segment; null path can't inherit; ties go to the licence that sorts first; of several licence files in a directory the one
with the highest cosine, then the smallest path, counts; repeated rows get equal results; an empty table gives an empty result; columns other than doc_id, path
and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auralith.llm.common import checkpointed, heavy_keys, join_skewed, map_texts

MATCH, SURE = 0.6, 0.95
CUE = r"(?i)licen[sc]ed?\b|copyright|spdx|permission is hereby|redistribut|all rights reserved|public domain|without warranty"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([._-].*)?$"
#: SPDX name and short notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]
_cue, _term, _named = re.compile(CUE).search, re.compile(TERM).findall, re.compile(LICENCE_FILE).match


#: Licences up to this size are matched by their paragraphs too, as they stand at the head of source files.
SHORT = 6_000
_blank = re.compile(r"\n[^\w\n]*\n[^\w]*")


@lru_cache(1)
def full_texts() -> tuple[tuple[str, str], ...]:
    """SPDX name and text of each file in the folder."""
    return tuple((p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licences").glob("*.txt")))


def paragraphs(text: str) -> list[str]:
    """Runs of lines that hold a letter or digit."""
    return [p for p in _blank.split(text) if p.strip()]


def notices() -> list[tuple[str, str]]:
    """Short templates: the notices, the titles of the full texts, and the paragraphs of short ones that no other licence has."""
    parts = [(name, p) for name, text in full_texts() for i, p in enumerate(paragraphs(text)) if i == 0 or (len(text) <= SHORT and _cue(p))]
    owners = {p: {n for n, q in parts if q == p} for _, p in parts}
    return TEMPLATES + [(n, p) for n, p in parts if len(owners[p]) == 1]


def vocabulary() -> list[str]:
    return sorted({t for _, text in (*notices(), *full_texts()) for t in _term(text.lower())})


def segments(text: str, licence_file: bool) -> tuple[list[str], list[str]]:
    """Lines and paragraphs with a cue, and the whole file if there are any or its name is a licence file's."""
    cued = _cue(text) is not None
    short = [line for line in text.split("\n") if _cue(line)] + [p for p in paragraphs(text) if "\n" in p.strip() and _cue(p)] if cued else []
    return short, [text] if text.strip() and (cued or licence_file) else []


def frequencies(files: DataFrame, terms: list[str]) -> tuple[int, dict[str, int]]:
    """The number of segments of the whole corpus, and of those that hold each of the terms; at most a row a term comes back."""
    text = F.coalesce("text", F.lit(""))
    cued = lambda parts: F.filter(parts, lambda p: p.rlike(CUE))
    named = F.coalesce(_base("path").rlike(LICENCE_FILE), F.lit(False))
    blocks = F.filter(F.split(text, r"\n[^\w\n]*\n[^\w]*"), lambda p: F.trim(p).contains("\n"))
    rows = files.where(text.rlike(CUE) | (named & (F.trim(text) != ""))).select(F.explode(F.concat(F.array(text), cued(F.split(text, "\n")), cued(blocks))).alias("segment"))
    found = rows.select(F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(F.lower("segment"), F.lit(TERM), 0)))).alias("term"))
    # the templates' terms, a fixed table
    known = F.broadcast(files.sparkSession.createDataFrame([(t,) for t in ["", *terms]], "known string"))
    counts = {r["term"]: r["count"] for r in found.join(known, F.col("term") == F.col("known"), "left_semi").groupBy("term").count().collect()}
    return counts.pop("", 0), counts


def _base(path: str) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


class Matcher:
    """Cosines to the short templates and to the full texts. n: segments of the corpus; df: those that hold a term."""

    def __init__(self, n: int, df: dict[str, int]) -> None:
        self.weight = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary()}
        self.other = math.log(1 + n) + 1
        self.short = [(name, self.vector(text)) for name, text in notices()]
        self.full = [(name, self.vector(text)) for name, text in full_texts()]

    def vector(self, text: str) -> dict[str, float]:
        v = {t: (1 + math.log(k)) * self.weight.get(t, self.other) for t, k in Counter(_term(text.lower())).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    def best(self, texts: list[str], templates: list[tuple[str, dict[str, float]]]) -> tuple[float, str | None]:
        """The largest cosine of any text to any template, and the licence; of equal ones the first by name."""
        found = [(-round(sum(x * v[t] for t, x in template.items() if t in v), 9), name) for v in map(self.vector, set(texts)) for name, template in templates]
        score, name = min(found, default=(0.0, None))
        return -score, name

    def licence(self, text: str, licence_file: bool, match: float = MATCH) -> tuple[str | None, float]:
        """The file's own licence (none below match) and its cosine."""
        short, whole = segments(text, licence_file)
        score, name = self.best(whole, self.full)
        if score < SURE:
            score, name = max((score, name), self.best([*short, *whole] if licence_file else short, self.short), key=lambda x: x[0])
        return (name if score >= match else None), score


def own_licences(files: DataFrame, match: float = MATCH) -> DataFrame:
    """doc_id, path, own, score: a file's own licence (null below match), and the best cosine (0 without segments)."""
    shared = files.sparkSession.sparkContext.broadcast(Matcher(*frequencies(files, vocabulary())))

    def work(texts: list[str]) -> list[pa.Array]:
        made = [shared.value.licence(text, named == "1", match) for named, _, text in (joined.partition("\n") for joined in texts)]
        return [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]

    named = F.coalesce(_base("path").rlike(LICENCE_FILE), F.lit(False))
    rows = files.select("doc_id", "path", F.concat(F.when(named, "1\n").otherwise("0\n"), F.coalesce("text", F.lit(""))).alias("__file"))
    return map_texts(rows, "__file", "own string, score double", work).drop("__file")


def scan(files: DataFrame, match: float = MATCH) -> DataFrame:
    """doc_id, path, licence, score, origin (own, inherited, none): one row a file. files: doc_id, path, text.

    Directories that many others lie below, or that hold many files, are dealt over salts (join_skewed).
    """
    own = checkpointed(own_licences(files, match).withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")))
    order = F.struct(-F.col("score"), F.col("path"), F.col("doc_id"))
    heads = own.where(_base("path").rlike(LICENCE_FILE) & F.col("own").isNotNull()).groupBy(F.col("dir").alias("above")).agg(F.min_by("own", order).alias("from_above"))
    dirs = checkpointed(own.where("dir IS NOT NULL").groupBy("dir").agg(F.count("*").alias("n")))
    parts = F.split("dir", "/")
    chain = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("above")))
    above = dirs.select("dir", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above"))), chain)).alias("a")).select("dir", "a.*")
    below = heavy_keys(above.groupBy("above").agg(F.count("*").alias("n")), ["above"], "n")
    nearest = join_skewed(above, checkpointed(heads), ["above"], below).groupBy("dir").agg(F.max_by("from_above", "depth").alias("inherited"))
    out = join_skewed(own, checkpointed(nearest), ["dir"], heavy_keys(dirs, ["dir"], "n"), "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", "path", F.coalesce("own", "inherited").alias("licence"), "score", origin.alias("origin"))


def with_paths(docs: DataFrame) -> DataFrame:
    """doc_id, path, text: documents as files of a tree. source/lang/thousand/hundred/id.txt; ids that end the hundred, thousand or five thousand are the licence files of those directories and of source/lang."""
    number = F.col("doc_id")
    top = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")))
    thousand, hundred = (number / 1000).cast("long").cast("string"), (number / 100).cast("long").cast("string")
    path = F.when(number % 5000 == 0, F.concat(top, F.lit("/LICENSE"))).when(number % 1000 == 0, F.concat_ws("/", top, thousand, F.lit("LICENSE")))
    path = path.when(number % 100 == 0, F.concat_ws("/", top, thousand, hundred, F.lit("LICENSE"))).when(number.isNotNull(), F.concat(F.concat_ws("/", top, thousand, hundred, number.cast("string")), F.lit(".txt")))
    return docs.select("doc_id", path.alias("path"), "text")

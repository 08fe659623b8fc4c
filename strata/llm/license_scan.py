"""Licence scan: which licence a file is under, by what it says or where it lies.

1. Every line, paragraph and whole text is compared with licence templates by
   sparse TF-IDF cosine (idf over the templates; a word in none of them weighs
   most).  A segment without an *anchor* word can't reach the threshold (the
   anchors are each template's heaviest words, common words of prose last, taken
   until the rest of its vector is shorter than the threshold), nor can one whose
   shared words make up too little of every template; only the others are scored: an exact filter.
   Where nothing stands alone on a line, in a paragraph or as the whole text, the running text is
   read: every sentence, and every window of a template's length that holds one of its anchors.
   A match counts only with the words that tell the template from its neighbours (name, version,
   variant), and without those of variants that it doesn't name.
2. A file whose name says so, or whose whole text fits a template, is a
   licence file and speaks for its directory.
3. Files that say nothing inherit from the nearest directory above that has a
   licence file: distinct directories are expanded to their ancestors, joined
   to licensed directories by path, and joined back to the files.

Only DataFrame operations; a directory that holds a third of all files is one
row until the last join, whose other side has one row per directory.

Defined results: a null text says nothing; a null path lies in the root
directory; a statement that stands alone goes before one in running text; ties go to
the longer window of running text, then the smaller licence id, then the smaller path; rows that repeat a path
are judged each by their own text; an empty table gives an empty result;
other columns are ignored."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

# Licence statements and notices (licence id, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions must retain the above copyright notice, this list of conditions and the following disclaimer; neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work (CC0 1.0)."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited."),
)
# More statements, weighed by the words of TEMPLATES: tags of the SPDX list, usual notices, headers and licence texts.
SPDX = ("MIT", "MIT-0", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
        "0BSD", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "CC0-1.0", "ISC", "Unlicense")
GNU = (("GPL-2.0", "General Public License", "2", "program"), ("GPL-3.0", "General Public License", "3", "program"), ("LGPL-2.0", "Library General Public License", "2", "library"),
       ("LGPL-2.1", "Lesser General Public License", "2.1", "library"), ("LGPL-3.0", "Lesser General Public License", "3", "library"), ("AGPL-3.0", "Affero General Public License", "3", "program"))
CC = (("CC-BY-4.0", "BY", "Attribution"), ("CC-BY-SA-4.0", "BY-SA", "Attribution-ShareAlike"), ("CC-BY-NC-4.0", "BY-NC", "Attribution-NonCommercial"),
      ("CC-BY-ND-4.0", "BY-ND", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
      ("CC-BY-NC-ND-4.0", "BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
BSD_TEXT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_ADVERT = " All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
BSD_NAMES = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_END = (' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY '
           "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES")
AS_IS = ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
MIT_TEXT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
MIT_NOTICE = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
NOTICES = tuple((name, f"SPDX-License-Identifier: {name}") for name in SPDX) + tuple(
    (name, text) for name, title, version, work in GNU for text in (
        f"Licensed under the GNU {title}, version {version}.", f"GNU {title} version {version}", f"GNU {title} v{version}",
        f"This {work} is free software; you can redistribute it and/or modify it under the terms of the GNU {title} as published by the Free Software Foundation; "
        f"either version {version} of the License, or (at your option) any later version.")) + tuple(
    (name, text) for name, short, title in CC for text in (
        f"Licensed under CC {short} 4.0.", f"This work is licensed under a Creative Commons {title} 4.0 International License.", f"Creative Commons {title} 4.0 International")) + tuple(
    (f"BSD-{n}-Clause", text) for n in "234" for text in (f"BSD {n}-Clause License", f"Licensed under the BSD {n}-Clause License.")) + (
    ("BSD-2-Clause", BSD_TEXT), ("BSD-2-Clause", BSD_TEXT + BSD_END), ("BSD-3-Clause", BSD_TEXT + BSD_NAMES), ("BSD-3-Clause", BSD_TEXT + BSD_NAMES + BSD_END),
    ("BSD-4-Clause", BSD_TEXT + BSD_ADVERT + BSD_NAMES), ("BSD-4-Clause", BSD_TEXT + BSD_ADVERT + BSD_NAMES + BSD_END),
    ("MIT", MIT_TEXT + MIT_NOTICE + AS_IS), ("MIT-0", MIT_TEXT + "." + AS_IS), ("MIT-0", "Licensed under the MIT-0 License."), ("MIT-0", "Licensed under the MIT No Attribution License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."), ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC0-1.0", "Licensed under CC0 1.0."), ("ISC", "Licensed under the ISC License."), ("Unlicense", "Licensed under the Unlicense."))
# What tells templates apart: a text that holds such a word is known by it alone; else every word of its name and version must be there ...
TEXT_MARKS = frozenset("sublicense endorse waived unencumbered unauthorized".split())
NAME_MARKS = frozenset("""mit apache gnu gpl lgpl agpl lesser library affero bsd 0bsd mpl mozilla cc creative by sa nc nd sharealike noncommercial noderivatives cc0 isc unlicense
                       attribution disclaimer provided no v2 v3 0 1 2 3 4""".split())
# ... and no word of a variant that the template itself doesn't hold, by what the template holds.
VARIANTS = (("gnu", "lesser affero"), ("cc", "sa nc nd"), ("creative", "sharealike noncommercial noderivatives noderivs sa nc nd"), ("redistribution", "advertising"),
            ("disclaimer", "endorse"), ("mit", "0 no"), ("fee", "provided"))
# Common words of prose (some by chance words of another language), then less common ones: anchors only where a template needs them.
COMMON = ("a all an and any are as at be by can do for from has if in into is it its mit nd no not of on or out so such than that the this to was will with you your".split(),
          "0 1 2 3 4 above copy free form list may must one other permitted person provided right rights sell source state terms under use used version without work".split())
SALTS = 16
THRESHOLD = 0.75
LICENSE_NAMES = r"(?i)^(un)?(licen[cs]e|copying|copyright|notice)([.\-_].*)?$"
NOT_WORD = r"[^\p{L}\p{N}]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def template_weights(templates: Sequence[tuple[str, str]] = TEMPLATES) -> tuple[dict[str, float], float, list[tuple[str, str, float]]]:
    """(idf by word, idf of unknown words, unit vectors as (template, word, weight)); a template's name is its licence and number."""
    df = Counter(w for _, t in templates for w in set(template_words(t)))
    idf = {w: math.log((1 + len(templates)) / (1 + n)) + 1 for w, n in df.items()}
    unknown = math.log(1 + len(templates)) + 1
    return idf, unknown, unit_vectors(templates, idf, unknown)


def unit_vectors(templates: Sequence[tuple[str, str]], idf: dict[str, float], unknown: float, first: int = 0) -> list[tuple[str, str, float]]:
    """(template, word, weight) of the templates, numbered from ``first``."""
    rows = []
    for k, (name, text) in enumerate(templates, first):
        c = Counter(template_words(text))
        norm = math.sqrt(sum((n * idf.get(w, unknown)) ** 2 for w, n in c.items()))
        rows += [(f"{name}#{k}", w, n * idf.get(w, unknown) / norm) for w, n in sorted(c.items())]
    return rows


def telling_words(templates: Sequence[tuple[str, str]]) -> list[tuple[str, str, int, int]]:
    """(template, word, 1 if a segment must hold the word, 1 if it must not)."""
    rows = []
    for k, (name, text) in enumerate(templates):
        words = set(template_words(text))
        need = words & TEXT_MARKS or words & NAME_MARKS
        bar = {w for mark, others in VARIANTS if mark in words for w in others.split()} - words
        rows += [(f"{name}#{k}", w, int(w in need), int(w in bar)) for w in sorted(need | bar)]
    return rows


def anchor_words(rows: Sequence[tuple[str, str, float]], threshold: float) -> list[str]:
    """Words of which every segment at the threshold has at least one."""
    anchors: set[str] = set()
    for name in sorted({r[0] for r in rows}):
        own = sorted(((w, x) for t, w, x in rows if t == name), key=lambda r: (2 * (r[0] in COMMON[0]) + (r[0] in COMMON[1]), -r[1], r[0]))
        rest = 1.0
        for w, x in own:
            if math.sqrt(max(rest, 0.0)) < threshold - 1e-9:
                break
            anchors.add(w)
            rest -= x * x
    return sorted(anchors)


def constant(value: object, schema: str) -> Column:
    """The value as one literal: parsed while planning, however many templates there are."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {schema}")["v"]


VECTORS = "array<array<struct<w:string,q:double>>>"


def vectors_of(rows: Sequence[tuple[str, str, float]]) -> list[list[dict]]:
    """The templates' words with their squared weights, a list for each template."""
    by: dict[str, list[dict]] = {}
    for t, w, x in rows:
        by.setdefault(t, []).append({"w": w, "q": x * x})
    return [by[t] for t in sorted(by)]


def can_reach(words: Column, vectors: Column, known: Sequence[str], threshold: float) -> Column:
    """Whether the words that a segment shares with some template make up
    ``threshold`` of that template's length: no cosine can be larger."""
    shared = F.array_intersect(words, constant(list(known), "array<string>"))

    def reach(present: Column) -> Column:
        def length(vector: Column) -> Column:
            return F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.when(F.array_contains(present, x["w"]), x["q"]).otherwise(0.0))
        return F.exists(vectors, lambda v: length(v) >= threshold * threshold - 1e-9)

    return F.exists(F.array(shared), reach)  # one element, so that the shared words are found once


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def running_parts(texts: DataFrame, templates: Sequence[tuple[str, str]], rows: Sequence[tuple[str, str, float]], threshold: float) -> DataFrame:
    """(row, segment, words) of the sentences of (row, text), and of the windows that
    are as long as a template, hold one of its anchors and can reach it."""
    known = sorted({r[1] for r in rows})
    anchors = constant(anchor_words(rows, threshold), "array<string>")
    sentences = (texts.select("row", F.posexplode(F.split("text", r"(?<=[.!?;])\s+")).alias("segment", "part")).withColumn("words", words_of(F.col("part")))
                 .select("row", F.col("segment").cast("long").alias("segment"), "words").filter(F.arrays_overlap("words", anchors))
                 .filter(can_reach(F.col("words"), constant(vectors_of(rows), VECTORS), known, threshold)))
    by_length: dict[int, list[str]] = {}
    for k, (name, text) in enumerate(templates):
        by_length.setdefault(len(template_words(text)), []).append(f"{name}#{k}")
    kinds = []
    for n, names in sorted(by_length.items()):
        own = [r for r in rows if r[0] in names]
        kinds.append({"n": n, "anchors": anchor_words(own, threshold), "vectors": vectors_of(own)})
    each = (texts.select("row", words_of(F.col("text")).alias("words")).select("row", "words", F.explode(constant(kinds, f"array<struct<n:int,anchors:array<string>,vectors:{VECTORS}>>")).alias("kind")).select("row", "words", "kind.*")
            .filter((F.size("words") > F.col("n")) & F.arrays_overlap("words", "anchors")))
    spots = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains("anchors", w), i)), lambda i: i.isNotNull())
    begins = F.array_distinct(F.flatten(F.transform(spots, lambda i: F.sequence(F.greatest(i - F.col("n") + 1, F.lit(0)), F.least(i, F.size("words") - F.col("n"))))))
    # cut before the explode: a window's row then carries its own words, not the whole text's
    cut = F.transform(begins, lambda i: F.struct(i.alias("begin"), F.slice(F.col("words"), i + 1, F.col("n")).alias("words")))
    windows = (each.select("row", "n", "vectors", F.explode(cut).alias("w"))
               .select("row", (-1 - F.col("w.begin").cast("long") * 100_003 - F.col("n")).alias("segment"), F.col("w.words").alias("words"), "vectors")
               .filter(can_reach(F.col("words"), F.col("vectors"), known, threshold)).drop("vectors"))
    return sentences.unionByName(windows)


def score_parts(parts: DataFrame, idf: dict[str, float], unknown: float, rows: Sequence[tuple[str, str, float]], telling: Sequence[tuple[str, str, int, int]],
                threshold: float) -> DataFrame:
    """(row, segment, license, score, n_words) of the templates that parts (row, segment, words) fit, with the words that tell them apart."""
    spark = parts.sparkSession
    # bounded by the templates (a parameter), so broadcast
    weight = {(t, w): (x, 0, 0) for t, w, x in rows}
    weight |= {(t, w): (weight.get((t, w), (0.0,))[0], need, bar) for t, w, need, bar in telling}
    weights = F.broadcast(spark.createDataFrame([(*k, *v) for k, v in sorted(weight.items())], "template string, word string, weight double, need int, bar int"))
    needed: Counter[str] = Counter()
    for t, _, need, _ in telling:
        needed[t] += need
    needs = F.broadcast(spark.createDataFrame([(t, needed[t]) for t in sorted({r[0] for r in rows})], "template string, needed int"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "word string, idf double"))
    counts = (parts.select("row", "segment", F.explode("words").alias("word")).groupBy("row", "segment", "word").agg(F.count(F.lit(1)).alias("n"))
              .join(known, "word", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(unknown))))
    norms = counts.groupBy("row", "segment").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.sum("n").alias("n_words"))
    dots = counts.join(weights, "word").groupBy("row", "segment", "template").agg(
        F.sum(F.col("x") * F.col("weight")).alias("dot"), F.sum("need").alias("met"), F.sum("bar").alias("barred"))
    dots = dots.join(needs, "template").filter("met = needed and barred = 0")
    scored = dots.join(norms, ["row", "segment"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("score") >= threshold)
    return scored.select("row", "segment", F.regexp_replace("template", "#[0-9]+$", "").alias("license"), "score", "n_words")


def license_statements(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                       notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """Best template of each file of (row, path, text) that reaches the
    threshold: (row, license, score, whole), ``whole`` if the whole text does."""
    spark = files.sparkSession
    idf, unknown, rows = template_weights(templates)
    rows = rows + unit_vectors(notices, idf, unknown, len(templates))
    telling = telling_words([*templates, *notices])
    anchors = constant(anchor_words(rows, threshold), "array<string>")
    path = scratch_path(spark, "speaking")
    files.select("row", "text").filter(F.arrays_overlap(words_of(F.col("text")), anchors)).dropDuplicates(["row"]).write.parquet(path)
    speaking = spark.read.schema("row long, text string").parquet(path)
    lines = F.split("text", r"\r?\n|\r")
    paragraphs = F.split("text", r"\n\s*\n")
    segments = F.array_distinct(F.concat(F.array("text"), lines, paragraphs))
    parts = (speaking.select("row", F.posexplode(segments).alias("segment", "part"))
             .withColumn("words", words_of(F.col("part"))).filter(F.arrays_overlap("words", anchors)).select("row", "segment", "words"))
    parts = parts.filter(can_reach(F.col("words"), constant(vectors_of(rows), VECTORS), sorted({r[1] for r in rows}), threshold))
    path = scratch_path(spark, "segments")
    parts.write.parquet(path)
    parts = spark.read.schema("row long, segment int, words array<string>").parquet(path)
    named = score_parts(parts, idf, unknown, rows, telling, threshold)
    key = F.struct((-F.col("score")).alias("s"), F.col("license").alias("l"))
    path = scratch_path(spark, "standing")
    named.groupBy("row").agg(F.min(key).alias("key"), F.max((F.col("segment") == 0).cast("int")).alias("whole")).select(
        "row", F.col("key.l").alias("license"), (-F.col("key.s")).alias("score"), (F.col("whole") == 1).alias("whole")).write.parquet(path)
    standing = spark.read.schema("row long, license string, score double, whole boolean").parquet(path)
    path = scratch_path(spark, "running")
    running_parts(speaking.join(standing, "row", "left_anti"), [*templates, *notices], rows, threshold).write.parquet(path)
    parts = spark.read.schema("row long, segment long, words array<string>").parquet(path)
    key = F.struct((-F.col("score")).alias("s"), (-F.col("n_words")).alias("n"), F.col("license").alias("l"))
    running = score_parts(parts, idf, unknown, rows, telling, threshold).groupBy("row").agg(F.min(key).alias("key")).select(
        "row", F.col("key.l").alias("license"), (-F.col("key.s")).alias("score"), F.lit(False).alias("whole"))
    return standing.unionByName(running)


def directory_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(?s:(.*))/", 1)


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
                  threshold: float = THRESHOLD, keep: Sequence[str] = ()) -> DataFrame:
    """One row per file: path, license (or null), score, origin (``own``,
    ``inherited`` or ``none``) and license_dir (the directory inherited from), and the columns named in ``keep``."""
    spark = files.sparkSession
    rows = files.select(F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.struct(F.lit(0).alias("_"), *[F.col(c) for c in keep]).alias("kept"))
    # a number by content: the same in every plan and retry, whatever shuffle feeds it; equal files share their licence
    rows = rows.withColumn("row", F.xxhash64("path", "text"))
    names = rows.select("row", "path", "kept")
    path = scratch_path(spark, "statements")
    license_statements(rows, templates, threshold).write.parquet(path)
    own = spark.read.schema("row long, license string, score double, whole boolean").parquet(path)
    files_own = names.join(own, "row", "left").withColumn("dir", directory_of(F.col("path")))
    path = scratch_path(spark, "files")
    files_own.write.parquet(path)
    files_own = spark.read.schema(files_own.schema).parquet(path)
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENSE_NAMES)
    speaks = files_own.filter(F.col("license").isNotNull() & (F.col("whole") | named))
    licensed = speaks.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license", "path")).alias("best")).select(
        F.col("dir").alias("above"), F.col("best.license").alias("dir_license"), (-F.col("best.s")).alias("dir_score"))
    dirs = files_own.filter("license is null").select("dir").distinct()
    steps = F.split("dir", "/")
    chain = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("above")))
    ancestors = dirs.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above")))).otherwise(chain)).alias("a")).select("dir", "a.*")
    nearest = (ancestors.join(licensed, "above").groupBy("dir")
               .agg(F.max_by(F.struct("dir_license", "dir_score", "above"), "depth").alias("found")).select("dir", "found.*"))
    # a directory may hold a third of all files: its one row of ``nearest`` is copied for each salt
    salted = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    out = files_own.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS).cast("long"))).join(salted, ["dir", "salt"], "left")
    return out.select(
        "kept", "path", F.coalesce("license", "dir_license").alias("license"), F.when(F.col("license").isNotNull(), F.col("score")).otherwise(F.col("dir_score")).alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("above")).alias("license_dir")).select(*[F.col(f"kept.{c}") for c in keep], "path", "license", "score", "origin", "license_dir")

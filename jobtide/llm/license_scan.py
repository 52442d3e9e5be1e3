"""License scan by DataFrame functions only.

Method: the lines of a document and its paragraphs (between blank lines, if of several lines) are
normalised to lower-case ASCII words and compared with license templates by the Dice coefficient of
their bags of word bigrams: twice the shared bigrams over all bigrams of both.  A coefficient of t
needs between t / (2 - t) and (2 - t) / t times as many bigrams as the template has, so passages are
joined with templates on their number of bigrams, before any bigram is built.  Before that, texts and
passages without any anchor word are put aside: the anchors of a template are words of it without
which too few of its bigrams are left to reach t.  The others are compared exactly, repeated bigrams
numbered.

Nulls: a null text has no passage; a null doc_id is reported as null.  Passages of fewer than two
words match nothing.  Ties: a passage goes to the template with the highest coefficient, then the
first by name.  Repeated rows are reported each.  Very long texts are read whole; a passage's work
is bounded by the templates it can match.  Only doc_id and text are read, so other columns cannot
clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Wordings of license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "all-rights-reserved": "All rights reserved.",
    "bsd-3-clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def normalised(text: Column) -> Column:
    """Words of a-z and 0-9, A-Z lower-cased, one blank between two."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def n_bigrams(normal: Column) -> Column:
    return F.greatest(F.char_length(normal) - F.char_length(F.replace(normal, F.lit(" "), F.lit(""))), F.lit(0))


def bigrams(normal: Column) -> Column:
    words = F.split(normal, " ")
    return F.zip_with(
        F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def numbered(values: Column) -> Column:
    """Each value with how often it has occurred so far, so that equal bags have equal sets."""
    return F.transform(values, lambda x, i: F.concat(
        x, F.lit(" "), F.size(F.filter(F.slice(values, 1, i), lambda y: y == x)).cast("string")
    ))


def anchors(templates: dict[str, str], threshold: float) -> list[str]:
    """Words of which a passage has at least one if it reaches the threshold with any template.

    A passage that shares s bigrams with a template of m has s bigrams or more, so its coefficient is
    at most 2 s / (s + m).  Words are taken, long ones first, until the bigrams without them are too
    few for the threshold.
    """
    found: set[str] = set()
    for text in templates.values():
        words = re.findall("[a-z0-9]+", text.translate({c: c + 32 for c in range(65, 91)}))
        pairs = list(zip(words, words[1:]))
        rest = sorted(set(words) - found, key=lambda w: (-len(w), w))
        while True:
            left = sum(a not in found and b not in found for a, b in pairs)
            if not pairs or 2 * left < threshold * (left + len(pairs)) - 1e-9:
                break
            found.add(rest.pop(0))
    return sorted(found)


def has_anchor(text: Column, words: list[str]) -> Column:
    return text.rlike(r"(?<![A-Za-z0-9])(?i:" + "|".join(words) + r")(?![A-Za-z0-9])") if words else F.lit(False)


def template_table(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """(size, candidates): the templates that a passage of so many bigrams can match."""
    rows = spark.createDataFrame([(-k, n, templates[n]) for k, n in enumerate(sorted(templates))], "rank int, template string, text string")
    rows = rows.withColumn("text", normalised(F.col("text"))).withColumn("n", n_bigrams(F.col("text"))).where("n > 0")
    low = F.ceil(F.lit(threshold / (2 - threshold)) * F.col("n") - 1e-9)
    high = F.floor(F.lit((2 - threshold) / threshold) * F.col("n") + 1e-9)
    rows = rows.withColumn("plain", bigrams(F.col("text"))).withColumn("counted", numbered(F.col("plain")))
    candidate = F.struct("rank", "template", "n", "plain", "counted")
    sized = rows.select(F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("size"), candidate.alias("candidate"))
    return sized.groupBy("size").agg(F.collect_list("candidate").alias("candidates"))


def passages(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, number, passage): all lines, and paragraphs of several lines."""
    lines = docs.select("doc_id", F.lit("line").alias("kind"), F.posexplode(F.split("text", "\n", -1)).alias("number", "passage"))
    blocks = docs.where(F.col("text").contains("\n")).select(
        "doc_id", F.lit("paragraph").alias("kind"),
        F.posexplode(F.split("text", r"\n[ \t\r]*\n", -1)).alias("number", "passage"),
    )
    return lines.unionByName(blocks.where(F.col("passage").contains("\n")))


#: Templates of up to so many characters in all are sent to every task; more are joined by a shuffle.
BROADCAST_CHARS = 1_000_000


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, kind, number, template, dice) of each passage that reaches the threshold.

    ``kind`` is line or paragraph, ``number`` counts from 0 within its text.
    """
    templates = TEMPLATES if templates is None else templates
    table = template_table(docs.sparkSession, templates, threshold)
    if sum(map(len, templates.values())) <= BROADCAST_CHARS:
        table = F.broadcast(table)
    words = anchors(templates, threshold)
    found = passages(docs.select("doc_id", "text").where(has_anchor(F.col("text"), words)))
    found = found.where(has_anchor(F.col("passage"), words)).withColumn("normal", normalised(F.col("passage"))).drop("passage")
    found = found.withColumn("size", n_bigrams(F.col("normal")).cast("int")).where("size > 0")
    met = found.join(table, "size").withColumn("plain", bigrams(F.col("normal"))).drop("normal")
    near = F.filter("candidates", lambda t: F.arrays_overlap(F.col("plain"), t["plain"]))
    met = met.withColumn("near", near).drop("candidates").where(F.size("near") > 0)
    met = met.withColumn("counted", numbered(F.col("plain"))).drop("plain")
    scored = F.transform("near", lambda t: F.struct(
        (2.0 * F.size(F.array_intersect("counted", t["counted"])) / (F.col("size") + t["n"])).alias("dice"),
        t["rank"].alias("rank"), t["template"].alias("template"),
    ))
    met = met.withColumn("best", F.array_max(scored)).where(F.col("best.dice") >= threshold)
    return met.select("doc_id", "kind", "number", "best.template", "best.dice")

"""Licence scans with a trained paragraph classifier.

The model is a multinomial logistic regression over the presence of word n-grams (one to three words),
kept sparse by an L1 penalty. It is trained on the labelled table below: notices of each family in
several wordings, and ordinary prose, some of it about licences, as class ``unknown``. A fifth of the
table calibrates the scores (a temperature that minimises the log loss, then a threshold for
reporting a family at all). A reported family is confirmed by comparing the paragraph with the
family's templates: enough of a template's word pairs must stand in it.

A paragraph is a line. Only n-grams with an anchor are features, a word of some notice that is not
a function word; a text without any anchor word can't have a feature and is not looked at line by
line. Scoring uses DataFrame functions inside the row: nothing is shuffled and no key can be hot.

Null text counts as empty: no paragraphs, no licence. Repeated rows are scanned alike; other columns
pass through (columns named like an output are replaced).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
GRAMS = 3
L1 = 0.0003
STEPS = 60
CONFIRM = 0.6
THRESHOLD = 0.5

# fixed values: short notices of public licences, by family
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is available under the Apache 2.0 license",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "licensed under the GNU General Public License, version 3",
        "licensed under the GNU General Public License, version 2 or later",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software under the GPL v3",
    ),
    "lgpl": (
        "licensed under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Use of this source code is governed by a BSD-style license",
        "Licensed under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
        "Text available under CC BY 3.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Text available under CC BY-SA 3.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Text available under CC BY-NC-ND 4.0",
    ),
    "cc0": (
        "dedicated to the public domain under CC0 1.0",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright under CC0",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
    ),
}
# how notices stand in texts; {} is the notice
FRAMES = ("{}", "{}.", "This work is {}.", "This file is {}", "Copyright 2021 the authors. {}", "{}. See the file for details.", "All code in this repository: {}",
          "{} unless stated otherwise", "Note: {}", "The data set is {} and may change")
# words that carry no meaning of their own
FUNCTION_WORDS = frozenset(
    "all an and any are as at be by for from has have in is it law may not of on or other that the them these this to under until up use was with without you your".split())
# ordinary prose, with words of notices in other uses
PROSE = (
    "The driver must carry a valid licence and show it when asked.", "They released the album in the spring of that year.",
    "Permission was granted by the council to build a new road.", "Version 3 of the plan was sent to all members of the group.",
    "The general public is invited to see the new library.", "A copy of the letter was found in the file with the others.",
    "You may obtain tickets at the door or by post.", "The terms of the deal were not made known.", "He is free to use the house by the sea.",
    "The source of the river lies in the hills above the town.", "This is a work of fiction; any likeness to real people is by chance.",
    "She was permitted to leave early without loss of pay.", "The authors thank the reviewers for their notes on an earlier version.",
    "Under the law of that time, no person could own more than one farm.", "The foundation of the old tower is still in good order.",
    "All forms must be sent in with the fee before the end of the month.", "In the public interest, the court let the paper print the story.",
    "The software was slow, and the use of it was not easy.", "Details of the journey are given at the end of the book.",
    "The work is done by hand and takes most of the day.", "A free concert will be held in the park by the lake at 4.",
    "The state sold the right to fish in 2.0 square miles of water.", "International trade grew by 3.0 per cent in the last quarter.",
    "The common people of the country had no say in this.", "He left the attribution of the painting to those who know more.",
    "The binary stars turn about each other in four days.", "It may change with the season, subject to the weather.",
    "Die Leute gehen mit dem Hund in den Wald und sie kommen am Abend heim.", "Le chat est sur la table et il ne veut pas partir.",
    "La casa de mi madre es grande y tiene un patio con flores.", "To the extent possible, we walked; at times we had to swim.",
    "The project was set up to help young people find work.", "Please note that the data in this table are rounded.",
    "The code of the house was simple: no noise after ten.", "An identifier is printed on the back of each card.",
    "A licence fee is paid by each household every year.", "His fishing license ran out in May and was not renewed.",
    "The public domain of the old king is now a park.", "We keep a list of all persons with files at the office.",
    "Use the left door, except on Sunday, in compliance with the house rules.", "They modified the boat so that it could carry more.",
    "The text is set in two columns and printed on thin paper.", "The minister waived all charges against the two men.",
)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits of the basic alphabet."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


def grams(w: Column, sizes: Sequence[int] = range(1, GRAMS + 1)) -> Column:
    """Distinct word n-grams of the given sizes, joined by spaces."""
    def of(n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
        return F.when(F.size(w) >= n, runs).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(of, sizes)))


def labelled(spark: SparkSession) -> DataFrame:
    """The labelled table ``(paragraph, family, fold)``; fold 0 is for calibration."""
    rows = [(frame.format(notice), family) for family, notices in TEMPLATES.items() for notice in notices for frame in FRAMES]
    rows += [(a, UNKNOWN) for a in PROSE] + [(f"{a} {b}", UNKNOWN) for a, b in zip(PROSE, PROSE[7:] + PROSE[:7])]
    table = spark.createDataFrame(rows, "paragraph string, family string").coalesce(1)
    return table.withColumn("fold", F.pmod(F.xxhash64("paragraph"), F.lit(5)))


@cache
def anchors() -> tuple[str, ...]:
    """Words of notices that aren't function words or numbers."""
    return tuple(sorted({w for notices in TEMPLATES.values() for n in notices for w in re.findall("[a-z0-9]+", n.lower()) if len(w) > 1} - FUNCTION_WORDS))


def _model_columns(model: dict) -> dict[str, Column]:
    spec = "struct<classes:array<string>,vocabulary:array<string>,weights:array<array<double>>,intercepts:array<double>,templates:array<struct<family:string,pairs:array<string>>>>"
    whole = F.from_json(F.lit(json.dumps({k: model[k] for k in ("classes", "vocabulary", "weights", "intercepts", "templates")})), spec)
    return {k: whole[k] for k in ("classes", "vocabulary", "weights", "intercepts", "templates")}


def _logits(w: Column, m: dict[str, Column]) -> Column:
    present = F.array_intersect(m["vocabulary"], grams(w))
    return F.aggregate(present, m["intercepts"], lambda acc, g: F.zip_with(
        acc, F.get(m["weights"], F.array_position(m["vocabulary"], g).cast("int") - 1), lambda x, y: x + y))


def fit(spark: SparkSession, l1: float = L1, steps: int = STEPS, threshold: float = THRESHOLD) -> dict:
    """Train on the labelled table. The result holds plain lists; its size is that of the table's n-grams."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer, StringIndexer

    anchored = F.array(*map(F.lit, anchors()))
    table = labelled(spark).withColumn("w", words(F.col("paragraph"))).withColumn(
        "grams", F.filter(grams(F.col("w")), lambda g: F.arrays_overlap(F.split(g, " "), anchored)))
    train = table.filter("fold > 0")
    indexer = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(table)
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0).fit(train)
    regression = LogisticRegression(family="multinomial", regParam=l1, elasticNetParam=1.0, maxIter=steps, standardization=False)
    fitted = regression.fit(counter.transform(indexer.transform(train)).select("label", "features"))
    matrix = fitted.coefficientMatrix.toArray()
    used = [i for i in range(matrix.shape[1]) if abs(matrix[:, i]).max() > 1e-9]
    vocabulary = [counter.vocabulary[i] for i in used]
    pair_lists = [{"family": f, "pairs": _pairs(t)} for f, ts in TEMPLATES.items() for t in ts]
    model = {"classes": list(indexer.labels), "vocabulary": vocabulary, "weights": [matrix[:, i].tolist() for i in used],
             "intercepts": fitted.interceptVector.toArray().tolist(), "templates": pair_lists, "threshold": threshold, "temperature": 1.0}
    held = table.filter("fold = 0").select("family", _logits(F.col("w"), _model_columns(model)).alias("z")).collect()
    place = {c: i for i, c in enumerate(model["classes"])}

    def loss(t: float) -> float:
        total = 0.0
        for r in held:
            z = [x / t for x in r["z"]]
            top = max(z)
            total += top + math.log(sum(math.exp(x - top) for x in z)) - z[place[r["family"]]]
        return total

    model["temperature"] = min((0.25 * 1.15**k for k in range(24)), key=loss)
    return model


def _pairs(text: str) -> list[str]:
    w = re.findall("[a-z0-9]+", text.lower())
    return sorted({" ".join(p) for p in zip(w, w[1:])}) or w


def scanned(docs: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """Add ``n_paragraphs`` and ``licences``: an array of ``(paragraph, family, probability, match)``.

    ``paragraph`` is the line's number from 0, ``match`` the share of the best template found in it.
    """
    model = model or fit(docs.sparkSession)
    m = _model_columns(model)
    anchored = F.array(*map(F.lit, anchors()))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\r?\n")
    candidates = F.filter(F.transform("_lines", lambda x, i: F.struct(i.alias("paragraph"), words(x).alias("w"))), lambda s: F.arrays_overlap(s["w"], anchored))

    def judge(s: Column) -> Column:
        z = F.transform(_logits(s["w"], m), lambda x: x / model["temperature"])
        named = F.transform(F.array(z), lambda v: F.struct(
            F.get(m["classes"], (F.array_position(v, F.array_max(v)) - 1).cast("int")).alias("family"),
            (1 / F.aggregate(v, F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max(v)))).alias("probability")))
        pairs = grams(s["w"], (2,))
        return F.transform(named, lambda r: F.struct(
            s["paragraph"].alias("paragraph"), r["family"].alias("family"), r["probability"].alias("probability"),
            F.coalesce(F.array_max(F.transform(F.filter(m["templates"], lambda t: t["family"] == r["family"]), lambda t: F.size(
                F.array_intersect(t["pairs"], pairs)) / F.size(t["pairs"]))), F.lit(0.0)).alias("match")))

    found = F.filter(F.flatten(F.transform("_lines_found", judge)), lambda r: (r["family"] != UNKNOWN) & (r["probability"] >= model["threshold"]) & (r["match"] >= CONFIRM))
    looked = docs.withColumn("_lines", lines).withColumn("n_paragraphs", F.size(F.filter("_lines", lambda x: F.trim(x) != "")).cast("long"))
    looked = looked.withColumn("_any", F.arrays_overlap(words(F.col(text)), anchored))
    looked = looked.withColumn("_lines_found", F.when(F.col("_any"), candidates).otherwise(F.array().cast("array<struct<paragraph:int,w:array<string>>>")))
    return looked.withColumn("licences", found).drop("_lines", "_any", "_lines_found")

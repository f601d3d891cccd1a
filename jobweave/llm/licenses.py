"""Licence paragraphs: a trained n-gram classifier, a calibrated unknown class and a template comparison.

A paragraph is a line, or a run of lines without a blank one between, as a notice may be wrapped. Its features are its
distinct word 1- and 2-grams, of which only those of the templates carry weight. A multinomial logistic regression
(Spark ML) is trained on variants of the templates, each family with the same weight, and on paragraphs of a bounded
sample of documents as the unknown class; its probabilities are calibrated by a temperature fitted on variants and
paragraphs that were held out. A prediction is a family whose calibrated probability is the largest and at least
`LEAST_PROBABILITY`; it is confirmed if at least `LEAST_SIMILARITY` of the features of one of the family's templates
stand in the paragraph.

All work on the corpus is DataFrame operations. What the classifier does not see could not be confirmed: of s features a
confirmed paragraph lacks at most s - ceil(LEAST_SIMILARITY * s), so it has one of any s - ceil(LEAST_SIMILARITY * s) + 1
of them. `key_grams` takes these among the features that say most, and a line without a word of theirs is left out.
Runs of lines reach from the first to the last line that has one, and a line further at both ends. The tables
of weights and of template features have a row for each n-gram of the fixed templates below, so they may be broadcast
whatever the corpus. Features are aggregated by paragraph, so that a paragraph repeated everywhere is no hot key. A run is
gathered from its lines within one document.

Defined results: null and empty texts have no paragraph; rows that repeat are answered each; null ids stay;
an empty table gives an empty one. Of equally probable families the first by name counts. A run is answered only where
it is confirmed for a family that none of its lines is confirmed for. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

UNKNOWN = "unknown"
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
# Bound of the sample of documents whose paragraphs stand for the unknown class, and of those paragraphs.
SAMPLE_DOCS = 400
SAMPLE_PARAGRAPHS = 3000
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)

# Public notices of the licence families.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl-3.0": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work; see the CC0 public domain dedication.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this work may be reproduced without the permission of the publisher.",
    ),
}
# Words that say nothing of a licence, and words that say little: features of other words are the ones to look for.
COMMON = set(
    "a all an and any are as at be by can do either following for from has have in is it may mit nc no not of on or other part sa that the their them there "
    "this to using was were will with without work writing you your".split()
)
GENERIC = set(
    "agreed author code copy deal except express extent file files form forms into kind later law met only person possible related required see under use version".split()
)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def features(text: Column) -> Column:
    """Distinct 1- and 2-grams of a paragraph."""
    w = words(text)
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(w, pairs))


def _variants() -> list[tuple[str, str, int]]:
    """(family, text, part) of every template as it is, cut at both ends, embedded, and with words left out."""
    rows = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            w = text.split()
            n = len(w)
            made = [text, text, f"Copyright 2020 somebody. {text}" if family == "proprietary" else f"Made in 2020 by somebody. {text}", f"{text} More can be read there.", " ".join(["it", "says", *w, "and", "so", "on"])]
            if n >= 8:
                made += [" ".join(w[: n * 4 // 5]), " ".join(w[n // 5 :])]
                made += [" ".join(w[:i] + w[i + 1 :]) for i in range(0, n, max(1, n // 6))]
            rows += [(family, t, i % 2) for i, t in enumerate(made)]
    return rows


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Local rows as a table; they travel as one JSON literal and need no Python on the executors."""
    import json

    names = [part.split()[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    kind = "array<struct<" + ", ".join(f"{n}: {t}" for n, t in (part.split(" ", 1) for part in schema.split(", "))) + ">>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def template_table(spark: SparkSession) -> DataFrame:
    """template, family, text and size (its number of features)."""
    rows = [(f"{family}/{i}", family, text) for family, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    return _rows(spark, rows, "template string, family string, text string").withColumn("size", F.size(features(F.col("text"))))


def key_grams(text: str) -> list[str]:
    """Features of a template of which every paragraph has one that shares `LEAST_SIMILARITY` of the template's."""
    w = [x for x in re.split("[^a-z0-9]+", text.lower()) if x]
    grams = list(dict.fromkeys([*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]))
    grams.sort(key=lambda g: (-_says(_key_word(g)), -len(g), g))
    return grams[: len(grams) - math.ceil(LEAST_SIMILARITY * len(grams) - 1e-9) + 1]


def _says(word: str) -> int:
    return 0 if word in COMMON or word.isdigit() else 1 if word in GENERIC else 2


def _key_word(gram: str) -> str:
    """The word of an n-gram that says most."""
    return max(gram.split(), key=lambda x: (_says(x), len(x), x))


def key_words() -> list[str]:
    """The words that say most in the key n-grams of all templates."""
    return sorted({_key_word(g) for texts in TEMPLATES.values() for text in texts for g in key_grams(text)})


def has_key(line: Column) -> Column:
    return F.exists(words(line), lambda w: w.isin(*key_words()))


def blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r", "  ")) == ""


def candidates(docs: DataFrame) -> DataFrame:
    """pid, row, run, doc_id, paragraph (number of the first line), n_lines, is_run and text of the lines that have a key
    word and of the runs of such lines, written. `row` tells rows of the table apart, `run` runs of a row."""
    lines = docs.where("text IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), "doc_id", F.split("text", "\n").alias("lines"))
    places = F.filter(F.transform("lines", lambda line, i: F.when(has_key(line), i)), lambda i: i.isNotNull())
    lines = lines.withColumn("hits", places).where(F.size("hits") > 0)

    def hit(i: Column, k: Column) -> Column:
        # Made before the rows are multiplied: a row carries its own lines, not those of the whole text.
        last = F.when(k > 0, F.get("hits", k - 1))
        between = F.slice("lines", F.coalesce(last, F.lit(-1)) + 2, i - F.coalesce(last, F.lit(-1)) - 1)
        near = ~F.exists(between, blank)
        return F.struct(
            i.alias("paragraph"), F.get("lines", i).alias("text"), F.get("lines", i - 1).alias("before"), F.get("lines", i + 1).alias("after"),
            (last.isNull() | ~near).alias("apart"), F.when(last.isNotNull() & near, F.array_join(between, " ")).alias("between"),
        )

    hits = lines.select("row", "doc_id", F.explode(F.transform("hits", hit)).alias("hit")).select("row", "doc_id", "hit.*")
    hits = written(hits, "licence-lines")
    hits = hits.withColumn("run", F.sum(F.col("apart").cast("int")).over(Window.partitionBy("row").orderBy("paragraph")))
    single = hits.select("row", "run", "doc_id", "paragraph", F.lit(1).alias("n_lines"), F.lit(False).alias("is_run"), "text")
    parts = F.array_sort(F.collect_list(F.struct("paragraph", F.when(F.col("apart"), F.lit("")).otherwise(F.col("between")).alias("between"), "text")))
    several = hits.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("paragraph").alias("paragraph"), (F.max("paragraph") - F.min("paragraph") + 1).alias("n_lines"), parts.alias("parts"),
        F.min_by("before", "paragraph").alias("before"), F.max_by("after", "paragraph").alias("after"),
    )
    beside = lambda name: F.when(~blank(F.col(name)), F.col(name))
    several = several.withColumns({"before": beside("before"), "after": beside("after")}).where("n_lines > 1 OR before IS NOT NULL OR after IS NOT NULL")
    own = F.array_join(F.transform("parts", lambda x: F.concat_ws(" ", x["between"], x["text"])), " ")
    start, length = F.col("paragraph") - F.col("before").isNotNull().cast("int"), F.col("n_lines") + F.col("before").isNotNull().cast("int") + F.col("after").isNotNull().cast("int")
    several = several.select("row", "run", "doc_id", start.alias("paragraph"), length.alias("n_lines"), F.lit(True).alias("is_run"), F.concat_ws(" ", "before", own, "after").alias("text"))
    return written(single.unionByName(several).withColumn("pid", F.monotonically_increasing_id()), "licence-candidates")


def unknown_rows(docs: DataFrame) -> DataFrame:
    """Paragraphs of a bounded sample of documents that share little with any template, for the unknown class."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    chosen = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    lines = chosen.select("doc_id", F.explode(F.split("text", "\n")).alias("text")).where("length(text) > 20").distinct()
    clear = lines.where(~has_key(F.col("text")))
    return clear.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_PARAGRAPHS).select(
        F.lit(UNKNOWN).alias("family"), "text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("part")
    )


def _near_misses() -> list[tuple[str, str, int]]:
    """Lines that speak of licences without granting one: also of the unknown class."""
    said = (
        "The driver must show a licence at the desk.", "A fishing license can be bought in the shop.", "He asked for permission to leave the room.",
        "She holds the copyright of the picture.", "Smoking is not permitted in the building.", "The software was distributed to all members.",
        "Poetic license is a matter of taste.", "No permission was needed, and none was given.", "The public domain is a field of study.",
        "Under the terms of the agreement the work went on.",
    )
    return [(UNKNOWN, text, i % 2) for i, text in enumerate(said + said)]


def train(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, float], float]:
    """Weights by n-gram (gram, w: array by class), the classes, their intercepts, and the temperature."""
    spark = docs.sparkSession
    rows = _rows(spark, _variants() + _near_misses(), "family string, text string, part int").unionByName(unknown_rows(docs))
    rows = written(rows.coalesce(1), "licence-training")
    grams = sorted({r["g"] for r in template_table(spark).select(F.explode(features(F.col("text"))).alias("g")).collect()})
    classes = sorted([*TEMPLATES, UNKNOWN])
    number = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))])
    labelled = rows.select("part", F.get(F.map_values(F.map_filter(number, lambda k, v: k == F.col("family"))), F.lit(0)).alias("label"), features(F.col("text")).alias("grams"))
    vectors = CountVectorizerModel.from_vocabulary(grams, "grams", "features").setBinary(True).transform(labelled)
    # Every class weighs the same, however many texts stand for it.
    taught = vectors.where("part = 0")
    sizes = taught.groupBy("label").agg((F.lit(100.0) / F.count(F.lit(1))).alias("weight"))
    taught = written(taught.join(sizes, "label").coalesce(1), "licence-weighted")
    model = LogisticRegression(maxIter=60, regParam=2e-3, family="multinomial", weightCol="weight").fit(taught)
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = _rows(spark, [(g, [float(x) for x in matrix[:, j]]) for j, g in enumerate(grams)], "gram string, w array<double>")
    held = vectors.where("part = 1").withColumn("pid", F.monotonically_increasing_id()).select("pid", "label", "grams")
    held = written(held, "licence-calibration")
    logits = summed(held.select("pid", F.explode("grams").alias("gram")), weights, held.select("pid"), intercepts)
    losses = logits.join(held.select("pid", "label"), "pid").agg(
        *[F.avg(-F.log(F.get(softmax(F.col("z"), t), F.col("label").cast("int")) + 1e-12)).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    ).first()
    best = min(range(len(TEMPERATURES)), key=lambda i: losses[f"t{i}"])
    return weights, classes, dict(zip(classes, map(float, intercepts))), TEMPERATURES[best]


def softmax(z: Column, temperature: float) -> Column:
    top = F.array_max(z)
    odds = F.transform(z, lambda x: F.exp((x - top) / temperature))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return F.transform(odds, lambda x: x / total)


def summed(grams: DataFrame, weights: DataFrame, rows: DataFrame, intercepts) -> DataFrame:
    """pid and z, the logits of every row of `rows`: intercepts plus the weights of its n-grams."""
    k = len(intercepts)
    found = grams.join(F.broadcast(weights), "gram").groupBy("pid").agg(*[F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(k)])
    start = [F.coalesce(F.col(f"z{i}"), F.lit(0.0)) + F.lit(float(x)) for i, x in enumerate(intercepts)]
    return rows.join(found, "pid", "left").select("pid", F.array(*start).alias("z"))


def similarities(grams: DataFrame, templates: DataFrame) -> DataFrame:
    """pid, family, template and similarity: for each family the template with the largest share of its
    features in the paragraph (ties: the first)."""
    sides = templates.select("template", "family", "size", F.explode(features(F.col("text"))).alias("gram"))
    shared = grams.join(F.broadcast(sides), "gram").groupBy("pid", "family", "template").agg((F.count(F.lit(1)) / F.first("size")).alias("similarity"))
    best = shared.groupBy("pid", "family").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "template")).alias("b"))
    return best.select("pid", "family", F.col("b.template").alias("template"), (-F.col("b.s")).alias("similarity"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph, n_lines, family, probability, template, similarity and confirmed for every paragraph that is
    predicted to be of a licence family."""
    weights, classes, intercepts, temperature = train(docs)
    found = candidates(docs)
    grams = found.select("pid", F.explode(features(F.col("text"))).alias("gram"))
    p = summed(grams, weights, found.select("pid"), [intercepts[c] for c in classes]).select("pid", softmax(F.col("z"), temperature).alias("p"))
    top = p.select("pid", F.array_max("p").alias("probability"), F.array_position("p", F.array_max("p")).cast("int").alias("k"))
    named = top.select("pid", "probability", F.get(F.array(*map(F.lit, classes)), F.col("k") - 1).alias("family"))
    likely = named.where((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY))
    compared = similarities(grams, template_table(docs.sparkSession))
    similarity = F.coalesce("similarity", F.lit(0.0))
    judged = found.drop("text").join(likely, "pid").join(compared, ["pid", "family"], "left").withColumn("similarity", similarity)
    judged = written(judged.withColumn("confirmed", F.col("similarity") >= LEAST_SIMILARITY), "licence-paragraphs")
    lines = judged.where("NOT is_run")
    known = lines.where("confirmed").select("row", "run", "family").distinct()
    runs = judged.where("is_run AND confirmed").join(known, ["row", "run", "family"], "left_anti")
    columns = ["doc_id", "paragraph", "n_lines", "family", "probability", "template", "similarity", "confirmed"]
    return lines.select(columns).unionByName(runs.select(columns))

"""Licence scan (native): a trained paragraph classifier.

Every line of every text is scored by a multinomial logistic regression over
hashed word 1- and 2-grams, whose classes are the licence families and
``unknown``. Where the calibrated probability of all families together
reaches MIN_PROBABILITY, each family of at least MIN_SHARE is compared with
its templates, over the line and then over the line in its paragraph: with up
to CONTEXT_CHARS of the CONTEXT_LINES lines on either side, up to the next
blank line, as notices are wrapped over lines. A family is found when
MIN_SIMILARITY of the five-word shingles of one of its templates are there
(templates of fewer words: the whole word sequence). A notice found over
several lines counts once, under the first line that led to it, and not at
all where a line of it is found by itself.

Training rows are the families' templates, whole, without their first or
last words, cut into pieces as wrapping would, and set between paragraphs of
the corpus; ``unknown`` rows are sentences that only speak of licences and at
most MAX_UNKNOWN lines of the corpus (drawn by a threshold on their hash, so
the draw is as large in any corpus). Rows of one in five are left out of the
fit (rows, not templates: variants of their templates are fitted); on them one
temperature is chosen that makes the probabilities fit best. The models are MLlib's, everything runs in the JVM.

Defined cases: null and empty texts have no paragraphs and no findings;
rows repeating doc_id and text are one document for the scan and each get
its findings; of the families found on a line the most similar
stay, all that tie; a corpus without paragraphs is fitted on the sentences alone;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirp.llm.common import stored

UNKNOWN = "unknown"
BUCKETS = 1 << 13
MAX_UNKNOWN = 2000
CONTEXTS = 12
SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
MIN_PROBABILITY = 0.5
MIN_SHARE = 0.05
CONTEXT_LINES = 6
CONTEXT_CHARS = 400
PIECE_WORDS = (6, 10)
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)

# Notices by which licences are declared, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
        "SPDX-License-Identifier: Apache-2.0 OR MIT",
        "SPDX-License-Identifier: MIT OR Apache-2.0",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "SPDX-License-Identifier: Apache-2.0 OR MIT",
        "SPDX-License-Identifier: MIT OR Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "Dedicated to the public domain under CC0 1.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written "
        "permission of the publisher.",
    ],
}
# Sentences that speak of licences and rights without declaring any.
SPEAKING_OF = [
    "You need a driving licence to drive a car in this country.",
    "The officer noted the license plate of the red van.",
    "The film was released under a new title in 1999.",
    "Human rights groups asked for the release of all prisoners.",
    "She reserved a table for two and all rooms were taken.",
    "The general public was not allowed to work on the island.",
    "The band has sold a million copies of the version 2 album.",
    "Permission to land was granted free of charge.",
    "He wrote a foundation course about free software.",
    "The apache helicopter landed near the creek.",
    "All rights and duties of the members are listed in the statutes.",
    "A fishing license is valid for one year under state law.",
]
CLASSES = (*TEMPLATES, UNKNOWN)


def norm_words(par: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(par), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def grams(w: Column) -> Column:
    """Words and pairs of adjacent words."""
    two = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                     lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(w, two)


def shingles(w: Column, k: int = SHINGLE_WORDS) -> Column:
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1))),
        lambda i: F.array_join(F.slice(w, i, k), " ")))


def raw_paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, sig, paragraph, par, above, below): every line of every text, and
    the ends of the lines around it, however long those are."""
    t = F.col(f"`{text}`")
    d = docs.select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(t).alias("sig"), F.split(t, "\n").alias("_p"))
    # _p is read several times, so Catalyst does not inline the split into the lambda
    near = F.transform("_p", lambda x, i: F.struct(
        i.alias("paragraph"), x.alias("par"),
        F.array_join(F.transform(F.slice("_p", F.greatest(i - CONTEXT_LINES, F.lit(0)) + 1, F.least(i, F.lit(CONTEXT_LINES))),
                                 lambda y: F.right(y, F.lit(CONTEXT_CHARS))), "\n").alias("above"),
        F.array_join(F.transform(F.slice("_p", i + 2, F.lit(CONTEXT_LINES)), lambda y: F.left(y, F.lit(CONTEXT_CHARS))), "\n").alias("below")))
    return d.select("d", "sig", F.explode(near).alias("l")).select("d", "sig", "l.*")


def in_paragraph(par: Column, above: Column, below: Column) -> Column:
    """The words of a line with those around it, up to the blank lines."""
    blank = "\n[ \\t-\\r]*\n"
    before = F.element_at(F.split(F.concat(F.right(above, F.lit(CONTEXT_CHARS)), F.lit("\n")), blank), -1)
    after = F.element_at(F.split(F.concat(F.lit("\n"), F.left(below, F.lit(CONTEXT_CHARS))), blank), 1)
    return norm_words(F.concat_ws("\n", before, par, after))


def with_words(pars: DataFrame) -> DataFrame:
    """``pars`` and ``w``, the words of the lines that have some."""
    return pars.withColumn("w", norm_words(F.col("par"))).filter("size(w) > 0")


def template_table(spark: SparkSession) -> DataFrame:
    """(family, w, sh): a template's words and shingles."""
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    df = spark.createDataFrame(rows, "family string, t string").select("family", norm_words(F.col("t")).alias("w"))
    return df.select("family", "w", shingles(F.col("w")).alias("sh"))


def similarity(template_shingles: Column, w: Column) -> Column:
    """Share of the template's shingles in a paragraph's words. The words of
    a template shorter than a shingle must stand in it as a whole."""
    text = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    held = F.filter(template_shingles, lambda s: F.contains(text, F.concat(F.lit(" "), s, F.lit(" "))))
    return F.size(held) / F.size(template_shingles)


def training_rows(spark: SparkSession, pars: DataFrame, max_unknown: int = MAX_UNKNOWN) -> DataFrame:
    """(family, w, part): part 0 of 5 calibrates, the others fit."""
    t = template_table(spark)
    words_of_notices = F.array_distinct(norm_words(F.lit(" ".join(x for ts in TEMPLATES.values() for x in ts))))
    # paragraphs of the corpus that share under half of their words with notices
    taken = F.size(F.array_intersect("w", words_of_notices)) * 2 < F.size(F.array_distinct("w"))
    # the sample is drawn before anything is computed on the lines; as many are expected from any corpus
    pars = pars.select("d", "sig", "paragraph", "par").filter(F.length("par") > 0)
    n = pars.count()
    below = min(1.0, 2 * max_unknown / max(n, 1))
    drawn = pars.withColumn("h", F.xxhash64("d", "sig", "paragraph")).filter(
        F.shiftrightunsigned("h", 11) <= F.lit(int(below * (1 << 53))))
    corpus = stored(drawn.select(norm_words(F.col("par")).alias("w"), "h").filter("size(w) > 0").filter(taken)
                    .orderBy("h").limit(max_unknown), "license_unknown")
    said = spark.createDataFrame([(s,) for s in SPEAKING_OF], "t string").select(norm_words(F.col("t")).alias("w"))
    unknown = corpus.select(F.lit(UNKNOWN).alias("family"), "w").union(said.select(F.lit(UNKNOWN), "w"))
    w = F.col("w")
    cut = t.select("family", F.explode(F.array(
        w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(1))), F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(1))))).alias("w")) \
        .filter("size(w) > 2").union(t.select("family", "w"))
    pieces = [t.filter(F.size("w") >= 2 * k).select("family", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((F.size("w") - 1) / k).cast("int")), lambda i: F.slice("w", i * k + 1, k))).alias("w"))
        for k in PIECE_WORDS]
    for p in pieces:
        cut = cut.union(p.filter("size(w) > 3"))
    # each notice between the words of CONTEXTS corpus paragraphs
    slots = t.select("family", "w", F.explode(F.sequence(F.lit(0), F.lit(CONTEXTS - 1))).alias("i"))
    slots = slots.withColumn("slot", F.pmod(F.xxhash64("w", "i"), F.lit(257)))
    context = corpus.groupBy(F.pmod("h", F.lit(257)).alias("slot")).agg(F.min_by("w", "h").alias("c"))
    inside = slots.join(context, "slot").select("family", F.concat(
        F.when(F.col("i") % 3 != 0, F.slice("c", 1, 8)).otherwise(F.array().cast("array<string>")), "w",
        F.when(F.col("i") % 3 != 1, F.reverse(F.slice("c", 1, 8))).otherwise(F.array().cast("array<string>"))).alias("w"))
    rows = unknown.union(cut).union(inside)
    return rows.select("family", "w", F.pmod(F.xxhash64("w", "family"), F.lit(5)).alias("part"))


def _vectors(df: DataFrame) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True).transform(
        df.withColumn("grams", grams(F.col("w"))))


def _softmax(raw: Column, temperature: float) -> Column:
    top = F.array_max(raw)
    e = F.transform(raw, lambda x: F.exp((x - top) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def train(spark: SparkSession, pars: DataFrame, max_unknown: int = MAX_UNKNOWN) -> tuple[LogisticRegressionModel, float]:
    """The model and its temperature."""
    label = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("family")) - 1
    rows = stored(_vectors(training_rows(spark, pars, max_unknown)).select("features", label.cast("double").alias("label"), "part")
                  .coalesce(2), "license_rows")  # bounded by the templates and max_unknown
    model = LogisticRegression(maxIter=40, regParam=1e-3, family="multinomial").fit(
        rows.filter("part <> 0"))
    held = model.transform(rows.filter("part = 0")).select("label", vector_to_array("rawPrediction").alias("raw"))
    loss = [F.avg(-F.log(F.greatest(F.get(_softmax(F.col("raw"), t), F.col("label").cast("int")), F.lit(1e-12)))).alias(f"t{i}")
            for i, t in enumerate(TEMPERATURES)]
    found = held.agg(*loss).first()  # one row
    best = min(range(len(TEMPERATURES)), key=lambda i: found[i] if found[i] is not None else abs(i - 4))
    return model, TEMPERATURES[best]


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, sig, paragraph, family, probability, whole, similarity) of every
    line that declares a licence, by itself (``whole``) or in its paragraph."""
    spark = docs.sparkSession
    pars = raw_paragraphs(docs, doc_id, text)
    model, temperature = train(spark, pars)
    raw = model.transform(_vectors(with_words(pars))).select("d", "sig", "paragraph", "par", "above", "below", "w",
                                                             vector_to_array("rawPrediction").alias("raw"))
    # through a generator no filter is pushed, so the model runs once a line
    raw = raw.select(F.inline(F.array(F.struct(*raw.columns)))).withColumn("top", F.array_max("raw"))
    e = F.transform("raw", lambda x: F.exp((x - F.col("top")) / temperature))
    raw = raw.withColumn("e", e).withColumn("all", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    raw = raw.filter(1 - F.get("e", F.lit(len(TEMPLATES))) / F.col("all") >= MIN_PROBABILITY)
    likely = raw.select("d", "sig", "paragraph", "w", in_paragraph(F.col("par"), F.col("above"), F.col("below")).alias("wide"),
                        F.posexplode(F.slice("e", 1, len(TEMPLATES))).alias("n", "x"), "all")
    likely = (likely.withColumn("probability", F.col("x") / F.col("all")).filter(F.col("probability") >= MIN_SHARE)
              .withColumn("family", F.get(F.array(*[F.lit(c) for c in CLASSES]), F.col("n"))))
    likely = stored(likely.select("d", "sig", "paragraph", "w", "wide", "family", "probability")
                    .dropDuplicates(["d", "sig", "paragraph", "family"]), "license_likely")
    sim = likely.join(template_table(spark).select("family", "sh"), "family").select(
        "d", "sig", "paragraph", "family", "probability", similarity(F.col("sh"), F.col("w")).alias("alone"),
        similarity(F.col("sh"), F.col("wide")).alias("wide"))
    held = (sim.groupBy("d", "sig", "paragraph", "family", "probability")
            .agg(F.max("alone").alias("alone"), F.max("wide").alias("wide"))
            .withColumn("whole", F.col("alone") >= MIN_SIMILARITY)
            .withColumn("similarity", F.when(F.col("whole"), F.col("alone")).otherwise(F.col("wide")))
            .filter(F.col("similarity") >= MIN_SIMILARITY).drop("alone", "wide"))
    # versions of a licence share most of a notice: the most similar families of a line stay, ties all
    best = F.array_max(F.transform("fs", lambda y: y["similarity"]))
    return (held.groupBy("d", "sig", "paragraph")
            .agg(F.collect_list(F.struct("family", "probability", "whole", "similarity")).alias("fs"))
            .withColumn("best", best)
            .select("d", "sig", "paragraph", F.inline(F.filter("fs", lambda x: x["similarity"] == F.col("best")))))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_licenses, families, found), a row for each document;
    ``found``: (paragraph, family, probability, similarity) in order."""
    f = findings(docs, doc_id, text).groupBy("d", "sig", "family").agg(F.sort_array(F.collect_list(
        F.struct("paragraph", "probability", "similarity", "whole"))).alias("g"))
    # of a notice found over several lines one stays, none beside a line that holds it
    near = lambda x, y: F.abs(x["paragraph"] - y["paragraph"]) <= CONTEXT_LINES
    wrapped = F.filter("g", lambda x: ~x["whole"] & ~F.exists("g", lambda y: y["whole"] & near(x, y)))
    f = f.withColumn("wrapped", wrapped).withColumn("g", F.concat(F.filter("g", lambda x: x["whole"]), F.filter(
        "wrapped", lambda x, i: F.coalesce(~near(x, F.get("wrapped", i - 1)), F.lit(True)))))
    f = f.select("d", "sig", F.explode("g").alias("g"), "family").groupBy("d", "sig").agg(F.sort_array(F.collect_list(
        F.struct("g.paragraph", "family", "g.probability", "g.similarity"))).alias("found"))
    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(t).alias("s"))
    out = rows.join(f, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("s") == F.col("sig")), "left")
    return out.select("doc_id", F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_licenses"),
                      F.coalesce(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["family"]))),
                                 F.array().cast("array<string>")).alias("families"), "found")

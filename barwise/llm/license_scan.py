"""Licence scans with DataFrame and SQL functions only.

A logistic regression over sparse word bigrams tells licence families apart
paragraph by paragraph. It is trained on variants of public notice templates
and, as the unknown class, on the corpus' own paragraphs plus a few notices of
no family. The least probability for a family is calibrated on the unknown
paragraphs of a quarter of the documents, picked by hash, which take no part in
training. The paragraphs of all other documents do. A prediction counts as
confirmed if the paragraph holds enough of one of the family's templates.

Only bigrams that occur in a template have weights, a bounded number. One pass
counts the paragraphs by their set of such bigrams, and each set is one weighted
row to the learner; the scan is another pass: paragraphs, bigrams, a broadcast
join, sums. Paragraphs without such a bigram are unknown and not returned. Null and empty texts have
no paragraphs. Rows that repeat both doc_id and text are returned once. Extra
columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed

#: Public licence notices.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Licensed under the BSD 3-Clause License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
}
#: Notices of no family.
OTHER = [
    "All rights reserved.", "See the file for details.", "Copyright by the authors.",
    "The restaurant lost its license to serve food in the city.", "You need a driving license and the terms of the contract.",
    "The version of this file that you may use is the following.", "The license of this program is not known.",
    "This work is part of a public collection of the university.", "Under the terms of the agreement the company may not use the software.",
]
UNKNOWN = "unknown"
VARIANTS = 40
#: What the corpus' paragraphs weigh together at most, in variants of templates:
#: each of them weighs 1, or less if there are more.
UNKNOWN_WEIGHT = 3000.0
#: Share of a template's bigrams that confirms a prediction.
CONFIRM = 0.7


def bigrams(words: str, known: list[str] | None = None) -> F.col:
    """Distinct bigrams; only those in ``known``, in order, if given."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2),
                        lambda i: F.concat_ws(" ", F.get(F.col(words), i), F.get(F.col(words), i + 1)))
    if known is not None:
        pairs = F.sort_array(F.filter(pairs, lambda g: g.isin(known)))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def paragraph_words(text) -> F.col:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\p{N})"), "")


def paragraphs(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"),
                       F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))


def rows(spark: SparkSession, values: list[dict], schema: str) -> DataFrame:
    """A small constant table, built in the plan."""
    return spark.range(1, numPartitions=1).select(
        F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))


def templates(spark: SparkSession) -> DataFrame:
    """(family, template, grams)."""
    values = [{"family": f, "template": f"{f}-{i}", "line": t} for f, ts in TEMPLATES.items() for i, t in enumerate(ts)]
    return (rows(spark, values, "family string, template string, line string")
            .withColumn("_w", paragraph_words(F.col("line"))).select("family", "template", "_w", bigrams("_w").alias("grams")))


def marked(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, text_hash, paragraph, grams) of every paragraph: its bigrams in
    the vocabulary, a bounded number of constants."""
    key = ["doc_id", "text_hash", "paragraph"]
    return paragraphs(docs).select(*key, paragraph_words(F.col("line")).alias("_w")).select(
        *key, bigrams("_w", vocabulary).alias("grams"))


def unknowns(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(held, grams, n): how many paragraphs of the whole corpus have these
    bigrams, apart for the quarter of documents held back for calibration.
    Paragraphs that hold most of a template are left out."""
    held = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(4)) == 0
    sets = checkpointed(marked(docs, vocabulary).groupBy(held.alias("held"), "grams").agg(F.count(F.lit(1)).alias("n")))
    known = templates(docs.sparkSession).select(F.collect_list("grams").alias("g")).first()["g"]
    like = F.lit(False)
    for g in known:  # a few dozen constants
        like = like | (F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) >= 0.5 * len(g))
    return sets.filter(~like)


def train(docs: DataFrame) -> tuple[list[str], dict[str, list[float]], list[float], float]:
    """Families, weights of each bigram, intercepts, least probability."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array

    spark = docs.sparkSession
    known = checkpointed(templates(spark))
    vocabulary = [r["g"] for r in known.select(F.explode("grams").alias("g")).distinct().orderBy("g").collect()]
    variants = known.select("family", "_w", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v")).select(
        "family", F.filter("_w", lambda w, i: (F.col("v") == 0) | (F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(12)) > 0)).alias("_w"))
    variants = variants.select("family", bigrams("_w").alias("grams"))
    other = (rows(spark, [{"line": t} for t in OTHER], "line string")
             .select(F.lit(UNKNOWN).alias("family"), paragraph_words(F.col("line")).alias("_w"))
             .select("family", F.explode(F.array_repeat(bigrams("_w"), VARIANTS)).alias("grams")))
    sets = unknowns(docs, vocabulary)
    total = sets.filter(~F.col("held")).agg(F.sum("n")).first()[0] or 0
    each = min(1.0, UNKNOWN_WEIGHT / max(total, 1))
    unknown = sets.filter(~F.col("held")).select(F.lit(UNKNOWN).alias("family"), "grams", (F.col("n") * each).alias("weight"))
    names = [UNKNOWN, *TEMPLATES]
    label = F.coalesce(*[F.when(F.col("family") == f, F.lit(float(i))) for i, f in enumerate(names)])
    counts = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features")
    counts.setBinary(True)
    notices = variants.unionByName(other).withColumn("weight", F.lit(1.0)).coalesce(4)
    data = checkpointed(counts.transform(notices.unionByName(unknown)).select(label.alias("label"), "features", "weight"))
    model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, weightCol="weight").fit(data)
    matrix, intercepts = model.coefficientMatrix.toArray(), [float(x) for x in model.interceptVector]
    weights = {g: [float(x) for x in matrix[:, i]] for i, g in enumerate(vocabulary)}
    held = counts.transform(sets.filter("held").select("grams"))
    probability = vector_to_array(F.col("probability"))
    best = model.transform(held).select(F.max(F.array_max(F.slice(probability, 2, len(names) - 1)))).first()[0]
    return names, weights, intercepts, max(0.5, min(0.95, 1.05 * (best or 0.0)))


def scan(docs: DataFrame, confirm: float = CONFIRM) -> DataFrame:
    """(doc_id, text_hash, paragraph, family, score, overlap, confirmed) of
    every paragraph that the classifier gives to a family."""
    spark = docs.sparkSession
    names, weights, intercepts, least = train(docs)
    table = rows(spark, [{"gram": g, **{f"w{i}": x for i, x in enumerate(w)}} for g, w in weights.items()],
                 "gram string, " + ", ".join(f"w{i} double" for i in range(len(names))))
    key = ["doc_id", "text_hash", "paragraph"]
    # an explode of one array, not a filter: that would be pushed down and find the bigrams again
    some = F.explode(F.when(F.size("grams") > 0, F.array("grams"))).alias("grams")
    grams = (marked(docs, list(weights)).select(*key, some).dropDuplicates(key)
             .select(*key, F.explode("grams").alias("gram")))
    # the table has one row for each bigram of the templates above
    sums = grams.join(F.broadcast(table), "gram").groupBy(*key).agg(
        *[(F.sum(f"w{i}") + F.lit(b)).alias(f"z{i}") for i, b in enumerate(intercepts)], F.collect_set("gram").alias("grams"))
    z = [F.col(f"z{i}") for i in range(len(names))]
    top = F.greatest(*z[1:])
    total = sum((F.exp(x - F.greatest(*z)) for x in z[1:]), F.exp(z[0] - F.greatest(*z)))
    family = F.coalesce(*[F.when(x == top, F.lit(f)) for x, f in zip(z[1:], names[1:])])
    said = sums.select(*key, "grams", family.alias("family"), (F.exp(top - F.greatest(*z)) / total).alias("score")).filter(
        F.col("score") >= least)
    known = F.broadcast(templates(spark).select("family", F.col("grams").alias("of")))
    overlap = F.size(F.array_intersect("grams", "of")) / F.size("of")
    return (said.join(known, "family").groupBy(*key, "family", "score").agg(F.max(overlap).alias("overlap"))
            .withColumn("confirmed", F.col("overlap") >= confirm))

"""Licence scans: a paragraph classifier on sparse word n-grams, confirmed against templates.

A paragraph is a line with a word. Its features are the words and word pairs that templates have; a
multinomial logistic regression, trained here, tells the licence families and the class ``unknown``
apart. Training rows are the templates below in several forms (whole, single sentences, with words left out)
and all paragraphs of the corpus that share no word pair with any template: those of equal features are one row
with their number, so the regression has the features of the whole corpus but not its texts. On a
third that is held back, the least probability is set at which a family may be named, so that
of the paragraphs without a licence (each counted) ``FALSE_NAMES`` at most are; below it the class is unknown. A named
family is confirmed if the paragraph shares ``CONFIRM`` of the shorter one's word pairs with one of its templates, so
paragraphs without any pair of a template are passed over before they are classified.

Built-in functions and Spark's own ML library on the JVM only: no Python runs on the executors.

Defined results: a null or empty text has no paragraph, 0 licences and an empty list of families; repeated rows get
equal rows; a null doc_id is like any other; an empty table gives an empty result (the classifier then has templates
and a few fixed sentences to learn from); other columns are not looked at.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import text_or_empty, written

UNKNOWN_WEIGHT = 4_000.0  # weight of all paragraphs of the class ``unknown`` together, however many they are
FALSE_NAMES = 0.005
CONFIRM = 0.6
UNKNOWN = "unknown"

#: Notices of well-known licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT"],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released into the public domain under CC0 1.0."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."],
}
#: Sentences about other things, near in wording.
OTHERS = ["He lost his driving license last year.", "The permission of the owner was needed to enter.", "This work was done in three days.",
          "The public may copy the notice by hand.", "Software is distributed to all schools in the region.", "You may use the following conditions to test it.",
          "The general public is free to visit.", "The rights of the people were reserved for a later debate.", "Released last week, the version has new words."]
LABELS = [UNKNOWN, *TEMPLATES]


@dataclass(frozen=True)
class Scanner:
    model: LogisticRegressionModel
    least: float  # probability from which a family is named


def _forms(text: str, seed: int) -> list[str]:
    """A template whole, its sentences, and both with words left out."""
    rng = random.Random(seed)
    sentences = [s for s in re.split(r"(?<=[.;:]) ", text) if len(s.split()) >= 4]
    out = [text, *sentences]
    for s in list(out):
        words = s.split()
        for _ in range(4):
            out.append(" ".join(w for w in words if rng.random() > 0.1))
    return out


def _literals(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(label, text, part) rows from values in the plan."""
    return spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(float(k)).alias("label"), F.lit(t).alias("text"), F.lit(p).alias("part")) for k, t, p in rows])).alias("r")).select("r.*")


#: Words that say nothing about a licence; a pair of two of them is left out of the comparison with templates.
COMMON = set("the of and to in is a for or by with on at be this that are was from an as it you may not any all no".split())
SEPARATORS = r"(?:[^\p{L}\p{N}.\-]|\.(?![0-9]))+"  # a dot belongs to a word only before a digit


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def _pairs(w: Column) -> Column:
    return F.when(F.size(w) >= 2, F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(w[i], F.lit(" "), w[i + 1]))).otherwise(
        F.array().cast("array<string>"))


def _plain_pairs(text: str) -> list[str]:
    """Word pairs of a template, without those of two common words."""
    w = [x for x in re.split(r"(?:[^\w.\-]|\.(?![0-9]))+", text.lower()) if x]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:]) if not {a, b} <= COMMON))


#: What a paragraph can share with a template: its words but the common ones, its pairs but those of two common words.
TERM_PAIRS = sorted({p for ts in TEMPLATES.values() for t in ts for p in _plain_pairs(t)})
TERM_WORDS = sorted({w for p in TERM_PAIRS for w in p.split(" ")} - COMMON)


def _with_features(rows: DataFrame, terms: str) -> DataFrame:
    """Adds the sparse feature vector of the terms (words, pairs) that templates have."""
    return CountVectorizerModel.from_vocabulary(TERM_WORDS + TERM_PAIRS, inputCol=terms, outputCol="features").setBinary(True).transform(rows)


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _confirmed(pairs: Column, family: str) -> Column:
    """Whether the pairs share enough with a template of the family."""
    def near(template: list[str]) -> Column:
        least = F.least(F.size(F.array_distinct(pairs)), F.lit(len(template)))
        return F.size(F.array_intersect(pairs, _strings(template))) >= F.greatest(least * CONFIRM, F.lit(1))

    out = F.lit(False)
    for t in TEMPLATES[family]:
        if own := _plain_pairs(t):
            out = out | near(own)
    return out


def _hint(pairs: Column) -> Column:
    """Whether a paragraph has any word pair of a template: none can be confirmed without."""
    return F.arrays_overlap(pairs, _strings(TERM_PAIRS))


def paragraphs(docs: DataFrame) -> DataFrame:
    """key, text of every line with a word or a number."""
    rows = docs.select("key", F.explode(F.split("text", "\n")).alias("text"))
    return rows.filter(F.col("text").rlike(r"[\p{L}\p{N}]"))


def _unknown(docs: DataFrame) -> DataFrame:
    """terms, part, n: how many paragraphs without a word pair of a template have these terms, by thirds of the paragraphs."""
    rows = paragraphs(docs).withColumn("_w", words(F.col("text")))
    own = F.sort_array(F.array_distinct(F.filter("_w", lambda w: w.isin(TERM_WORDS))))
    # explode of one value is a barrier: what stands before it is worked out once, not again inside a filter
    rows = rows.select(F.pmod(F.xxhash64("text"), F.lit(3)).cast("int").alias("part"),
                       F.explode(F.array(F.when(~_hint(_pairs(F.col("_w"))), own))).alias("terms")).filter("terms IS NOT NULL")
    return rows.groupBy("terms", "part").agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame) -> Scanner:
    """Classifier from the templates and all paragraphs of the corpus that share no word pair with them."""
    spark = docs.sparkSession
    rows = [(LABELS.index(f), form, (n + k) % 3) for f, ts in TEMPLATES.items() for n, t in enumerate(ts)
            for k, form in enumerate(_forms(t, seed=100 * LABELS.index(f) + n))]
    # short templates are all there is of a licence: each is learnt, and none is in the held back third alone
    rows += [(LABELS.index(f), t, 1) for f, ts in TEMPLATES.items() for t in ts]
    rows += [(0, t, k % 3) for k, t in enumerate(OTHERS)]
    known = _literals(spark, rows).withColumn("_w", words(F.col("text"))).select(
        "label", "part", F.concat("_w", _pairs(F.col("_w"))).alias("terms"), F.lit(1).cast("bigint").alias("n"),
        F.when(F.col("label") > 0, 20.0).otherwise(1.0).alias("weight"))
    plain = written(_unknown(docs), "unknown")
    each = min(1.0, UNKNOWN_WEIGHT / (plain.agg(F.sum("n")).first()[0] or 1))
    data = known.unionByName(plain.select(F.lit(0.0).alias("label"), "part", "terms", "n", (F.col("n") * each).alias("weight")))
    data = written(_with_features(data, "terms").drop("terms"), "licence-rows")
    model = LogisticRegression(maxIter=30, regParam=1e-4, family="multinomial", weightCol="weight").fit(data.filter("part > 0 OR label > 0"))
    back = model.transform(data.filter("part = 0")).select(
        "label", "n", F.array_max(F.slice(vector_to_array("probability"), 2, len(LABELS))).alias("p"))
    wrong = back.filter("label = 0").agg(F.percentile("p", F.lit(1 - FALSE_NAMES), F.col("n"))).first()[0] or 0.0
    return Scanner(model, min(0.8, max(0.5, wrong)))


def scan_paragraphs(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """key, text, family, probability of every paragraph that names a licence family and is confirmed."""
    # explode of one value is a barrier: what stands before it is worked out once, not again inside a filter
    rows = paragraphs(docs).withColumn("_w", words(F.col("text"))).withColumn("_p", _pairs(F.col("_w")))
    rows = rows.select("key", "text", F.explode(F.array(F.when(_hint(F.col("_p")), F.col("_p")))).alias("pairs")).filter("pairs IS NOT NULL")
    told = rows.withColumn("_t", F.concat(words(F.col("text")), "pairs"))
    told = scanner.model.transform(_with_features(told, "_t")).select("key", "text", F.explode(F.array(F.struct(
        "prediction", F.array_max(vector_to_array("probability")).alias("probability"), "pairs"))).alias("r")).select("key", "text", "r.*")
    named = told.filter((F.col("prediction") > 0) & (F.col("probability") >= scanner.least))
    sure = F.lit(False)
    for family in TEMPLATES:
        sure = sure | ((F.col("prediction") == LABELS.index(family)) & _confirmed(F.col("pairs"), family))
    return named.filter(sure).select("key", "text", F.element_at(_strings(LABELS), (F.col("prediction") + 1).cast("int")).alias("family"), "probability")


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """doc_id, n_licences (paragraphs), families (sorted, comma between) of every row."""
    docs = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64("doc_id", text_or_empty()).alias("key"))
    scanner = scanner or train(docs)
    found = scan_paragraphs(docs.select("key", "text"), scanner)
    # rows that repeat have one key: each has an equal share of its paragraphs
    per = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.concat_ws(",", F.sort_array(F.collect_set("family"))).alias("families"))
    times = docs.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    per = per.join(times, "key").select("key", F.floor(F.col("n") / F.col("times")).alias("n"), "families")
    return docs.select("doc_id", "key").join(written(per, "licences"), "key", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_licences"), F.coalesce("families", F.lit("")).alias("families"))

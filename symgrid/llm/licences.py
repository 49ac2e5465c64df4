"""Licence notices by a trained paragraph classifier.

A paragraph is a run of adjacent lines that are joined where the last word of one and the first word of the next
are an n-gram of a notice, so a hard-wrapped notice is one paragraph, and a line by itself otherwise; a line without words joins nothing.
It is named by its first line. Its features are word n-grams (two and three words) that occur in licence
notices; a multinomial logistic regression gives each family's weight for each of them. It is trained on
parts of the notices below and on paragraphs of at most SAMPLE documents (lowest hash of the id first) that have no licence word, which
teach the class ``none``. The class ``unknown`` is taught by licence wording that belongs to no
family. Probabilities are calibrated by one temperature, chosen by likelihood on parts held out from training. A family
is confirmed when the paragraph holds MIN_COVERED of the n-grams of one of its notices, and one with the number if that notice
has a number, so a version is never guessed; a prediction below MIN_PROBABILITY or
not confirmed is reported as ``unknown``.

Only DataFrame functions and Spark's own regression are used. N-grams are looked for where a
paragraph is read, among literals whose number is fixed by the notices. What follows works on the few paragraphs with any of the n-grams.

Defined results: NULL and empty texts, and paragraphs without any of the n-grams or licence words, give no row; licence wording that
shares no n-gram with any notice is ``unknown``, with probability NULL, as the classifier knows nothing of it;
repeated rows give repeated results; a NULL ``doc_id`` stays NULL; other columns are ignored; an empty table gives an empty
result. Plain prose below teaches the class ``none`` besides the sample, so a table of notices alone keeps them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symgrid.llm.common import sampled_ids, staged

SAMPLE = 1500
MIN_PROBABILITY = 0.5
MIN_COVERED = 0.5
#: One part in HELD_OUT of the training paragraphs chooses the temperature.
HELD_OUT = 5
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)
NONE, UNKNOWN = "none", "unknown"

# Wording of public licence notices, and licence wording of no family.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL", "Licensed under the GNU Lesser General Public License."),
    ("LGPL", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
    (UNKNOWN, "See the license terms in the accompanying file."),
    (UNKNOWN, "This work is licensed under its own terms."),
    (UNKNOWN, "Licensed under the terms of another public license, version 1."),
    (UNKNOWN, "Released under the license of the project."),
    (UNKNOWN, "Permission is granted to copy this text."),
]
# Plain prose that shares n-grams with the notices, so that there is a class none whatever the table holds.
PROSE = [
    "You may find the rest of the story in the next part of the book.",
    "The terms of the treaty were signed by the king and the queen.",
    "All of the people of this town may go to the market without a ticket.",
    "He was granted a day free of work and spent it with the children.",
    "The source of the river is in the hills to the north.",
    "Use the form on the last page, or the back of it, and send it to the office.",
    "The work of the year is subject to the weather of the season.",
    "To the extent of the field there was nothing but snow and the sound of the wind.",
]
LICENCE_WORDS = r"(?i)licen[sc]e|copyright|permission|permitted|rights reserved|public domain|redistribut|\bcc by|\bcc0"


def grams(text: Column) -> Column:
    """Distinct n-grams of two and three words of a paragraph, in lower case."""
    found = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    return F.transform(F.array(found), lambda w: F.array_distinct(
        F.concat(
            F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))),
            F.transform(
                F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)),
            ),
        )
    ))[0]


def _end_word(line: Column) -> Column:
    """The first word of a line, or an empty string."""
    return F.regexp_extract(line, r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1)


def paragraphs(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, paragraph, line): the paragraphs of each text, each with its first line's number, its lines joined with blanks."""
    pairs = [gram for gram in vocabulary if gram.count(" ") == 1]
    # Values used in a lambda are bound by one-element arrays; as columns they would be computed again for each line.
    bound = lambda value, f: F.transform(F.array(value), f)[0]

    def runs(lines: Column) -> Column:
        firsts = F.transform(lines, lambda x: _end_word(F.lower(x)))
        lasts = F.transform(lines, lambda x: F.reverse(_end_word(F.reverse(F.lower(x)))))
        places = bound(lasts, lambda last: F.transform(
            firsts, lambda x, i: F.when((i > 0) & F.concat(F.get(last, i - 1), F.lit(" "), x).isin(pairs), -1).otherwise(i)
        ))
        return bound(F.filter(places, lambda i: i >= 0), lambda starts: F.transform(starts, lambda i, k: F.struct(
            i.alias("paragraph"),
            F.array_join(F.slice(lines, i + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - i), " ").alias("line"),
        )))

    return docs.select("doc_id", F.inline(bound(F.split(F.coalesce("text", F.lit("")), "\n"), runs)))


def _parts(notice: str) -> list[str]:
    """The notice, and its parts of at least 60 % of its words."""
    found = notice.split(" ")
    least = max(min(3, len(found)), math.ceil(0.6 * len(found)))
    return [" ".join(found[i : i + n]) for n in range(least, len(found) + 1) for i in range(len(found) - n + 1)]


def training_rows(docs: DataFrame, vocabulary: list[str], sample: int = SAMPLE) -> DataFrame:
    """(paragraph, family, whole): notices and their parts, and paragraphs of a bounded sample of texts without licence words."""
    spark = docs.sparkSession
    parts = [(part, family, part == notice) for family, notice in NOTICES for part in _parts(notice)]
    parts += [(line, NONE, True) for line in PROSE]
    known = spark.createDataFrame(parts, "paragraph string, family string, whole boolean")
    texts = docs.where(F.length("text") > 0)
    chosen = texts.join(F.broadcast(sampled_ids(texts, sample)), "doc_id")
    others = (
        paragraphs(chosen, vocabulary).select(F.col("line").alias("paragraph"))
        .where((F.length("paragraph") > 0) & ~F.col("paragraph").rlike(LICENCE_WORDS))
        .select("paragraph", F.lit(NONE).alias("family"), F.lit(False).alias("whole"))
    )
    return known.union(others)


@dataclass
class Classifier:
    """Weights per n-gram and family, the temperature of the probabilities, and the n-grams of each notice."""

    vocabulary: list[str]
    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    notices: list[tuple[str, list[str]]]

    def probabilities(self, hits: DataFrame) -> DataFrame:
        """``hits`` (row, hits) with the calibrated probability of each family, in order."""
        table = [(gram, *map(float, row)) for gram, row in zip(self.vocabulary, self.weights.T, strict=True)]
        names = [f"w{k}" for k in range(len(self.families))]
        weights = hits.sparkSession.createDataFrame(table, "gram string, " + ", ".join(f"{name} double" for name in names))
        logits = (
            hits.select("row", F.explode("hits").alias("gram"))
            .join(F.broadcast(weights), "gram")  # as many rows as the notices have n-grams
            .groupBy("row")
            .agg(F.array(*(F.sum(name) + float(b) for name, b in zip(names, self.bias, strict=True))).alias("logits"))
        )
        largest = logits.withColumn("most", F.array_max("logits"))
        scaled = largest.select("row", F.transform("logits", lambda x: F.exp((x - F.col("most")) / self.temperature)).alias("scaled"))
        whole = scaled.withColumn("whole", F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x))
        return whole.select("row", F.transform("scaled", lambda x: x / F.col("whole")).alias("probabilities"))

    def covered(self, hits: Column, family: Column) -> Column:
        """Largest share of a notice's n-grams, among the notices of the family, that the paragraph holds.

        A notice with a number has none without an n-gram with a number.
        """

        def share(own: list[str]) -> Column:
            held = F.size(F.array_intersect(hits, F.array(*map(F.lit, own)))) / len(own)
            numbered = [gram for gram in own if any(map(str.isdigit, gram))]
            return F.when(F.arrays_overlap(hits, F.array(*map(F.lit, numbered))), held).otherwise(0.0) if numbered else held

        return F.greatest(*(F.when(family == name, share(own)).otherwise(0.0) for name, own in self.notices))


def train(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Logistic regression over the notices' n-grams."""
    spark = docs.sparkSession
    own = spark.createDataFrame(NOTICES, "family string, notice string").select("family", grams(F.col("notice")).alias("grams")).collect()
    vocabulary = sorted({gram for row in own for gram in row.grams})
    families = [NONE, UNKNOWN, *sorted({family for family, _ in NOTICES} - {UNKNOWN})]
    counted = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features")
    label = reduce(lambda c, f: c.when(F.col("family") == f, F.lit(float(families.index(f)))), families[1:], F.when(F.col("family") == NONE, F.lit(0.0)))
    rows = training_rows(docs, vocabulary, sample).select(grams(F.col("paragraph")).alias("grams"), label.alias("label"), (~F.col("whole") & (F.xxhash64("paragraph") % HELD_OUT == 0)).alias("held"))
    weighted = counted.transform(rows).where("size(grams) > 0").cache()
    learner = LogisticRegression(family="multinomial", maxIter=40, regParam=0.002, elasticNetParam=0.0, standardization=False)
    learner.setWeightCol("weight")
    sizes = weighted.where(~F.col("held")).groupBy("label").count().withColumnRenamed("label", "of")
    # Every family weighs the same, and so does none.
    weighing = weighted.where(~F.col("held")).join(sizes, F.col("label") == F.col("of")).withColumn("weight", 100.0 / F.col("count"))
    model = learner.fit(weighing)
    # The loss of each temperature over all paragraphs held out, by one aggregate.
    held = model.transform(weighted.where("held")).select(vector_to_array("rawPrediction").alias("logits"), F.col("label").cast("int").alias("label"))
    above = held.select(F.transform("logits", lambda x: x - F.array_max("logits")).alias("logits"), "label")

    def loss(temperature: float) -> Column:
        whole = F.aggregate("logits", F.lit(0.0), lambda total, x: total + F.exp(x / temperature))
        return F.avg(F.log(whole) - F.get("logits", F.col("label")) / temperature)

    losses = above.agg(*(loss(temperature).alias(str(k)) for k, temperature in enumerate(TEMPERATURES))).first()
    weighted.unpersist()
    temperature = 1.0 if losses[0] is None else min(zip(losses, TEMPERATURES, strict=True))[1]
    found = len(model.interceptVector)
    notices = [(row.family, list(row.grams)) for row in own if row.family != UNKNOWN]
    return Classifier(vocabulary, families[:found], model.coefficientMatrix.toArray(), model.interceptVector.toArray(), temperature, notices)



def find_licences(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per paragraph that is a licence notice of a family, or licence wording of an unknown one."""
    classifier = train(docs.select("doc_id", "text"), sample)
    # A paragraph without any of the n-grams is of the class none, or unknown if it is licence wording. The one-element array keeps the n-grams from being computed twice.
    known = F.filter(grams(F.col("line")), lambda gram: gram.isin(classifier.vocabulary))
    hit = paragraphs(docs, classifier.vocabulary).select("doc_id", "paragraph", F.explode(F.filter(F.array(known), lambda found: (F.size(found) > 0) | F.col("line").rlike(LICENCE_WORDS))).alias("hits"))
    hits = staged(hit.withColumn("row", F.monotonically_increasing_id()), "licence-hits")
    best = F.array_position("probabilities", F.array_max("probabilities"))
    named = F.element_at(F.array(*map(F.lit, classifier.families)), best.cast("int"))
    judged = (
        classifier.probabilities(hits)
        .select("row", named.alias("predicted"), F.array_max("probabilities").alias("probability"))
        .where(F.col("predicted") != NONE)
        .join(hits, "row")
    )
    compared = judged.withColumn("covered", classifier.covered(F.col("hits"), F.col("predicted")))
    sure = (F.col("probability") >= MIN_PROBABILITY) & (F.col("covered") >= MIN_COVERED)
    paragraph = F.col("paragraph").cast("long").alias("paragraph")
    found = compared.select(
        "doc_id", paragraph, F.when(sure, F.col("predicted")).otherwise(UNKNOWN).alias("family"), "probability", "covered", sure.alias("confirmed")
    )
    worded = hits.where(F.size("hits") == 0).select(
        "doc_id", paragraph, F.lit(UNKNOWN).alias("family"), F.lit(None).cast("double").alias("probability"),
        F.lit(0.0).alias("covered"), F.lit(False).alias("confirmed"),
    )
    return found.union(worded)

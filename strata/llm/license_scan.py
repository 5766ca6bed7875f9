"""Licence scan with a trained paragraph classifier, in DataFrame functions and
Spark's own (JVM) logistic regression only.

A document's units are its sentences, line by line.  A multinomial logistic
regression, made sparse by an L1 penalty, over the templates' bigrams and those
of their words that only one family has, tells licence families from ordinary
text.  Its "unknown" answer is calibrated: a family is named above a high
quantile of what the model, and models that were not trained on them, give to
the ordinary units, within 0.5 to 0.95.  A named family is then
compared with the family's templates: the share of the unit's bigrams that they
hold, or the share of a template's bigrams (whole or a sentence) that a window
of the unit holds, must reach ``MIN_SHARE`` to confirm it.  A unit that reaches
it only by a window, a notice inside a longer line, is classified by the words
of its best window.

A screen runs before the classifier: it drops units that hold too few template
bigrams to reach ``MIN_SHARE`` either way.  No unit that could be confirmed is
lost by it; units that the model alone would name, unconfirmed, are.

The templates below, whole, by sentence and by clause, are
the labelled examples; the ordinary units are all units of the corpus, each
occurrence counted, without those that speak of licences at all.  Units of the
same features are one weighted row of the training, so its rounds read
different feature sets, not units; the model and its bound come from every
unit.  One map reads the texts: it keeps the features of units that have any
(the others are alike and only counted) and the text of those that the screen
lets pass; training and scoring read what it kept.

Defined cases: null or empty text has no units; repeated rows are each
reported; extra columns are ignored; an empty corpus trains on the built-in
ordinary units alone and gives no rows.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table

CLEAN_QUANTILE = 0.999
MIN_SHARE = 0.6
CLAUSE = 4  # words of a template's clause that is an example by itself
SLACK = 1.5  # a window's bigrams to its template's
UNKNOWN = "unknown"

# Public licence notices, as their licences word them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction. The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "creative-commons": (
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY-NC-ND 3.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright 2020 The Authors. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written "
        "permission of the publisher.",
    ),
}
ORDINARY = (
    "He renewed his driving license last week.",
    "The license of the restaurant was under review.",
    "She released the book under a new name.",
    "Version 2 of the game was released in May.",
    "The general public was admitted free of charge.",
    "The reserved seats on the right are all taken.",
    "This work is hard.",
    "Copy the file and open it.",
)
_ABOUT = r"(?i)licen[cs]|copyright|rights reserved|public domain|creative commons|\bgnu\b|permitted|warrant"


def units_of(text: Column) -> Column:
    """Sentences, line by line, trimmed, none without a word."""
    return F.filter(
        F.transform(F.split(F.coalesce(text, F.lit("")), r"\n|(?<=[.!?;:])\s+(?=\p{Lu})"), F.trim),
        lambda u: u.rlike(r"[\p{L}\p{N}]"),
    )


def _words(unit: Column) -> Column:
    return F.filter(F.split(F.lower(unit), r"[^\p{L}\p{N}.+-]+|[.](?=\s|$)"), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    """Neighbouring words joined; a single word stands for itself."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)),
    )
    return F.when(F.size(words) > 1, pairs).otherwise(words)


def _template_bigrams() -> list[tuple[int, list[str]]]:
    """Family (from 0) and different bigrams of the templates, whole and by
    sentence, as ``_bigrams`` makes them."""
    out = []
    for k, texts in enumerate(TEMPLATES.values()):
        for t in texts:
            for part in dict.fromkeys((t, *re.split(r"(?<=[.!?;:])\s+(?=[A-Z])", t))):
                words = [w for w in re.split(r"[^\w.+-]+|[.](?=\s|$)", part.lower()) if w]
                pairs = [f"{x} {y}" for x, y in zip(words, words[1:], strict=False)] or words
                out.append((k, list(dict.fromkeys(pairs))))
    return out


def _one_family() -> list[str]:
    """Template words that only one family has."""
    owners: dict[str, set[int]] = {}
    for k, t in _template_bigrams():
        for w in (w for b in t for w in b.split(" ")):
            owners.setdefault(w, set()).add(k)
    return sorted(w for w, ks in owners.items() if len(ks) == 1)


def _fence() -> Column:
    """Adds 0, but keeps filters and later columns from repeating what is below."""
    return F.least(F.monotonically_increasing_id(), F.lit(0))


def _read(units: DataFrame) -> DataFrame:
    """``words``, ``bigrams``, ``held`` (the template bigrams among them), ``own``
    (words of one family) and ``passes`` (the unit could be confirmed) added."""
    given = _template_bigrams()
    every = sorted({b for _, t in given for b in t})
    df = units.withColumn("words", _words(F.col("unit"))).withColumn("bigrams", _bigrams(F.col("words")))
    df = df.withColumn("held", F.filter("bigrams", lambda b: b.isin(*every)))
    # any share of MIN_SHARE takes two bigrams, or one where all are one
    single = [t[0] for _, t in given if len(t) == 1]
    one = (F.size(F.array_distinct("bigrams")) == 1) | F.exists("bigrams", lambda b: b.isin(*single))
    count = F.size("held") + _fence()
    return df.withColumns(
        {
            "own": F.filter("words", lambda w: w.isin(*_one_family())),
            "passes": (count >= 2) | (count >= 1) & one,
        }
    )


def _terms() -> Column:
    """The different features of a unit, of ``_read``'s columns."""
    return F.array_sort(F.array_union("held", "own")).alias("terms")


def _matched(units: DataFrame) -> DataFrame:
    """``shares`` (by family: the larger of the unit's and the best window's)
    and ``words`` to classify added; only units with a share of ``MIN_SHARE``."""
    given = _template_bigrams()
    strings = lambda bs: F.array(*map(F.lit, bs))
    families = F.array(
        *(strings(sorted({b for f, t in given if f == k for b in t})) for k in range(len(TEMPLATES)))
    )
    templates = F.array(*(F.struct(F.lit(k).alias("k"), strings(t).alias("b")) for k, t in given))
    df = _read(units).where("passes")

    def window(t: Column) -> Column:
        size = F.size(t["b"])
        length = F.ceil(size * SLACK).cast("int")
        hits = F.filter(
            F.sequence(F.lit(1), F.size("bigrams")),
            lambda i: F.array_contains(t["b"], F.get(F.col("bigrams"), i - 1)),
        )
        best = F.array_max(
            F.transform(
                hits,
                lambda i: F.struct(
                    (F.size(F.array_intersect(F.slice("bigrams", i, length), t["b"])) / size).alias("share"),
                    (-i).alias("at"),
                    length.alias("length"),
                    t["k"].alias("k"),
                ),
            )
        )
        return F.when(F.size(F.array_intersect(F.col("bigrams"), t["b"])) >= MIN_SHARE * size, best)

    df = df.withColumns(
        {
            "_whole": F.transform(
                families,
                lambda f: F.size(F.array_intersect(F.col("bigrams"), f)) / F.size(F.array_distinct("bigrams")),
            ),
            "_windows": F.filter(F.transform(templates, window), lambda w: w.isNotNull()),
        }
    )
    df = df.withColumn(
        "shares",
        F.transform(
            "_whole",
            lambda v, k: F.greatest(
                v,
                F.array_max(
                    F.transform(F.filter("_windows", lambda w: w["k"] == k), lambda w: w["share"])
                ),
            ),
        ),
    )
    df = df.withColumn("_most", F.array_max("shares") + _fence()).where(F.col("_most") >= MIN_SHARE)
    best = F.array_max("_windows")
    words = F.when(
        F.array_max("_whole") < MIN_SHARE, F.slice("words", -best["at"], best["length"] + 1)
    ).otherwise(F.col("words"))
    return df.select(*units.columns, "shares", words.alias("words"))


def _featured(df: DataFrame) -> DataFrame:
    """``features`` of ``terms``, or of ``words`` where there are no terms yet."""
    if "terms" not in df.columns:
        df = df.withColumn("terms", F.concat("words", _bigrams(F.col("words"))))
    names = {b for _, t in _template_bigrams() for b in t} | set(_one_family())
    return CountVectorizerModel.from_vocabulary(
        sorted(names), inputCol="terms", outputCol="features", binary=True
    ).transform(df)


def _clauses() -> list[tuple[int, str]]:
    """The templates' clauses of ``CLAUSE`` words or more, as (family from 1,
    words); without those that occur in templates of several families."""
    owners: dict[str, set[int]] = {}
    for k, texts in enumerate(TEMPLATES.values()):
        for part in (p for text in texts for p in re.split(r"[,;:()]\s+", text)):
            if len(part.split()) >= CLAUSE:
                owners.setdefault(part, set()).add(k + 1)
    return [(min(ks), part) for part, ks in owners.items() if len(ks) == 1]


def _examples(spark: SparkSession) -> DataFrame:
    """The templates, whole, by sentence and by clause, and the built-in ordinary units."""
    rows = [(k + 1, t) for k, f in enumerate(TEMPLATES.values()) for t in f] + [(0, t) for t in ORDINARY]
    inline = lambda rows: F.inline(
        F.array(*(F.struct(F.lit(k).alias("label"), F.lit(t).alias("text")) for k, t in rows))
    )
    whole = spark.range(1).select(inline(rows))
    units = whole.select("label", F.explode(F.array_union(units_of(F.col("text")), F.array("text"))).alias("unit"))
    return units.union(spark.range(1).select(inline(_clauses()))).distinct()


class LicenceModel:
    def __init__(self, model: LogisticRegressionModel, least: float):
        self.model, self.least = model, least

    def classify(self, units: DataFrame) -> DataFrame:
        """``family`` (or unknown), ``probability``, ``share`` and ``confirmed`` added
        to ``unit``, of units that could be confirmed."""
        scored = self.model.transform(_featured(_matched(units))).withColumn(
            "p", vector_to_array("probability")
        )
        # no filter on the answer is pushed below, where it would repeat the model for every use
        best = F.array_max("p") + _fence()
        names = F.array(*map(F.lit, (UNKNOWN, *TEMPLATES)))
        family = F.get(names, F.col("prediction").cast("int"))
        scored = scored.withColumn("best", best).withColumn(
            "family", F.when(F.round("best", 6) > self.least, family).otherwise(UNKNOWN)
        )
        share = F.coalesce(F.get("shares", F.col("prediction").cast("int") - 1), F.lit(0.0))
        return scored.select(
            *units.columns,
            "family",
            F.round("best", 4).alias("probability"),
            F.round(share, 4).alias("share"),
            ((F.col("family") != UNKNOWN) & (share >= MIN_SHARE)).alias("confirmed"),
        )


def kept_units(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The units that have a feature, and each document's first: ``keep``,
    ``unit_no``, ``unit`` (null unless the screen lets it pass), ``terms``,
    ``about`` (speaks of licences), ``fold`` (0 or 1) and ``n`` (the document's
    units, with its first one only)."""
    units = docs.select(F.struct(*keep).alias("keep"), units_of(F.col("text")).alias("units"))
    units = units.withColumn("n", F.size("units") + _fence())
    units = units.select("keep", "n", F.posexplode("units").alias("unit_no", "unit"))
    read = _read(units).where((F.size("held") + F.size("own") > 0) | (F.col("unit_no") == 0))
    return read.select(
        "keep",
        "unit_no",
        F.when(F.col("passes"), F.col("unit")).alias("unit"),
        _terms(),
        F.col("unit").rlike(_ABOUT).alias("about"),
        F.pmod(F.xxhash64("unit", F.lit(4)), F.lit(2)).alias("fold"),
        F.when(F.col("unit_no") == 0, F.col("n")).alias("n"),
    )


def training_rows(kept: DataFrame) -> DataFrame:
    """Weighted rows of all ordinary units and the examples: ``label``, ``terms``,
    ``n`` (units), of them ``n0`` and ``n1`` of the corpus by fold."""
    featured = F.size("terms") > 0
    total = kept.agg(F.sum("n").alias("units"), F.count_if(featured).alias("featured")).first()
    plain = (total["units"] or 0) - total["featured"]
    spark = kept.sparkSession
    alike = spark.range(0, 1, 1, 1).select(
        F.array().cast("array<string>").alias("terms"),
        F.lit(plain - plain // 2).cast("long").alias("n0"),
        F.lit(plain // 2).cast("long").alias("n1"),
    )
    ordinary = (
        kept.where(featured & ~F.col("about"))
        .groupBy("terms")
        .agg(F.sum(1 - F.col("fold")).alias("n0"), F.sum("fold").alias("n1"))
        .unionByName(alike)
        .select(F.lit(0).alias("label"), "terms", (F.col("n0") + F.col("n1")).alias("n"), "n0", "n1")
    )
    zero = F.lit(0).cast("long")
    examples = _read(_examples(spark)).select(
        "label", _terms(), (zero + 1).alias("n"), zero.alias("n0"), zero.alias("n1")
    )
    return ordinary.unionByName(examples).where("n > 0")


def _fit(rows: DataFrame, n: Column) -> LogisticRegressionModel:
    """The classifier of ``rows``, each taken ``n`` times."""
    rows = rows.withColumn("n", n).where("n > 0")
    # the few examples of each family weigh as much as the ordinary units
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    weight = F.create_map(*(F.lit(x) for k, of in sizes.items() for x in (k, 1 / (len(sizes) * of))))
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="w", family="multinomial", maxIter=60,
        elasticNetParam=0.5, regParam=0.002, standardization=False,
    ).fit(rows.withColumn("w", F.col("n") * weight[F.col("label")]))


def train(kept: DataFrame) -> LicenceModel:
    """Fit on the templates and every ordinary unit of ``kept_units``.  The bound
    takes the larger of two answers to each ordinary unit: the model's, and that
    of a model fitted without the unit's fold."""
    rows = checkpointed(_featured(training_rows(kept)))
    model = _fit(rows, F.col("n"))
    clean = rows.where("n0 + n1 > 0").select("features", "n0", "n1")
    fitted = {"p": model, "p0": _fit(rows, F.col("n") - F.col("n0")), "p1": _fit(rows, F.col("n") - F.col("n1"))}
    for name, m in fitted.items():
        answer = F.array_max(F.slice(vector_to_array("probability"), 2, len(TEMPLATES)))
        clean = m.transform(clean).withColumn(name, answer).drop("rawPrediction", "probability", "prediction")
    by_fold = F.array(
        *(
            F.struct(F.round(F.greatest("p", f"p{k}"), 6).alias("at"), F.col(f"n{k}").alias("units"))
            for k in (0, 1)
        )
    )
    high = clean.select(F.inline(by_fold)).agg(F.percentile("at", CLEAN_QUANTILE, F.col("units"))).first()[0]
    return LicenceModel(model, min(0.95, max(0.5, high or 0.0)))


def find_licences(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per unit that some family claims and whose bigrams reach
    ``MIN_SHARE`` for a family (see the screen above): ``keep``, ``unit_no`` (from 0),
    ``unit``, ``family``, ``probability``, ``share``, ``confirmed``."""
    kept = checkpointed(kept_units(docs, keep))
    units = kept.where("unit is not null").select("keep", "unit_no", "unit")
    found = train(kept).classify(units).where(F.col("family") != UNKNOWN)
    return found.select("keep.*", *(c for c in found.columns if c != "keep"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_licences(table(spark, sf_dir, "documents"))
    return found.where("confirmed").select("doc_id", "unit_no", "family", "probability", "share")


QUERIES = {"op3_license_scan": op3}

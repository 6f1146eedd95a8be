"""License scan: a trained paragraph classifier, all in DataFrame operations.

A unit (a line, or a window over following lines, for notices that are wrapped)
is reduced to the words it shares with the vocabulary of the license templates;
its features are those words and their neighbouring pairs.  A multinomial logistic regression over these sparse n-grams gives the
probability of each license family and of ``unknown``.  It is trained on the
templates with words dropped and ends cut, and on paragraphs that are no
license; a temperature fitted on a held-out part calibrates it.  A family is
reported only when it beats ``unknown`` and the comparison with that family's
templates confirms it.

The vocabulary and weights are bounded by the templates, so they are
broadcast; the scan is one pass over the words whose joins keep only
vocabulary words.  Nothing runs in Python on the executors.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortlane.operators.order import stage

UNKNOWN = "unknown"
MIN_PROBABILITY = 0.5
MIN_SIMILARITY = 0.6
SAMPLE_DOCS = 400
#: Different lines of these documents, and held-out quarter included, that train and calibrate ``unknown``.
PLAIN_LINES = 2000
#: A line resembles a template from this share of the template's n-grams on, or if half of its pairs are in one.
RESEMBLES = 0.3
#: A window's vocabulary words, in those of the longest template: lines between a notice's own may hold some too.
WINDOW = 2
#: From one line of a window to the next, among lines with other words than stop words: one may lie between.
MAX_STEP = 2
#: Between words: anything but letters, digits and dots, plus or hyphens inside a word.
#: Possessive: a greedy group recurses once per character, and a long run of them overflows the stack.
BREAK = r"(?:[^a-z0-9.+\-]++|[.+\-](?![a-z0-9]))++"

#: One word instead of three: each alone is common, and "all" is a stop word.
PHRASE, PHRASE_WORD = r"\ball([\s*#/;%-]+)rights([\s*#/;%-]+)reserved\b", "all-rights-reserved"

# Notices of public licenses, by family.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any "
                "later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation, version 2.1."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met. Neither the name of the copyright holder nor the "
                     "names of its contributors may be used to endorse or promote products derived from this software."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause Simplified License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work "
                "under CC0 1.0 Universal Public Domain Dedication."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software. See unlicense.org"),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("GPL-3.0", "Released under the GNU GPL version 3."),
    ("GPL-3.0", "Licensed under the GNU GPLv3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Released under the GNU GPL version 2."),
    ("GPL-2.0", "Licensed under the GNU GPLv2."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("ISC", "Licensed under the ISC License."),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright by the author. All rights reserved."),
    ("Proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any "
                    "form without the prior written permission of the publisher."),
)
# Paragraphs with words of licenses that are none.
NEAR_MISSES = (
    "You need a valid driving license to rent a car in this state.",
    "The committee will review the license application next week.",
    "The software was released in the second version last year.",
    "The general public is invited to visit the museum free of charge.",
    "He studied at the Massachusetts Institute of Technology, MIT for short.",
    "The Apache helicopter is a version of an older machine.",
    "Copy the files to the source folder and use the binary from the project.",
    "No person may sell food at the market without permission of the city.",
    "The foundation published a notice on the rights of the author.",
    "This work is subject to conditions at the discretion of the holder.",
    "The code of conduct applies to all contributors of the project.",
    "Terms and conditions apply. See the following page for the purpose of this program.",
    "Distribution of the public library products is limited to international copies.",
    "The mozilla browser version was compiled from the source.",
)
# Words too common to be features.
STOP_WORDS = ("a", "an", "and", "any", "are", "as", "at", "be", "for", "have", "has", "if", "in", "into", "is", "it", "its",
              "may", "of", "on", "or", "the", "that", "this", "to", "was", "with", "you", "not", "no", "one", "all", "can",
              "from", "see", "were", "which")
#: A word of a line, in letters of any language, that is no stop word.
SOLID = (r"(?<![a-z0-9.+\-])(?!(?:" + "|".join(STOP_WORDS) + r")(?![a-z0-9.+\-]))[a-z0-9\x{80}-\x{10FFFF}]")


def tokens(text: Column) -> Column:
    """Words of a text in lower case."""
    return F.split(text, BREAK)


def _joined(text: Column) -> Column:
    """Lower case, with the fixed phrase as one word; line breaks stay."""
    return F.regexp_replace(F.lower(text), PHRASE, PHRASE_WORD + "$1$2")


def _grams(words: Column) -> Column:
    """Distinct words and neighbouring pairs."""
    n = F.size(words)
    pairs = F.when(n > 1, F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(1))), F.slice(words, 2, n),
                                     lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(words, pairs))


def _rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A bounded table held in the plan as one JSON literal."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(text).alias("r")).select("r.*")


def _words(template: str) -> list[str]:
    return [w for w in re.split(BREAK, re.sub(PHRASE, PHRASE_WORD + " ", template.lower())) if w]


def _vocabulary() -> list[str]:
    return sorted({w for _, t in TEMPLATES for w in _words(t)} - set(STOP_WORDS))


@dataclass
class LicenseModel:
    """Weights per n-gram and class, their intercepts and the temperature."""

    vocabulary: list[str]
    families: list[str]
    grams: list[str]
    weights: list[list[float]]  # per n-gram, one number per class; class 0 is unknown
    intercept: list[float]
    temperature: float
    #: Lines held out of the fit that are no license, and how many of them were taken for one.
    held_plain: int = 0
    held_alarms: int = 0


def _log_probability(z: Column, at: Column, temperature) -> Column:
    """Log of the softmax of the margins at 1-based place ``at``."""
    shifted = F.transform(z, lambda x: (x - F.array_max(z)) / temperature)
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + F.exp(x))
    return F.element_at(shifted, at) - F.log(total)


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS, plain_lines: int = PLAIN_LINES, seed: int = 4) -> LicenseModel:
    """Fit on varied templates, near misses and plain lines.

    Plain lines are such as are scored, with two words of the vocabulary or
    more, that no template resembles.  They come from the documents of at most
    ``sample_docs`` ids (smallest by hash); equal ones count once, and the
    ``plain_lines`` smallest by hash are taken, so reruns take the same.  A
    quarter of them is held out, with a quarter of the varied templates: the
    temperature is fitted there, and false alarms are counted.
    """
    vocabulary = _vocabulary()
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    known = F.array(*[F.lit(w) for w in vocabulary])
    rows = [{"id": i, "family": f, "text": t} for i, (f, t) in enumerate(TEMPLATES)]
    rows += [{"id": 1000 + i, "family": UNKNOWN, "text": t} for i, t in enumerate(NEAR_MISSES)]
    base = _rows(spark, rows, "id int, family string, text string").select(
        "id", "family", F.filter(tokens(_joined(F.col("text"))), lambda w: F.array_contains(known, w)).alias("all"))
    # Copy 0 is whole; later ones drop up to a third of the words, and every third is cut in half.
    copies = base.select("id", "family", "all", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("copy"))
    dropped = F.filter("all", lambda w, i: F.pmod(F.xxhash64("id", "copy", i, F.lit(seed)), F.lit(24)) >= F.col("copy") / 3)
    half = F.ceil(F.size("all") / 2).cast("int")
    cut = F.when((F.col("copy") % 6 == 2) & (F.size("all") > 8), F.slice(dropped, F.lit(1), half)).when(
        (F.col("copy") % 6 == 5) & (F.size("all") > 8), F.slice(dropped, half, F.size("all"))).otherwise(dropped)
    # A copy that lost all its words is no notice.
    varied = copies.select("id", "copy", "family", cut.alias("words")).where((F.size("words") > 0) | (F.col("family") == UNKNOWN))
    ids = docs.select(F.col(id_col).cast("bigint").alias("_id")).where("_id is not null").distinct().orderBy(
        F.xxhash64("_id", F.lit(seed)), "_id").limit(sample_docs)
    # Bounded by sample_docs.
    lines = docs.join(F.broadcast(ids), F.col(id_col) == F.col("_id")).select(
        "_id", F.posexplode(F.split(_joined(F.coalesce(text_col, F.lit(""))), "\\R")).alias("at", "line"))
    found = lines.select("_id", "at", F.filter(tokens(F.col("line")), lambda w: F.array_contains(known, w)).alias("words"))
    several = found.where(F.size("words") > 1).select("words").distinct().withColumn("_h", F.xxhash64("words", F.lit(seed)))
    several = stage(several, "license-several")
    shared = several.select("_h", F.explode(_grams(F.col("words"))).alias("gram")).join(
        F.broadcast(_template_grams(spark, vocabulary)), F.col("gram") == F.col("tgram")).groupBy("_h", "t").agg(
        (F.count(F.lit(1)) / F.first("tn")).alias("s"), F.count_if(F.contains("gram", F.lit(" "))).alias("pairs"))
    most = shared.groupBy("_h").agg(F.max("s").alias("s"), F.max("pairs").alias("pairs"))
    n_pairs = F.size(F.filter(_grams(F.col("words")), lambda g: F.contains(g, F.lit(" "))))
    plain = several.join(most, "_h", "left").where(
        (F.coalesce("s", F.lit(0.0)) < RESEMBLES) & (2 * F.coalesce("pairs", F.lit(0)) < n_pairs)).orderBy("_h", "words").limit(
        plain_lines).select(F.lit(2000).alias("id"), F.pmod("_h", F.lit(24)).cast("int").alias("copy"),
                            F.lit(UNKNOWN).alias("family"), "words")
    labels = F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(float(i)))])
    data = varied.unionByName(plain).select("id", "copy", labels[F.col("family")].alias("label"), _grams(F.col("words")).alias("grams"))
    data = stage(data.repartition(4, "copy"), "license-train")
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0).fit(data)
    rows = counter.transform(data)
    fit = LogisticRegression(maxIter=60, regParam=2e-4, family="multinomial", aggregationDepth=2).fit(
        rows.where("copy % 4 <> 3"))
    weights = fit.coefficientMatrix.toArray().T.tolist()
    intercept = [float(v) for v in fit.interceptVector]
    model = LicenseModel(vocabulary, families, list(counter.vocabulary), weights, intercept, 1.0)
    # Temperature: least log loss on the fourth of the copies left out.
    held = data.where("copy % 4 = 3").select(F.monotonically_increasing_id().alias("row"), "id", "label", "grams")
    held = stage(held, "license-held")
    z = _margins(spark, model, held.select("row", F.explode_outer("grams").alias("gram")), ["row"]).join(
        held.select("row", "id", "label"), "row")
    grid = [0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    loss = [F.avg(-_log_probability(F.col("z"), F.col("label").cast("int") + 1, t)).alias(f"t{i}")
            for i, t in enumerate(grid)]
    got = z.agg(*loss).first()
    model.temperature = min(zip(got, grid))[1] if got[0] is not None else 1.0
    best = F.array_position("z", F.array_max("z")).cast("int")
    alarm = (best > 1) & (F.exp(_log_probability(F.col("z"), best, model.temperature)) >= MIN_PROBABILITY)
    seen = z.where("id = 2000").agg(F.count(F.lit(1)), F.count_if(alarm)).first()
    model.held_plain, model.held_alarms = int(seen[0]), int(seen[1])
    return model


def _margins(spark: SparkSession, model: LicenseModel, grams: DataFrame, keys: list[str]) -> DataFrame:
    """Class margins ``z`` (an array) per key from its ``gram`` rows."""
    table = _rows(spark, [{"g": g, "w": [round(x, 6) for x in w]} for g, w in zip(model.grams, model.weights)],
                  "g string, w array<double>")
    # Bounded by the templates' n-grams.
    hit = grams.join(F.broadcast(table), F.col("gram") == F.col("g"), "left")
    sums = hit.groupBy(*keys).agg(*[F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(model.intercept))])
    return sums.select(*keys, F.array(*[
        F.coalesce(f"z{k}", F.lit(0.0)) + F.lit(b) for k, b in enumerate(model.intercept)]).alias("z"))


def scan_paragraphs(docs: DataFrame, model: LicenseModel, keys: list[str], text_col: str = "text",
                    min_probability: float = MIN_PROBABILITY, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``(keys, paragraph, family, probability, similarity)`` of the paragraphs that
    hold a license; paragraphs are lines and count from 0, blank ones included.
    A notice wrapped over several lines is reported once, at its first line;
    any number of blank lines and of lines with stop words alone may lie
    between its lines, and one line of other words at a time.
    Rows equal in ``keys`` must have equal texts."""
    spark = docs.sparkSession
    vocabulary = _rows(spark, [{"v": w} for w in model.vocabulary], "v string")
    # ``solid`` numbers the lines that hold other words than stop words.
    numbered = F.transform(F.split(_joined(F.col(text_col)), "\\R"), lambda x, i: F.struct(i.alias("paragraph"), x.alias("line")))
    lines = docs.select(*keys, F.posexplode(F.filter(numbered, lambda s: F.rlike(s["line"], F.lit(SOLID)))).alias("solid", "s")).select(
        *keys, "solid", "s.*")
    words = lines.select(*keys, "paragraph", "solid", F.posexplode(tokens(F.col("line"))).alias("at", "word"))
    known = words.join(F.broadcast(vocabulary), F.col("word") == F.col("v")).select(*keys, "paragraph", "solid", "at", "word")
    # A line's vocabulary words in order: bounded by one line.
    held = known.groupBy(*keys, "paragraph", "solid").agg(F.sort_array(F.collect_set(F.struct("at", "word")))["word"].alias("words"))
    held = stage(held, "license-lines")
    single = held.where((F.size("words") > 1) | (F.col("words")[0] == PHRASE_WORD)).select(
        *keys, "paragraph", F.lit(1).alias("lines"), "words")
    units = single.unionByName(_windows(spark, model, held, keys, min_similarity))
    grams = stage(units.select(*keys, "paragraph", "lines", F.explode(_grams(F.col("words"))).alias("gram")), "license-grams")
    place = [*keys, "paragraph", "lines"]
    margins = _margins(spark, model, grams, place)
    best = F.array_position("z", F.array_max("z")).cast("int")
    named = margins.select(*place, "z", best.alias("best")).select(
        *place, F.element_at(F.array(*[F.lit(f) for f in model.families]), F.col("best")).alias("family"),
        F.exp(_log_probability(F.col("z"), F.col("best"), model.temperature)).alias("probability"))
    named = named.where((F.col("family") != UNKNOWN) & (F.col("probability") >= min_probability))
    # Confirm with the templates of that family: the share of a template's n-grams that the unit holds.
    shared = grams.join(named, place).join(F.broadcast(_template_grams(spark, model.vocabulary)),
                                           (F.col("gram") == F.col("tgram")) & (F.col("family") == F.col("f")))
    like = shared.groupBy(*place, "family", "probability", "t").agg(
        (F.count(F.lit(1)) / F.first("tn")).alias("s")).groupBy(*place, "family", "probability").agg(
        F.max("s").alias("similarity"))
    return _once(like.where(F.col("similarity") >= min_similarity), keys)


def _template_grams(spark: SparkSession, vocabulary: list[str]) -> DataFrame:
    """``(t, f, tn, tgram)``: each template's family, number of n-grams and n-grams."""
    known_words = F.array(*[F.lit(w) for w in vocabulary])
    templates = _rows(spark, [{"t": i, "f": f, "x": t} for i, (f, t) in enumerate(TEMPLATES)], "t int, f string, x string")
    templates = templates.select("t", "f", _grams(F.filter(tokens(_joined(F.col("x"))), lambda w: F.array_contains(known_words, w))).alias("tg"))
    return templates.select("t", "f", F.size("tg").alias("tn"), F.explode("tg").alias("tgram"))


def _windows(spark: SparkSession, model: LicenseModel, held: DataFrame, keys: list[str], min_similarity: float) -> DataFrame:
    """``(keys, paragraph, lines, words)``: windows of two lines and more, where a template may be found.

    A window is as long as the longest template's words need, however few of
    them a line holds: ``WINDOW`` times that number, of which one line counts
    for half at most.  A run of lines is cut into blocks of that weight, so
    that a window lies in the block it starts in and the next one; such a pair
    of blocks holds all n-grams of its windows, and pairs that no template
    reaches ``min_similarity`` in have no windows to look at.
    """
    known = set(model.vocabulary)
    weight = WINDOW * max(sum(w in known for w in _words(t)) for _, t in TEMPLATES)
    order = Window.partitionBy(*keys).orderBy("paragraph")  # one text's lines
    new = F.coalesce(F.col("solid") - F.lag("solid").over(order) > MAX_STEP, F.lit(True)).cast("int")
    cut = held.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order)).withColumn(
        "_w", F.least(F.size("words"), F.lit(weight // 2))).withColumn("_to", F.sum("_w").over(
            Window.partitionBy(*keys, "_run").orderBy("paragraph"))).withColumn("_from", F.col("_to") - F.col("_w")).withColumn(
        "_block", F.floor(F.col("_from") / weight))
    place = [*keys, "_run", "_pair"]
    pairs = cut.select("*", F.explode(F.array("_block", F.col("_block") - 1)).alias("_pair")).where("_pair >= 0").groupBy(*place).agg(
        F.sort_array(F.collect_list(F.struct("paragraph", "words", "_from", "_to", (F.col("_block") == F.col("_pair")).alias(
            "_first")))).alias("run")).where(F.size("run") > 1)
    pairs = stage(pairs, "license-runs")
    near = pairs.select(*place, F.explode(_grams(F.flatten("run.words"))).alias("gram")).join(
        F.broadcast(_template_grams(spark, model.vocabulary)), F.col("gram") == F.col("tgram")).groupBy(*place, "t").agg(
        (F.count(F.lit(1)) / F.first("tn")).alias("s")).where(F.col("s") >= min_similarity).select(*place).distinct()
    n = F.size("run")
    line = lambda i, c: F.col("run")[i][c]
    starts = F.filter(F.sequence(F.lit(0), n - 2), lambda i: line(i, "_first"))
    ends = lambda i: F.filter(F.sequence(i + 1, n - 1), lambda j: line(j, "_to") - line(i, "_from") <= weight)
    spans = F.flatten(F.transform(starts, lambda i: F.transform(ends(i), lambda j: F.struct(
        line(i, "paragraph").alias("paragraph"), (line(j, "paragraph") - line(i, "paragraph") + 1).alias("lines"),
        F.flatten(F.slice("run.words", i + 1, j - i + 1)).alias("words")))))
    return pairs.join(near, place, "left_semi").select(*keys, F.explode(spans).alias("s")).select(*keys, "s.*")


def _once(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Each notice once: ``(keys, paragraph, family, probability, similarity)``.

    Of windows the most similar come first, then the shortest; one goes that
    covers a line of its family, or of at least its similarity, or that
    overlaps an earlier window (one of another family may begin on the line
    where that ends).  Lines that hold a notice by themselves stay, but for
    those that a remaining window covers: they are a part of its notice.
    """
    cols = ["paragraph", "lines", "family", "probability", "similarity"]
    # Bounded by one text's hits.
    found = hits.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("similarity")).alias("_s"), "lines", (-F.col("probability")).alias("_p"), "paragraph", "family",
        "probability", "similarity"))).alias("_all"))
    last = lambda x: x["paragraph"] + x["lines"] - 1
    single = F.filter("_all", lambda x: x["lines"] == 1)
    free = F.filter("_all", lambda x: (x["lines"] > 1) & ~F.exists("_one", lambda o: (
        o["paragraph"].between(x["paragraph"], last(x)) & ((o["family"] == x["family"]) | (o["similarity"] >= x["similarity"])))))
    meets = lambda x, c: F.when(x["family"] == c["family"], (x["paragraph"] <= last(c)) & (c["paragraph"] <= last(x))).otherwise(
        (x["paragraph"] < last(c)) & (c["paragraph"] < last(x)))
    kept = F.aggregate("_many", F.filter("_many", lambda x: F.lit(False)), lambda acc, x: F.when(
        F.exists(acc, lambda c: meets(x, c)), acc).otherwise(F.concat(acc, F.array(x))))
    alone = F.filter("_one", lambda o: ~F.exists("_kept", lambda x: o["paragraph"].between(x["paragraph"], last(x))))
    return found.withColumn("_one", single).withColumn("_many", free).withColumn("_kept", kept).select(
        *keys, F.explode(F.concat(alone, "_kept")).alias("h")).select(*keys, *[f"h.{c}" for c in cols if c != "lines"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  min_probability: float = MIN_PROBABILITY, min_similarity: float = MIN_SIMILARITY,
                  sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(doc_id, n_paragraphs, n_licensed, families, found)``, one row per input row.

    ``families`` is the sorted list of license families in the document,
    ``found`` the licensed paragraphs with family, probability and similarity.

    Defined results: a null text has 0 paragraphs, an empty or blank one is
    one blank paragraph, none has a license; a very long text is scanned line
    by line, whole; of windows that tie the shortest, then the likelier, is the
    notice; repeated rows and equal texts get equal results; null ids are scanned like others; an empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = train(spark, docs, "doc_id", "text", sample_docs)
    # Equal texts have one key; a hash of 128 bits names the text.
    keyed = docs.withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    hits = scan_paragraphs(keyed.where("text is not null"), model, ["key"], "text", min_probability, min_similarity)
    per_text = hits.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
        "paragraph", "family", F.round("probability", 6).alias("probability"), F.round("similarity", 6).alias("similarity")))
    ).alias("_found")).withColumnRenamed("key", "_key")
    per_text = stage(per_text, "license-found")
    rows = keyed.select("doc_id", "key", F.coalesce(F.size(F.split("text", "\\R")), F.lit(0)).alias("n"),
                        F.col("text").isNull().alias("none"))
    out = rows.join(per_text, (F.col("key") == F.col("_key")) & ~F.col("none"), "left")
    empty = F.array().cast("array<struct<paragraph:int,family:string,probability:double,similarity:double>>")
    found = F.coalesce("_found", empty)
    return out.select("doc_id", F.when(F.col("none"), 0).otherwise(F.col("n")).cast("bigint").alias("n_paragraphs"),
                      F.size(found).cast("bigint").alias("n_licensed"),
                      F.array_sort(F.array_distinct(F.transform(found, lambda e: e["family"]))).alias("families"),
                      found.alias("found"))

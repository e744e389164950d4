"""Licence scans by a trained paragraph classifier (operator 1), in DataFrame functions only.

A paragraph is a line. Its word n-grams (one to three words) are sparse features of a softmax regression over
licence families and an ``unknown`` class. Training rows are the notices below, each also with single words left
out, and a bounded sample of lines of the corpus itself as ``unknown``, without those that hold a licence word: how
often a licence stands in a corpus must not make it unknown. A quarter is kept back to calibrate the probabilities by
one temperature; how right they are on these rows is part of the model (``reliability``). Features must hold an anchor,
one of a fixed list of words. A line without an anchor has no feature and is ``unknown``, so the scan first
finds lines with an anchor and scores only these, whole, however many there are.

A predicted family is confirmed by the best word-set similarity with one of its own notices, or where line and notice
share ``LEAST_COMMON`` words that are most of either: a footer that holds a notice, a line of a wrapped one.

Defined results: null and empty texts have no paragraph; a line that is ``unknown`` is not returned; equal lines
are returned each under their own number (from 0); repeated rows give each finding once; null keys are kept; texts
are read whole, however long; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import stored

# Customary notices of public licences, by family.
NOTICES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "MIT License", "SPDX-License-Identifier: MIT", "Distributed under the MIT License. See LICENSE for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0", "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.", "Distributed under the terms of the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License.",
        "GNU General Public License version 2 or later", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3.", "GNU Lesser General Public License version 2.1",
        "SPDX-License-Identifier: LGPL-2.1-or-later", "Released under the GNU LGPL.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.", "GNU Affero General Public License version 3",
        "SPDX-License-Identifier: AGPL-3.0-only", "Released under the AGPL.",
    ],
    "BSD": [
        "Licensed under the BSD License.", "Released under the 3-Clause BSD License.", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Creative Commons Attribution License", "SPDX-License-Identifier: CC-BY-4.0", "Licensed under CC BY 3.0.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License", "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Content is available under CC BY-SA 4.0 unless otherwise noted.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0", "Released under CC BY-NC-SA 4.0.", "Released under CC BY-NC-ND 4.0.",
    ],
    "CC0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.", "Released under CC0.", "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense",
    ],
    "Proprietary": [
        "All rights reserved. No part of this publication may be reproduced without written permission.", "Proprietary and confidential.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.", "All rights reserved.",
    ],
}
# Lines that speak of licences without granting one.
NO_NOTICES = [
    "My driving license expired last week.", "The license fee rose to forty dollars.", "She works under a fishing license from the county.",
    "The book was released under a new title.", "They studied at MIT in Boston.", "The Apache helicopter landed at noon.",
    "General public access is free on Sundays.", "A creative commons room opened in the library.", "Version 2.0 was released under pressure.",
    "He gave permission to copy the notes.", "Licensed plumbers are listed below.", "The software is free of charge for a month.",
    "The license plate was missing.", "What license does this project use?", "Attribution of the painting is disputed.",
]
# Words that speak of a licence wherever they stand, and further words without which no notice is found.
LICENCE_WORDS = {
    "license", "licensed", "licence", "licenced", "spdx", "gnu", "gpl", "lgpl", "agpl", "bsd", "apache", "mozilla", "mpl", "cc", "cc0",
    "commons", "sharealike", "noncommercial", "unlicense", "unencumbered", "reserved",
}
ANCHORS = LICENCE_WORDS | {
    "affero", "attribution", "confidential", "copyright", "creative", "domain", "granted", "hereby", "permission", "permitted", "prohibited",
    "proprietary", "redistribute", "redistribution", "reproduced", "sublicense", "unauthorized", "waived", "warranty",
}
UNKNOWN = "unknown"
CLASSES = [*NOTICES, UNKNOWN]
LONGEST = 3
# Bounds of the corpus sample: texts drawn and lines kept of them.
SAMPLE_TEXTS = 2000
SAMPLE_LINES = 4000
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
# What a line and a notice share: at least so many words, and this part of one of them.
LEAST_COMMON = 6
LEAST_PART = 0.7
RIDGE = 1e-3
STEPS = 200


def line_words(line: str) -> list[str]:
    return [word for word in re.split("[^a-z0-9]+", line.lower()) if word]


def line_grams(words: list[str], anchors: set[str]) -> list[str]:
    """Distinct n-grams of one to three words with an anchor among them."""
    runs = (words[i:i + n] for n in range(1, LONGEST + 1) for i in range(len(words) - n + 1))
    return list(dict.fromkeys(" ".join(run) for run in runs if not anchors.isdisjoint(run)))


def similarity(a: set[str], b: set[str]) -> float:
    return len(a & b) / max(1, len(a | b))


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of driver-side constants, as a literal of the plan."""
    kind = f"array<struct<{schema}>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))


def words_column(line: Column) -> Column:
    return F.split(F.lower(line), "[^a-z0-9]+")


def sampled_lines(docs: DataFrame, key: str, text: str) -> list[str]:
    """At most ``SAMPLE_LINES`` lines of about ``SAMPLE_TEXTS`` texts, drawn by hash."""
    rate = min(1.0, SAMPLE_TEXTS / max(1, docs.count()))
    place = F.pmod(F.xxhash64(F.lit("licence sample"), F.col(key)), F.lit(1 << 30))
    drawn = lines_of(docs.filter(place < F.lit(int(rate * (1 << 30)))), key, text).filter(F.length("line").between(1, 2000))
    order = F.xxhash64("key", "paragraph")
    return [row[0] for row in drawn.orderBy(order, "line").limit(SAMPLE_LINES).select("line").collect()]


def train(lines: list[str], seed: int = 3) -> dict:
    """The classifier from the notices and sampled lines: anchors, n-gram weights, biases, temperature."""
    examples: list[tuple[list[str], int]] = []
    for family, listed in NOTICES.items():
        for words in map(line_words, listed):
            examples += [(words, CLASSES.index(family))] * 3
            examples += [(words[:i] + words[i + 1:], CLASSES.index(family)) for i in range(len(words)) if len(words) > 4]
    # A sampled line that speaks of licences may be a notice in other words, so it is no example of anything.
    plain = [words for words in map(line_words, lines) if words and LICENCE_WORDS.isdisjoint(words)]
    # Only the lines below show the unknown class with a licence word, so they are a quarter of it at least.
    times = max(3, -(-len(plain) // (3 * len(NO_NOTICES))))
    plain += [line_words(line) for line in NO_NOTICES for _ in range(times)]
    examples += [(words, len(CLASSES) - 1) for words in plain]
    anchors = ANCHORS
    vocabulary = sorted(set(chain.from_iterable(line_grams(line_words(x), anchors) for listed in NOTICES.values() for x in listed)))
    index = {gram: i for i, gram in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)), dtype=np.float32)
    for row, (words, _) in enumerate(examples):
        places = [index[gram] for gram in line_grams(words, anchors) if gram in index]
        x[row, places] = 1.0
    y = np.array([label for _, label in examples])
    back = np.random.default_rng(seed).random(len(y)) < 0.25
    weights, biases = softmax_fit(x[~back], y[~back])
    scores = x[back] @ weights + biases
    # One temperature for all classes: the likeliest on the rows kept back.
    temperature = min((float(t) for t in np.geomspace(0.25, 4, 33)), key=lambda t: loss(scores / t, y[back]))
    scores = scores / temperature
    chances = np.exp(scores - scores.max(axis=1, keepdims=True))
    sure = (chances / chances.sum(axis=1, keepdims=True)).max(axis=1)
    right = scores.argmax(axis=1) == y[back]
    reliability = {"rows": int(back.sum()), "mean_probability": float(sure.mean()), "right": float(right.mean())}
    weights, biases = softmax_fit(x, y)
    return {"reliability": reliability, "anchors": sorted(anchors), "vocabulary": vocabulary, "weights": weights / temperature, "biases": biases / temperature}


def loss(scores: np.ndarray, y: np.ndarray) -> float:
    top = scores.max(axis=1, keepdims=True)
    return float((np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0] - scores[np.arange(len(y)), y]).mean())


def softmax_fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    weights, biases = np.zeros((x.shape[1], len(CLASSES))), np.zeros(len(CLASSES))
    wanted = np.eye(len(CLASSES))[y]
    # Every family weighs as much as the unknown class.
    balance = (1.0 / np.bincount(y, minlength=len(CLASSES)).clip(1))[y]
    balance = balance / balance.sum()
    first = second = np.zeros(weights.size + biases.size)
    for step in range(1, STEPS + 1):
        scores = x @ weights.astype(np.float32) + biases
        chances = np.exp(scores - scores.max(axis=1, keepdims=True))
        chances /= chances.sum(axis=1, keepdims=True)
        error = (chances - wanted) * balance[:, None]
        gradient = np.concatenate([(x.T @ error.astype(np.float32) + RIDGE / len(CLASSES) * weights).ravel(), error.sum(axis=0)])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        move = 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
        weights, biases = weights - move[:weights.size].reshape(weights.shape), biases - move[weights.size:]
    return weights, biases


def matches(common: int, line: int, notice: int) -> bool:
    """Whether a line and a notice of so many words, with so many in common, are the same notice."""
    alike = common / (line + notice - common) >= LEAST_SIMILARITY
    return alike or common >= LEAST_COMMON and common >= LEAST_PART * min(line, notice)


def licence_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", model: dict | None = None) -> DataFrame:
    """``doc_id, paragraph, family, probability, similarity, confirmed`` for every line classed as a licence."""
    spark = docs.sparkSession
    model = model or train(sampled_lines(docs, key, text))
    anchors = small_table(spark, [{"word": word} for word in model["anchors"]], "word string")
    words = lines_of(docs, key, text).select("key", "paragraph", "line", F.explode(words_column(F.col("line"))).alias("word"))
    # Both tables below are as large as the notices above, whatever the corpus.
    anchored = words.join(F.broadcast(anchors), "word")
    lines = stored(anchored.groupBy("key", "paragraph", "line").agg(F.count(F.lit(1)).alias("hits")), "licence-lines")
    listed = F.filter(words_column(F.col("line")), lambda word: word != "")
    lines = lines.select("key", "paragraph", "line", listed.alias("words"))
    pieces = [F.when(F.size("words") >= n, F.transform(F.sequence(F.lit(0), F.size("words") - n), _joined(n))).otherwise(
        F.array().cast("array<string>")) for n in range(1, LONGEST + 1)]
    grams = lines.select("key", "paragraph", "line", F.explode(F.array_distinct(F.concat(*pieces))).alias("gram"))
    weights = small_table(spark, [{"gram": gram, "w": [float(v) for v in row]} for gram, row in zip(model["vocabulary"], model["weights"])],
                          "gram string, w array<double>")
    sums = [F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(len(CLASSES))]
    scored = grams.join(F.broadcast(weights), "gram").groupBy("key", "paragraph", "line").agg(*sums)
    scores = [F.col(f"s{i}") + F.lit(float(bias)) for i, bias in enumerate(model["biases"])]
    scored = scored.withColumn("top", F.greatest(*scores))
    total = sum((F.exp(score - F.col("top")) for score in scores[1:]), F.exp(scores[0] - F.col("top")))
    best = F.coalesce(*[F.when(score == F.col("top"), F.lit(name)) for score, name in zip(scores, CLASSES)])
    classed = scored.select("key", "paragraph", "line", best.alias("family"), (F.lit(1.0) / total).alias("probability"))
    classed = classed.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY))
    notices = small_table(spark, [{"family": family, "notice": sorted(set(line_words(x)))} for family, own in NOTICES.items() for x in own],
                          "family string, notice array<string>")
    held = F.array_distinct(F.filter(words_column(F.col("line")), lambda word: word != ""))
    common = F.size(F.array_intersect("held", "notice"))
    alike = common / (F.size("held") + F.size("notice") - common)
    most = (common >= LEAST_COMMON) & (common >= F.least(F.size("held"), F.size("notice")) * F.lit(LEAST_PART))
    compared = (classed.withColumn("held", held).join(F.broadcast(notices), "family")
                .groupBy("key", "paragraph", "line", "family", "probability").agg(
                    F.max(alike).alias("similarity"), F.max((alike >= LEAST_SIMILARITY) | most).alias("confirmed")))
    return compared.select(F.col("key").alias(key), "paragraph", "family", "probability", "similarity", "confirmed")


def _joined(n: int):
    return lambda i: F.concat_ws(" ", *[F.get(F.col("words"), i + k) for k in range(n)])

"""Licence scans by a trained paragraph classifier.

A logistic regression over sparse word 2- and 3-grams tells licence families
apart, with a class for paragraphs that are no licence. It is trained here, from
the templates below (in several wordings) and a bounded sample of the corpus's
own paragraphs. The least probability of a family is calibrated on sampled
paragraphs that were held out of the fit. A prediction counts only if the
paragraph also shares enough n-grams with one of the family's templates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import materialise, pick

# Licence families with their names and usual notices.
NAMES = {
    "MIT": ("the MIT License", "MIT license", "the MIT licence"),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0 license"),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GNU GPL v2"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU GPL v3", "GPLv3 license"),
    "LGPL": ("the GNU Lesser General Public License", "the GNU LGPL"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "the GNU AGPL v3"),
    "BSD": ("the BSD License", "the 3-Clause BSD License", "the New BSD License", "a BSD-style license"),
    "MPL-2.0": ("the Mozilla Public License, v. 2.0", "the Mozilla Public License, version 2.0"),
    "EPL-2.0": ("the Eclipse Public License 2.0", "the Eclipse Public License, v. 2.0"),
    "ISC": ("the ISC License",),
    "Unlicense": ("the Unlicense",),
    "CC0": ("CC0 1.0", "the Creative Commons Zero 1.0 Universal license"),
    "CC-BY": ("CC BY 4.0", "the Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": ("CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC": ("CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND": ("CC BY-ND 4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
NOTICES = {
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software",),
    "Apache-2.0": ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0",),
    "GPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
}
LEADS = ("Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.",
         "This software is made available under {}.", "The code is provided under the terms of {}.", "License: {}", "{}",
         "All contents are published under {} unless stated otherwise.")
# Hard cases of the unknown class.
OTHER = ("All rights reserved.", "A driver's license is required to rent a car.", "The licence was issued by the city council in 2004.",
         "The software is licensed to more than forty companies.", "Copyright notices appear at the end of the book.",
         "Version 2.0 of the report is available under the following address.", "This work is published under the name of the author.",
         "Permission is hereby refused.", "The terms of the contract were released under pressure.", "She holds a license to teach.",
         "Public libraries in general are free of charge to any person.", "The use of source and binary data is described below.")
UNKNOWN = "unknown"
_WORD = re.compile(r"\w+")
_STOP = re.compile(r"(?<=[.!?;:])\s+(?=[^\W\da-z])")


@dataclass(frozen=True)
class LicenseParams:
    """``sample_documents``: bound on the documents whose paragraphs the unknown
    class is fitted and calibrated on; ``sample_paragraphs``: at most from each,
    of at most ``sample_chars`` characters;
    ``false_positives``: share of held-out unknown paragraphs that may pass;
    ``least``: lower bound of the threshold; ``overlap``: least share of n-grams
    in common with a template."""
    sample_documents: int = 400
    sample_paragraphs: int = 10
    sample_chars: int = 2000
    false_positives: float = 0.001
    least: float = 0.5
    overlap: float = 0.6
    seed: int = 7


def _grams(words: list) -> set:
    pairs = list(zip(words, words[1:], strict=False))
    return set(pairs) | set(zip(words, words[1:], words[2:], strict=False))


def _tokens(paragraph: str) -> list:
    return _WORD.findall(paragraph.lower())


def _pieces(paragraph: str) -> list:
    """The paragraph, and its sentences where it has several."""
    parts = [x for x in _STOP.split(paragraph) if x]
    return [paragraph, *parts] if len(parts) > 1 else [paragraph]


def templates() -> dict:
    """Family -> its wordings."""
    made = {f: [lead.format(n) for n in names for lead in LEADS] for f, names in NAMES.items()}
    for f, notices in NOTICES.items():
        made[f] += notices
    return made


def _examples() -> list:
    """(family, paragraph): wordings, and their notices with an end cut off."""
    out = [(f, x) for f, xs in templates().items() for x in xs]
    for f, notices in NOTICES.items():
        for x in notices:
            words = x.split()
            out += [(f, " ".join(words[a:b])) for a, b in ((0, len(words) * 2 // 3), (len(words) // 3, len(words)), (2, len(words) - 2))]
    return out + [(UNKNOWN, x) for x in OTHER]


def _vector(grams: set, index: dict) -> tuple:
    """Column numbers and the value that all of them have: 1 / sqrt(n-grams of
    the paragraph), so a match in a long paragraph counts for less."""
    at = sorted(index[g] for g in grams if g in index)
    return at, (1.0 / np.sqrt(len(grams)) if grams else 0.0)


@dataclass(frozen=True)
class LicenseModel:
    """A fitted model; small (one weight per family and template n-gram)."""
    families: tuple
    index: dict
    weights: np.ndarray
    bias: np.ndarray
    shapes: dict
    threshold: float
    overlap: float

    def probabilities(self, grams: set) -> np.ndarray:
        at, value = _vector(grams, self.index)
        z = self.bias + value * self.weights[:, at].sum(1)
        e = np.exp(z - z.max())
        return e / e.sum()

    def judge(self, paragraph: str) -> tuple:
        """(family or None, probability) of one paragraph: its best piece's."""
        return max(map(self.judge_piece, _pieces(paragraph)), key=lambda x: (x[0] is not None, x[1]))

    def judge_piece(self, paragraph: str) -> tuple:
        words = _tokens(paragraph)
        grams = _grams(words)
        if not any(g in self.index for g in grams):
            return None, 0.0
        prob = self.probabilities(grams)
        best = int(prob[:-1].argmax())
        if prob[best] < self.threshold:
            return None, float(prob[best])
        shared = max(len(grams & t) / min(len(grams), len(t)) for t in self.shapes[self.families[best]] if t)
        return (self.families[best] if shared >= self.overlap else None), float(prob[best])


def _sampled(docs: DataFrame, p: LicenseParams) -> list:
    """Paragraphs of a bounded sample of documents, without likely licences.
    Rows are drawn by a hash with a threshold from their number, and what moves
    are a few paragraphs of each, not its text."""
    held = docs.select("doc_id", "text").filter(F.length("text") > 0)
    key = F.xxhash64("doc_id", "text", F.lit(p.seed))
    likely = min(1.0, (8 * p.sample_documents + 64) / max(1, docs.count()))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) <= p.sample_chars)
    drawn = held.withColumn("key", key).filter(F.pmod("key", F.lit(1 << 30)) / float(1 << 30) < likely)
    drawn = drawn.select("key", F.slice(F.shuffle(lines, F.lit(p.seed)), 1, p.sample_paragraphs).alias("x"))
    lines = drawn.orderBy("key").limit(p.sample_documents).select("x").collect()
    shapes = [_grams(_tokens(x)) for xs in templates().values() for x in xs]
    out = []
    for row in lines:
        for x in row[0]:
            g = _grams(_tokens(x))
            if g and not any(len(g & t) >= 0.5 * min(len(g), len(t)) for t in shapes if t):
                out.append(x)
    return sorted(set(out))


def train(spark: SparkSession, docs: DataFrame, params: LicenseParams = LicenseParams()) -> LicenseModel:
    """Fit and calibrate on ``docs (text)``; the sample is bounded by the parameters."""
    p = params
    sampled = _sampled(docs, p)
    fit_on, held = sampled[::2], sampled[1::2]
    rows = _examples() + [(UNKNOWN, x) for x in fit_on]
    families = (*NAMES, UNKNOWN)
    index = {g: i for i, g in enumerate(sorted(set().union(*[_grams(_tokens(x)) for _, x in _examples()])))}
    data = []
    for family, x in rows:
        at, value = _vector(_grams(_tokens(x)), index)
        data.append((float(families.index(family)), SparseVector(len(index), at, [value] * len(at))))
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    frame = materialise(spark.createDataFrame(data, schema).coalesce(1), "licence-train")
    fitted = LogisticRegression(maxIter=60, regParam=1e-4, family="multinomial").fit(frame)
    shapes = {f: [_grams(_tokens(x)) for x in xs] for f, xs in templates().items()}
    model = LicenseModel(tuple(families), index, fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray(), shapes, 0.0, p.overlap)
    wrong = [max(float(model.probabilities(_grams(_tokens(y)))[:-1].max()) for y in _pieces(x)) for x in [*held, *OTHER]]
    threshold = max(p.least, float(np.quantile(wrong, 1 - p.false_positives)) if wrong else p.least)
    return LicenseModel(model.families, index, model.weights, model.bias, shapes, min(threshold, 0.999), p.overlap)


def scan_licenses(docs: DataFrame, params: LicenseParams = LicenseParams(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_paragraphs, n_licenses, families,
    license, probability, spans``.

    A paragraph is a line with a word. ``families`` lists the distinct families
    in order of their names, ``license`` is the most probable one (the first in
    the text of equals), ``spans`` has ``family:start:end`` in code points. Null
    and empty texts have no paragraph; null ids and repeated rows stay. Whole
    texts are read in one pass without a shuffle."""
    d = pick(docs, doc_id=id_col, text=text_col)
    model = docs.sparkSession.sparkContext.broadcast(train(docs.sparkSession, d, params))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.value.judge
        seen: dict = {}
        for b in batches:
            rows = []
            for text in b.column("text"):
                n, found, at = 0, [], 0
                for line in (text.as_py() or "").split("\n"):
                    if line and not line.isspace():
                        n += 1
                        if line not in seen:
                            if len(seen) > 10000:
                                seen.clear()
                            seen[line] = judge(line)
                        family, prob = seen[line]
                        if family:
                            found.append((family, prob, at, at + len(line)))
                    at += len(line) + 1
                best = max(found, key=lambda x: x[1], default=(None, None))
                rows.append((n, len(found), ",".join(sorted({x[0] for x in found})), best[0], best[1],
                             ",".join(f"{f}:{s}:{e}" for f, _, s, e in found)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
            yield pa.record_batch([b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                  names=["doc_id", "n_paragraphs", "n_licenses", "families", "license", "probability", "spans"])

    return d.mapInArrow(run, f"doc_id {kind}, n_paragraphs long, n_licenses long, families string, license string, "
                             "probability double, spans string")

"""Licence notices by a trained paragraph classifier, in DataFrame and SQL operations alone.

Whole texts are cut into paragraphs at lines without a letter or digit. Notices in common use are the templates, a
template per paragraph of a notice. Where word pairs of any template stand close together in a paragraph, line
breaks aside, is a passage. Sparse word 1- and 2-grams of a passage go to a multinomial logistic regression over
licence families and "unknown"; the probability from which a family is believed is calibrated on notices and other
text that were held out, and the template most like the passage must be one of the predicted family.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.scratch import durable

UNKNOWN = "unknown"

# Names of licences, as they follow "licensed under", by family.
NAMES = {
    "AGPL": ["the GNU Affero General Public License", "the AGPL"],
    "Apache": ["the Apache License, Version 2.0", "the Apache License 2.0"],
    "BSD": ["the BSD License", "the BSD 3-Clause License", "the BSD 2-Clause License"],
    "CC-BY": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0": ["CC0 1.0 Universal", "the CC0 1.0 Universal Public Domain Dedication"],
    "GPL": ["the GNU General Public License, version 3", "the GNU General Public License", "the GNU GPL"],
    "LGPL": ["the GNU Lesser General Public License", "the GNU LGPL"],
    "MIT": ["the MIT License"],
    "MPL": ["the Mozilla Public License, Version 2.0"],
}

# Identifiers of licences in source files, by family.
IDENTIFIERS = {
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "Apache": ["Apache-2.0"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC0": ["CC0-1.0"],
    "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "MIT": ["MIT"],
    "MPL": ["MPL-2.0"],
}

# Paragraphs of the three GNU notices, which differ in the name alone.
GNU = {"AGPL": "GNU Affero General Public License", "GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License"}
GNU_NOTICE = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {} for more details.",
    "You should have received a copy of the {} along with this program. If not, see https://www.gnu.org/licenses/.",
]

# Openings of notices, which also stand alone.
GNU_OPENING = "free software under the terms of the {} as published by the Free Software Foundation"
OPENINGS = {
    "Apache": "you may not use this file except in compliance with the License",
    "BSD": "redistribution and use in source and binary forms, with or without modification, are permitted",
    "MIT": "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL": "subject to the terms of the Mozilla Public License",
} | {family: GNU_OPENING.format(name) for family, name in GNU.items()}

# Paragraphs of the other notices, by family.
NOTICES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/"],
    "CC0": [
        "dedicated to the public domain under CC0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
}

# Words around notices, for training.
FRAMES = ["{}", "this work is {}", "this software is {}", "the text is {}.", "{} see the file for details", "all files are {} unless noted"]

PARAGRAPH_BREAK = r"\n[^\p{L}\p{N}]*\n"

# Words between two hits of one passage; share of a template from which a passage is listed, and confirmed.
GAP = 8
LISTED = 0.5
CONFIRMED = 0.75

# Pieces of the corpus, of so many words, that stand for "unknown" in fit (about), and its feature space.
NEGATIVES = 4_000
PIECE = 40
FEATURE_BITS = 13
HELD_OUT = 3


def notices() -> dict[str, list[str]]:
    """The notices of each family, a paragraph each: names, identifiers, openings, then whole paragraphs."""
    short = {f: [f"{verb} under {name}" for name in names for verb in ("licensed", "released")] for f, names in NAMES.items()}
    tags = {f: [f"SPDX-License-Identifier: {i}" for i in ids] for f, ids in IDENTIFIERS.items()}
    gnu = {f: [p.format(name) for p in GNU_NOTICE] for f, name in GNU.items()}
    opening = {f: [t] for f, t in OPENINGS.items()}
    return {f: short[f] + tags[f] + opening.get(f, []) + gnu.get(f, []) + NOTICES.get(f, []) for f in NAMES}


def template_pairs() -> dict[str, list[list[str]]]:
    """The distinct word pairs of each template, by family."""
    words = {f: [re.findall(r"[^\W_]+", t.lower()) for t in texts] for f, texts in notices().items()}
    return {f: [sorted({" ".join(p) for p in zip(w, w[1:])}) for w in lists] for f, lists in words.items()}


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.filter(F.transform(words, lambda w, i: F.when(i + 1 < F.size(words), F.concat_ws(" ", w, F.get(words, i + 1)))), lambda p: p.isNotNull())


def _each(df: DataFrame, parts: Column, *names: str) -> DataFrame:
    """A row for each struct of `parts`, with the word pairs of its `words`, and words and pairs together as `grams`.

    The outer form of inline keeps Spark from filtering by the size of `parts`, which would compute them twice.
    """
    more = F.transform(parts, lambda r: F.struct(*[r[c].alias(c) for c in names], r["words"].alias("words"), _pairs(r["words"]).alias("pairs")))
    kept = [c for c in ("doc_id", "paragraph_no", "family", "label") if c in df.columns]
    rows = df.select(*kept, more.alias("more")).select(*kept, F.inline_outer("more")).where(F.col("words").isNotNull())
    return rows.withColumn("grams", F.concat("words", "pairs"))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph_no, paragraph): whole texts cut at lines that hold no letter and no digit."""
    text = F.regexp_replace(docs[text_col], "\r\n?", "\n")
    parts = docs.select(docs[id_col].alias("doc_id"), F.posexplode_outer(F.split(text, PARAGRAPH_BREAK)).alias("paragraph_no", "paragraph"))
    return parts.where(F.col("paragraph").rlike(r"[\p{L}\p{N}]"))


def passages(parts: DataFrame) -> DataFrame:
    """(doc_id, paragraph_no, start_word, words, pairs, grams): from the first to the last of two or more template pairs of a
    paragraph that follow one another by at most `GAP` words. What lies outside has no pair of any template."""
    known = sorted({p for lists in template_pairs().values() for pairs in lists for p in pairs})
    hits = F.transform("words", lambda w, i: F.when(F.concat_ws(" ", w, F.get("words", i + 1)).isin(known), i))
    rows = parts.select("doc_id", "paragraph_no", _words(F.col("paragraph")).alias("words"))
    rows = rows.withColumn("hits", F.filter(hits, lambda h: h.isNotNull()))
    rows = rows.withColumns({
        "first": F.filter("hits", lambda h, i: (i == 0) | (h - F.get("hits", i - 1) > GAP)),
        "last": F.filter("hits", lambda h, i: (i == F.size("hits") - 1) | (F.get("hits", i + 1) - h > GAP)),
    })
    spans = F.filter(F.arrays_zip("first", "last"), lambda s: s["last"] > s["first"])
    cut = F.transform(spans, lambda s: F.struct(s["first"].alias("start_word"), F.slice("words", s["first"] + 1, s["last"] - s["first"] + 2).alias("words")))
    return _each(rows, cut, "start_word")


def _likeness() -> Column:
    """For each family, the largest share of a template's pairs that stand among `pairs`."""
    shares = []
    for lists in template_pairs().values():
        each = [F.size(F.array_intersect("pairs", F.split(F.lit("|".join(p)), r"\|"))) / F.lit(len(p)) for p in lists]
        shares.append(F.greatest(*each))
    return F.array(*shares)


class Model:
    """The fitted pipeline, its families, and the probability of any family from which one is believed."""

    def __init__(self, pipeline, families: list[str], threshold: float) -> None:
        self.pipeline, self.families, self.threshold = pipeline, families, threshold

    def predict(self, grams: DataFrame) -> DataFrame:
        """Adds `guess`, the likeliest family, and `known`, the probability that it is any family at all."""
        p = vector_to_array("probability")
        own = F.slice(p, 2, len(self.families))
        guess = F.element_at(F.array(*map(F.lit, self.families)), F.array_position(own, F.array_max(own)).cast("int"))
        return self.pipeline.transform(grams).withColumns({"known": 1 - p[0], "guess": guess})


def _examples(docs: DataFrame, negatives: int) -> DataFrame:
    """(family, words, pairs, grams): framed templates and whole notices, and as "unknown" quarters of the longer templates and
    about `negatives` pieces of the corpus that are unlike every template."""
    spark = docs.sparkSession
    texts = [(f, t) for f, ts in notices().items() for t in ts]
    texts += [(f, "\n".join(ts[-n:])) for f, ts in notices().items() for n in (2, 3)]
    known = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in texts])))
    framed = F.array(*[F.concat(F.lit(f.partition("{}")[0]), F.col("text"), F.lit(f.partition("{}")[2])) for f in FRAMES])
    one = lambda w: F.struct(w.alias("words"))
    positives = _each(known, F.transform(framed, lambda t: one(_words(t))))
    n = F.size("words")
    long = known.select(_words(F.col("text")).alias("words")).where(n >= 16)
    quarter = F.floor(n / 4).cast("int")
    quarters = _each(long, F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: one(F.slice("words", q * quarter + 1, quarter))))
    rows = docs.count()
    share = int(1_000_000 * min(1.0, negatives / 4 / rows)) if rows else 0
    few = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share)
    words = paragraphs(few).select(_words(F.col("paragraph")).alias("words"))
    pieces = _each(words, F.transform(F.sequence(F.lit(0), n - 1, F.lit(PIECE)), lambda s: one(F.slice("words", s + 1, PIECE))))
    pieces = pieces.withColumn("order_", F.xxhash64("words")).orderBy("order_", "words").limit(negatives).drop("order_")
    pieces = pieces.where(F.array_max(_likeness()) < LISTED)
    return positives.unionByName(quarters.unionByName(pieces).withColumn("family", F.lit(UNKNOWN)))


def fit(docs: DataFrame, negatives: int = NEGATIVES) -> Model:
    """Fit on two thirds of the examples; calibrate on the others, told apart by a hash of their words.

    The threshold lies halfway between the probability that 99 of 100 held-out unknown examples stay below and
    that which 99 of 100 held-out notices reach."""
    families = list(NAMES)
    label = F.array_position(F.array(*map(F.lit, [UNKNOWN, *families])), F.col("family")) - 1
    held = F.pmod(F.xxhash64("words"), F.lit(HELD_OUT)) == 0
    rows = durable(_examples(docs, negatives).select("family", "grams", label.cast("double").alias("label"), held.alias("held_out")))
    stages = [
        HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << FEATURE_BITS, binary=True),
        LogisticRegression(family="multinomial", regParam=0.001, maxIter=60),
    ]
    model = Model(Pipeline(stages=stages).fit(rows.where(~F.col("held_out")).coalesce(2)), families, 0.5)
    other = F.col("family") == UNKNOWN
    cuts = model.predict(rows.where("held_out")).agg(
        F.percentile_approx(F.when(other, F.col("known")), 0.99, 10_000).alias("below"),
        F.percentile_approx(F.when(~other, F.col("known")), 0.01, 10_000).alias("above"),
    ).first()
    if None not in cuts:
        model.threshold = (cuts.below + cuts.above) / 2
    return model


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage that holds half of a template's word pairs: doc_id, paragraph_no, start_word, n_words,
    family, probability, similarity, passage (its words).

    The family is "unknown" where the probability that it is any family is below the calibrated threshold, where
    fewer than 3/4 of a template's pairs are found, or where a template of another family is more like the passage;
    similarity is the best template's share. A passage that names several licences gets one family. Null, empty
    and blank texts have no passages; null ids are kept; repeated rows are listed each; of equally likely families
    the first by name is taken; an empty table gives no rows. Other columns of `docs` are not looked at.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    model = model or fit(docs)
    near = passages(paragraphs(docs)).withColumn("shares", _likeness())
    near = near.withColumn("similarity", F.array_max("shares")).where(F.col("similarity") >= LISTED)
    own = F.element_at("shares", F.array_position(F.array(*map(F.lit, model.families)), F.col("guess")).cast("int"))
    sure = (F.col("known") >= model.threshold) & (F.col("similarity") >= CONFIRMED) & (own == F.col("similarity"))
    return model.predict(near).select(
        "doc_id", "paragraph_no", "start_word", F.size("words").alias("n_words"),
        F.when(sure, F.col("guess")).otherwise(UNKNOWN).alias("family"),
        F.round("known", 6).alias("probability"), F.round("similarity", 6).alias("similarity"), F.array_join("words", " ").alias("passage"),
    )

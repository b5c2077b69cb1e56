"""Licence scans by a trained paragraph classifier.

A paragraph is what stands between blank lines, or between line ends that follow a full stop; its lines are joined, so
a grant that is wrapped over several lines is one paragraph. Its features are word pairs and triples, and single words,
that hold a term: any word of the wordings learned from but those every text has (``COMMON``). A logistic regression over
them, trained here, tells the licence families and the class of other text apart. It learns from many wordings of every
family, names put into frames by rule and sentences of the licences themselves, each alone and amid corpus text; from
all different corpus paragraphs that share no triple with a wording, counted by their features; and from sentences
that use the terms in other senses (``CONTRAST``). A third of the corpus paragraphs is kept for calibration: a family is
believed only above the probability that all but one in ``FALSE_SHARE`` of them stay below. A believed family is
confirmed by comparing the paragraph with the family's wordings: the pairs they share, as a part of the shorter one. A
paragraph that is believed to be a licence but that no wording confirms, or whose family is not likelier than all others
together, is of the family ``unknown``.

A paragraph without a term has no feature, so nothing speaks for a licence in it, and its words are not joined into pairs.
No count over the corpus decides which paragraphs are looked at. A reservation of all rights beside a paragraph of another
family is the head of that licence and counts for it.

Null and empty texts have no paragraphs. Rows are told apart by id and text, so rows that share both get equal answers.
An empty table gives no rows; without corpus paragraphs the wordings alone are learned from. Further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import ascii_lower, once

#: What the families are called.
NAMES = {
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0", "Apache Software License"),
    "mit": ("MIT License", "MIT license", "MIT", "Expat license"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "BSD license", "BSD-3-Clause", "BSD-2-Clause", "New BSD License", "Simplified BSD License"),
    "gpl": ("GNU General Public License", "GNU General Public License, version 3", "GNU GPL v2", "GPL", "GPLv2", "GPLv3", "GPL-2.0-or-later", "GPL-3.0-only"),
    "agpl": ("GNU Affero General Public License", "AGPL", "AGPLv3", "AGPL-3.0-only"),
    "lgpl": ("GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Library General Public License", "LGPL", "LGPLv2.1", "LGPL-2.1-or-later", "LGPL-3.0-only"),
    "mpl-2.0": ("Mozilla Public License", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0"),
    "isc": ("ISC License", "ISC"),
    "artistic": ("Artistic License", "Artistic License 2.0", "Artistic-2.0"),
    "cc-by": ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution license"),
    "cc-by-sa": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-nc-sa": ("CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "public-domain": ("CC0 1.0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Unlicense"),
}
#: How names are used in notices.
FRAMES = (
    "{}", "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "Distributed under the {}.",
    "This project is licensed under the terms of the {}.", "This work is licensed under a {}.", "License: {}",
    "SPDX-License-Identifier: {}", "Published under {}.", "Available under the terms of {}.", "See the {} for more details.",
    "Use of this source code is governed by the {}.", "redistribute it and/or modify it under the terms of the {}",
    "{}, either version 2 or any later version", "{} or commercial", "{} licensed", "You should have received a copy of the {} along with this program.",
)
#: Sentences of the licences and of notices without a name.
TEXTS = {
    "apache-2.0": (
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a patent license to make, have made, use, offer to sell",
        "Unless You explicitly state otherwise, any Contribution intentionally submitted for inclusion in the Work by You to the Licensor",
        "Derivative Works shall mean any work, whether in Source or Object form, that is based on (or derived from) the Work",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software",
        "You may convey verbatim copies of the Program's source code as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice",
        "You may convey a covered work in object code form, provided that you also convey the machine-readable Corresponding Source under the terms of this License",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "a program that contains no derivative of any portion of the Library, but is designed to work with the Library by being compiled or linked with it",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "All distribution of Covered Software in Source Code Form, including any Modifications that You create or to which You contribute, must be under the terms of this License.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "artistic": (
        "The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package",
        "You may apply bug fixes, portability fixes and other modifications derived from the Public Domain or from the Copyright Holder.",
        "You may charge a reasonable copying fee for any distribution of this Package.",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain.",
        "The text is in the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related Rights",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved by the author.",
        "All rights are reserved by the copyright holder.",
        "Copyright (c) the company. All rights reserved.",
        "No part of this work may be reproduced or distributed without the prior written permission of the copyright holder.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
        "This document may not be copied without written permission of the publisher.",
    ),
}
#: The same words in other senses.
CONTRAST = (
    "He lost his driving license last year.", "The general public was not admitted to the hearing.", "The apache helicopter landed near the village.",
    "She reserved all the seats in the first row.", "Copyright is discussed in the next chapter.", "The rights of workers were on the agenda.",
    "The software runs on any computer with enough memory.", "Permission to enter the building was granted by the guard.",
    "The source of the river lies in the mountains.", "A copy of the letter was sent to the mayor.", "The work of the author is well known.",
    "Terms and conditions apply to the offer.", "The version of the story told here is the older one.", "Creative people need common ground.",
    "A distribution of prizes took place in the afternoon.", "The library is open to the public.", "The artistic director left the theatre.",
    "Version 2.0 of the report was published in May.", "The project is available to all students.", "Free of charge parking is provided.",
    "The mozilla browser has a new release.", "The licence fee pays for public television.", "A gnu is an antelope.", "The notice above the door was hard to read.",
)
#: Words that every text has, and so are no terms.
COMMON = frozenset(
    "a all also an and any are as at be been but by can cc code copies copy each either enough file files following for form forms free from has have"
    " he her his if in including into is it its later list made make may mit more most must name names need next no non nor not of offer on one option or"
    " other others part person prior purpose result see sell shall she should state such terms that the their then there this to use used v version was"
    " were which will with without work works world you your 0 1 2 3 4".split()
)
OTHER, UNKNOWN, PROPRIETARY = "other", "unknown", "proprietary"
FALSE_SHARE = 1_000
#: No family is believed below this probability.
LEAST = 0.5
#: Share of pairs that confirms a wording; paragraphs between a reservation of rights and the licence it heads.
CONFIRMED, BESIDE = 0.5, 2
REGULARISATION, ITERATIONS = 1e-4, 100

_ENDS = r"(?<=[.!?])[ \t\r]*+\n\s*+|\n[ \t\r]*+\n\s*+"
_WORD = "[a-z0-9]+"


def wordings() -> list[tuple[str, str]]:
    """Family and text of everything that is learned from: each name in each frame, and the sentences."""
    framed = [(family, frame.format(name)) for family, names in NAMES.items() for name in names for frame in FRAMES]
    # A name of common words alone says nothing without a frame.
    telling = [(family, text) for family, text in framed if _terms_of(text)]
    return telling + [(family, text) for family, texts in TEXTS.items() for text in texts]


def _terms_of(text: str) -> set[str]:
    return set(re.findall(_WORD, text.lower())) - COMMON


def terms() -> list[str]:
    return sorted(set().union(*[_terms_of(text) for _, text in wordings()]))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(_WORD), F.lit(0))


def _grams(words: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))
    return F.when(F.size(words) >= size, joined).otherwise(F.array().cast("array<string>"))


def _features(words: Column) -> Column:
    """Words, pairs and triples; those without a term are no features and are left out by the vocabulary."""
    return F.array_distinct(F.concat(words, _grams(words, 2), _grams(words, 3)))


def _wordings(spark: SparkSession) -> DataFrame:
    """``family, words, pairs`` of all wordings."""
    listed = spark.createDataFrame(wordings(), "family string, text string")
    worded = once(listed, words=_words(F.col("text"))).dropDuplicates(["family", "words"])
    return store(worded.select("family", "words", F.array_distinct(_grams(F.col("words"), 2)).alias("pairs")))


def _paragraphs(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, paragraph`` (its number) ``, words`` of every paragraph with a word."""
    whole = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")
    each = whole.select("doc", "doc_id", F.posexplode(F.split("text", _ENDS)).alias("paragraph", "text"))
    return once(each, words=_words(F.col("text"))).drop("text").where(F.size("words") > 0)


def _listed(values: list[str]) -> str:
    """Words, or words with blanks between them, as the list of an SQL ``IN``, which is looked up by hash."""
    return ", ".join(f"'{v}'" for v in sorted(values))


class Scanner:
    """A trained classifier: a weight per feature and family, the terms to look for, and the believed probability."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.terms = terms()
        self.wordings = _wordings(spark)
        grams = self.wordings.select(F.explode(_features(F.col("words"))).alias("g")).distinct()
        # Bounded by the wordings. Single words are features if they are terms, longer ones if they hold one.
        held = set(self.terms)
        self.vocabulary = [r["g"] for r in grams.orderBy("g").collect() if held & set(r["g"].split())]
        worded = [re.findall(_WORD, text.lower()) for _, text in wordings()]
        self.known = sorted(set().union(*worded))
        self.triples = sorted({" ".join(words[i : i + 3]) for words in worded for i in range(len(words) - 2)})
        self._fit(store(self._corpus(docs)))

    def _corpus(self, docs: DataFrame) -> DataFrame:
        """``mark, body, head, tail`` of every different paragraph that shares no triple with a wording.

        Only words of wordings can be part of a feature. ``body`` has the runs of such words that hold a term, with a
        point between them: as a text it has the paragraph's features. ``head`` and ``tail`` are what the first and last
        twelve words, the last ones backwards, have beside a wording put between them: of a run without a term at most the
        two words next to it. So most paragraphs come out equal and are counted rather than learned from one by one.
        """
        known, term, triple = (_listed(values) for values in (self.known, self.terms, self.triples))

        def runs(words: str) -> Column:
            return F.expr(f"split(array_join(transform({words}, w -> IF(w IN ({known}), w, '.')), ' '), '[ .]*[.][ .]*')")

        def termed(run: str) -> str:
            return f"exists(split({run}, ' '), w -> w IN ({term}))"

        def beside(run: str, two: str) -> str:
            return f"IF({termed(run)}, {run}, regexp_extract({run}, '{two}', 0))"

        def sorted_runs(runs: str) -> str:
            return f"array_sort(array_distinct(filter({runs}, r -> {termed('r')})))"

        every = _paragraphs(docs).select(F.xxhash64("words").alias("mark"), "words")
        every = once(every, runs=runs("words"), first=runs("slice(words, 1, 12)"), last=runs("slice(reverse(words), 1, 12)"))
        threes = "transform(sequence(1, size(split(r, ' ')) - 2), i -> array_join(slice(split(r, ' '), i, 3), ' '))"
        alike = F.expr(f"exists(filter(runs, r -> size(split(r, ' ')) > 2), r -> exists({threes}, g -> g IN ({triple})))")
        head = f"array_append({sorted_runs('slice(first, 1, size(first) - 1)')}, {beside('element_at(first, -1)', '(?:[^ ]+ )?[^ ]+$')})"
        tail = f"array_prepend({sorted_runs('slice(last, 2, size(last))')}, {beside('element_at(last, 1)', '^[^ ]+(?: [^ ]+)?')})"
        texts = {"body": sorted_runs("runs"), "head": head, "tail": tail}
        return every.where(~alike).select(
            "mark", *[F.array_join(F.expr(text), " . ").alias(name) for name, text in texts.items()]
        ).distinct()

    def _examples(self, others: DataFrame) -> DataFrame:
        """``family, words, times``: wordings alone, wordings amid corpus text, corpus text, and terms in other senses."""
        alone = self.wordings.select("family", "words", F.lit(1).cast("bigint").alias("times"))
        # A name and a sentence have to tell by themselves, whatever they stand among: names without a frame, and
        # sentences, are put amid text as often as all the framed names.
        amid = self._amid(others, alone, 0)
        for shift, texts in ((5, NAMES), (10, TEXTS)):
            known = [" ".join(re.findall(_WORD, t.lower())) for listed in texts.values() for t in listed]
            amid = amid.union(self._amid(others, alone.where(F.array_join("words", " ").isin(*known)), shift))
        bodies = others.groupBy("body").agg(F.count("*").alias("times"))
        other = bodies.select(F.lit(OTHER).alias("family"), F.split("body", " ").alias("words"), "times")
        # As many times as there are names, or the wordings would outweigh them.
        contrast = [(OTHER, re.findall(_WORD, t.lower()), len(FRAMES)) for t in CONTRAST]
        return alone.union(amid).union(other).union(others.sparkSession.createDataFrame(contrast, alone.schema))

    def _amid(self, others: DataFrame, wordings: DataFrame, shift: int) -> DataFrame:
        """Each corpus paragraph around one of the wordings, chosen by its hash. Wordings are few and fixed."""
        count = wordings.count()
        order = Window.orderBy("family", "words")
        numbered = wordings.select("family", F.col("words").alias("wording"), (F.row_number().over(order) - 1).alias("place"))
        place = F.pmod(F.shiftright("mark", shift), F.lit(count)).alias("place")
        mixed = others.groupBy("head", "tail", place).agg(F.count("*").alias("times")).join(numbered, "place")
        around = F.concat_ws(" ", "head", F.array_join("wording", " "), "tail")
        return mixed.select("family", F.array_remove(F.split(around, " "), "").alias("words"), "times")

    def _vectors(self, rows: DataFrame) -> DataFrame:
        """``family, features, times``: examples with the same features are one that counts as often."""
        grams = once(rows, all_grams=_features(F.col("words")))
        kept = F.expr(f"array_sort(filter(all_grams, g -> g IN ({_listed(self.vocabulary)})))").alias("grams")
        folded = grams.select("family", kept, "times").groupBy("family", "grams").agg(F.sum("times").alias("times"))
        return CountVectorizerModel.from_vocabulary(self.vocabulary, "grams", "features", binary=True).transform(folded)

    def _fit(self, others: DataFrame) -> None:
        held = F.pmod(F.shiftright("mark", 7), F.lit(3)) == 0
        self.families = sorted({*NAMES, *TEXTS}) + [OTHER]
        label = F.array_position(F.lit(self.families), F.col("family")) - 1
        examples = store(self._vectors(self._examples(others.where(~held))).select(
            "family", label.cast("double").alias("label"), "features", "times"
        ))
        # A family counts as much as any other, however many names it has, and other text as much as all of them.
        sizes = examples.groupBy("family").agg(F.sum("times").alias("n"))
        share = F.when(F.col("family") == OTHER, float(len(self.families) - 1)).otherwise(1.0)
        weighted = examples.join(F.broadcast(sizes), "family").withColumn("weight", 100 * share * F.col("times") / F.col("n"))
        model = LogisticRegression(
            family="multinomial", regParam=REGULARISATION, maxIter=ITERATIONS, standardization=False, weightCol="weight"
        ).fit(weighted.select("label", "features", "weight"))
        weights = model.coefficientMatrix.toArray()
        self.bias = [float(b) for b in model.interceptVector.toArray()]
        table = [(gram, [float(w) for w in weights[:, i]]) for i, gram in enumerate(self.vocabulary)]
        self.weights = store(others.sparkSession.createDataFrame(table, "gram string, weights array<double>"))
        kept = others.where(held).groupBy("body").agg(F.count("*").alias("n"))
        scored = kept.join(self._probabilities(kept.select("body", F.split("body", " ").alias("words")), "body"), "body", "left")
        # A paragraph without a feature counts as well. Below a half nothing is believed, so those need not be told apart.
        sure = F.greatest(F.coalesce("probability", F.lit(0.0)), F.lit(LEAST)).alias("sure")
        seen = scored.select(sure, "n").agg(F.expr(f"percentile(sure, {1 - 1 / FALSE_SHARE}, n)")).first()[0]
        self.believed = max(LEAST, seen or 0.0)

    def _probabilities(self, rows: DataFrame, *keys: str) -> DataFrame:
        """``family, probability`` of the likeliest family of every paragraph with a feature; told apart by ``keys``."""
        termed = rows.where(F.arrays_overlap("words", F.lit(self.terms)))
        grams = termed.select(*keys, F.explode(_features(F.col("words"))).alias("gram"))
        sums = [F.sum(F.col("weights")[i]).alias(f"s{i}") for i in range(len(self.families))]
        scores = grams.join(self.weights, "gram").groupBy(*keys).agg(*sums)
        logits = F.array(*[F.col(f"s{i}") + self.bias[i] for i in range(len(self.families))])
        scored = once(scores.select(*keys, logits.alias("logits")), top=F.array_max("logits"))
        total = F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
        best = F.array_max(F.slice("logits", 1, len(self.families) - 1))
        licence = 1 - F.exp(F.element_at("logits", -1) - F.col("top")) / total
        # How surely it is a licence at all, and which one, if one is likelier than all others together.
        named = F.get(F.lit(self.families), F.array_position("logits", best).cast("int") - 1)
        likeliest = F.exp(best - F.col("top")) / total
        return scored.select(
            *keys, named.alias("family"), (likeliest > licence / 2).alias("clear"), licence.alias("probability"),
        )

    def paragraphs(self, docs: DataFrame) -> DataFrame:
        """``doc, doc_id, paragraph, family, probability, likeness`` of every paragraph believed to be a licence."""
        keys = ("doc", "doc_id", "paragraph")
        # Repeated rows have the same paragraphs.
        termed = _paragraphs(docs).where(F.arrays_overlap("words", F.lit(self.terms))).dropDuplicates(list(keys))
        believed = store(self._probabilities(termed, *keys).where(F.col("probability") >= self.believed))
        # Words are taken from the texts again, as believed paragraphs are few.
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        some = docs.select("doc_id", "text").withColumn("_doc", F.xxhash64("doc_id", "text"))
        some = some.join(believed.select(F.col("doc").alias("_doc")).distinct(), "_doc", "left_semi").drop("_doc")
        again = _paragraphs(some).alias("b")
        worded = believed.alias("a").join(again, same[0] & same[1] & same[2]).select("a.*", "b.words").dropDuplicates(list(keys))
        own = worded.withColumn("own", F.array_distinct(_grams(F.col("words"), 2))).drop("words")
        compared = own.join(self.wordings.select("family", "pairs"), "family")
        shared = F.size(F.array_intersect("own", "pairs"))
        likeness = shared / F.greatest(F.least(F.size("own"), F.size("pairs")), F.lit(1))
        scored = compared.groupBy(*keys, "family", "clear", "probability").agg(F.max(likeness).alias("likeness"))
        confirmed = F.col("clear") & (F.col("likeness") >= CONFIRMED)
        scored = scored.withColumn("family", F.when(confirmed, F.col("family")).otherwise(UNKNOWN)).drop("clear")
        return _headed(scored)


def _headed(found: DataFrame) -> DataFrame:
    """Reservations of rights that head another family's text take that family."""
    beside = Window.partitionBy("doc", "doc_id").orderBy("paragraph").rangeBetween(-BESIDE, BESIDE)
    named = F.when(~F.col("family").isin(PROPRIETARY, UNKNOWN), F.col("family"))
    near = F.max(named).over(beside)
    return found.withColumn("near", near).withColumn(
        "family", F.when(F.col("family") == PROPRIETARY, F.coalesce("near", "family")).otherwise(F.col("family"))
    ).drop("near")


def scan(docs: DataFrame) -> DataFrame:
    """Per row: how many paragraphs are licences, their families, and the surest probability."""
    found = Scanner(docs).paragraphs(docs).groupBy("doc", "doc_id").agg(
        F.count("*").alias("n_licence_paragraphs"), F.array_sort(F.collect_set("family")).alias("families"),
        F.max("probability").alias("score"),
    ).withColumnRenamed("doc", "_doc").withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id")
    rows = rows.join(found, (F.col("doc") == F.col("_doc")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return rows.select(
        "doc_id", F.coalesce("n_licence_paragraphs", F.lit(0)).cast("bigint").alias("n_licence_paragraphs"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )

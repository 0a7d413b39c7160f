"""Licence paragraphs: sparse word n-gram logistic regression, an unknown class, and a template comparison.

Everything runs in the JVM. The regression is fitted on sentences of the templates below, their shortened and extended
forms, and a bounded sample of paragraphs without any licence wording, which are the class ``unknown``. Its
weights become a table of n-grams, so that scoring is one join: a part of a paragraph is split into n-grams, their
weights are summed, and the softmax gives a family. Below the calibrated probability the family is unknown; above it
the templates of that family must confirm it. The parts are the whole paragraph, which must share enough of its own
word triples with them (a paragraph of one or two words counts whole), and for each template the stretch that holds
most of the template's triples, which must be enough of them, so a notice is found however long its line is.
Paragraphs that hold neither a cue word nor any n-gram of a template could not be confirmed and are not scored.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantrylake.llm.rows import quoted
from gantrylake.llm.sampling import sample_of
from gantrylake.llm.scratch import Scratch
from gantrylake.session import fresh_path

# Wording of public licence notices, by family.
TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Distributed under the terms of the MIT license.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GNU GPL, version 2.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the 2-Clause BSD License.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This work has been released into the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}
#: Names that stand for a notice by themselves; they train the regression and are no templates.
SHORT: dict[str, list[str]] = {
    "apache": ["Apache License", "Apache License, Version 2.0", "Apache License 2.0"],
    "mit": ["MIT License", "The MIT License"],
    "gpl": ["GNU GPL, version 2", "GNU General Public License", "GNU General Public License, version 3"],
    "lgpl": ["GNU Lesser General Public License", "Lesser General Public License, version 2.1"],
    "agpl": ["GNU Affero General Public License", "Affero General Public License, version 3"],
    "bsd": ["BSD License", "BSD 3-Clause License", "2-Clause BSD License"],
    "mpl": ["Mozilla Public License", "Mozilla Public License 2.0"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "public-domain": ["public domain", "CC0 1.0"],
    "proprietary": ["All rights", "All rights reserved"],
}
FRAMES = ["{}", "Note: {}", "{} See the file for details.", "Copyright 2020 The Authors. {}", "the code {}", "This page: {}"]
UNKNOWN = "unknown"
#: Word stems, lower case; a paragraph with one counts as a cue, whatever it is found to be.
CUES = "licen[cs]e|copyright|rights reserved|public domain|permission is hereby|redistribut|free software|proprietary"
#: Documents whose paragraphs may serve as unknown, and paragraphs taken from them, at most.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS = 400, 3000
#: Least share of a paragraph's word triples that the family must hold, or of a template's that the paragraph must,
#: and least probability.
SHARED, LEAST = 0.5, 0.5
#: The share of paragraphs without a notice that may pass the regression (templates are compared after it), and n-grams at most.
STRAYS, VOCABULARY = 0.01, 1 << 18
#: Words that a stretch may have beyond its template's, and words beside it that are classified with it.
SLACK, BESIDE = 4, 4


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def grams(tokens: Column, size: int) -> Column:
    """Word n-grams of one size, each once."""
    last = F.size(tokens) - (size - 1)
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda n: F.array_join(F.slice(tokens, n, size), " ")))


def all_grams(tokens: Column) -> Column:
    return F.concat(grams(tokens, 1), grams(tokens, 2), grams(tokens, 3))


def rows_of(spark: SparkSession, rows: list[dict], kind: str) -> DataFrame:
    """A small table from driver values, as a literal in the plan."""
    literal = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")
    return spark.range(1).select(F.inline(literal))


def template_grams(size: int) -> list[dict]:
    """``template``, ``family``, ``gram``, ``words`` and ``grams`` (of the template) for each n-gram of one size."""
    rows = []
    for number, (family, text) in enumerate((family, text) for family, texts in TEMPLATES.items() for text in texts):
        own = re.findall("[a-z0-9]+", text.lower())
        found = sorted({" ".join(own[n : n + size]) for n in range(len(own) - size + 1)})
        rows += [{"template": number, "family": family, "gram": gram, "words": len(own), "grams": len(found)} for gram in found]
    return rows


def family_grams(spark: SparkSession) -> DataFrame:
    """(family, triples, short): the word triples of all its templates, and their single words and pairs."""
    kind = "family:string,gram:string"
    triples = rows_of(spark, template_grams(3), kind).groupBy("family").agg(F.collect_set("gram").alias("triples"))
    short = rows_of(spark, template_grams(1) + template_grams(2), kind).groupBy("family").agg(F.collect_set("gram").alias("short"))
    return triples.join(short, "family")


def any_of(phrases: list[str]) -> str:
    """A pattern of the phrases, written as a tree of their letters; any other signs may stand between words."""
    if not phrases:
        return ""
    rest: dict[str, list[str]] = {}
    for phrase in phrases:
        rest.setdefault(phrase[:1], []).append(phrase[1:])
    ended = "" in rest
    tails = [("[^a-z0-9]++" if first == " " else first) + any_of(own) for first, own in sorted(rest.items()) if first]
    return tails[0] if len(tails) == 1 and not ended else f"(?:{'|'.join(tails + [''] * ended)})" if tails else ""


def candidate(line: Column) -> Column:
    """Whether a line has a cue, holds a triple of a template, or is as a whole a shorter n-gram of one."""
    triples = any_of(sorted({row["gram"] for row in template_grams(3)}))
    short = any_of(sorted({row["gram"] for size in (1, 2) for row in template_grams(size)}))
    low = F.lower(line)
    held = F.concat(F.lit(" "), low).rlike(f"[^a-z0-9]{triples}(?![a-z0-9])")  # most places fail at the first sign
    return low.rlike(CUES) | held | low.rlike(f"^[^a-z0-9]*+{short}[^a-z0-9]*+$")


def paragraphs(text: Column) -> Column:
    """The lines of a text that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.trim(line)) > 0)


def unmarked(lines: DataFrame) -> DataFrame:
    """``text`` of the lines that no template could confirm."""
    names = ["line", "line2"]
    line = [code.alias(name) for name, code in zip(names, digests(F.col("text")), strict=True)]
    folder = fresh_path(lines.sparkSession, "licence-sample")
    lines.select("text", *line, words(F.col("text")).alias("tokens")).write.parquet(folder)  # split once, not for each n-gram
    own = lines.sparkSession.read.parquet(folder)
    triples, short = ([row["gram"] for size in sizes for row in template_grams(size)] for sizes in ((3,), (1, 2)))
    found = grams(F.col("tokens"), 3)
    shared = F.size(F.array_intersect(found, F.array(*map(F.lit, triples)))) >= SHARED * F.size(found)
    whole = F.array_join("tokens", " ").isin(short)
    free = own.where(~F.when(F.size("tokens") < 3, whole).otherwise(shared))
    return free.join(stretches(own), names, "left_anti").select("text")


def training_rows(docs: DataFrame, text_col: str, scratch: Scratch) -> DataFrame:
    """(family, tokens): framed templates, short names, and a bounded sample of paragraphs that no cue or template marks."""
    spark = docs.sparkSession
    framed = [
        {"family": family, "text": frame.format(text)} for family, texts in TEMPLATES.items() for text in texts for frame in FRAMES
    ]
    framed += [{"family": family, "text": text} for family, texts in SHORT.items() for text in texts for _ in FRAMES]
    known = rows_of(spark, framed, "family:string,text:string")
    texts = docs.select(quoted(text_col).cast("string").alias("text")).where("text is not null")
    least = sample_of(texts, SAMPLE_DOCS, scratch)
    lines = least.select(F.explode(paragraphs(F.col("text"))).alias("text")).where(~F.lower("text").rlike(CUES)).distinct()
    other = unmarked(lines).orderBy(F.xxhash64("text"), "text").limit(SAMPLE_PARAGRAPHS)
    every = known.union(other.select(F.lit(UNKNOWN).alias("family"), "text"))
    # Sentences that name a licence without being a notice, so that cue words alone decide nothing.
    near = [
        "You need a license to drive.", "Please renew your licence before it ends.", "The copyright page is missing.",
        "He was given permission to leave.", "The domain is public knowledge.", "All rooms are reserved.",
        "The license fee was paid by the state.", "Software is never free of mistakes.", "The terms of the contract were modified.",
    ]
    close = rows_of(spark, [{"family": UNKNOWN, "text": text} for text in near], "family:string,text:string")
    return every.union(close).select("family", words(F.col("text")).alias("tokens"))


class LicenceModel:
    """n-gram weights per family as a table, intercepts, and the calibrated least probability."""

    def __init__(self, families: list[str], weights: DataFrame, intercepts: list[float], least: float) -> None:
        self.families, self.weights, self.intercepts, self.least = families, weights, intercepts, least


def fit_licences(docs: DataFrame, text_col: str = "text") -> LicenceModel:
    """Fits the regression and calibrates the unknown class on the rows that its hash fold holds out."""
    spark = docs.sparkSession
    families = [*TEMPLATES, UNKNOWN]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    folder = fresh_path(spark, "licence-rows")
    scratch = Scratch(spark, "licence-sample")
    rows = training_rows(docs, text_col, scratch).select(label.cast("double").alias("label"), all_grams(F.col("tokens")).alias("grams"))
    rows.withColumn("held", F.pmod(F.xxhash64("grams"), F.lit(5)) == 0).coalesce(2).write.parquet(folder)
    scratch.drop()
    rows = spark.read.parquet(folder)
    unknown = len(families) - 1
    named = rows.where((F.col("label") != unknown) | F.exists("grams", lambda gram: gram.rlike(CUES)))
    vector = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=VOCABULARY, minDF=1.0).fit(named)
    if len(vector.vocabulary) >= VOCABULARY:
        raise ValueError("the templates have more n-grams than the vocabulary holds")
    # Every family weighs the same, however many templates it has.
    sizes = rows.groupBy("label").agg((1000 / F.count(F.lit(1))).alias("weight"))
    counted = vector.transform(rows).join(F.broadcast(sizes), "label").persist()
    regression = LogisticRegression(
        family="multinomial", maxIter=60, regParam=0.001, elasticNetParam=0.2, standardization=False, weightCol="weight"
    )
    model = regression.fit(counted.where((F.col("label") != unknown) | ~F.col("held")))
    chance = vector_to_array("probability")
    strays = model.transform(counted.where((F.col("label") == unknown) & F.col("held"))).select(
        F.array_max(F.slice(chance, 1, unknown)).alias("best")
    )
    passed = strays.agg(F.percentile("best", F.lit(1 - STRAYS))).first()[0] or 0.0
    counted.unpersist()
    matrix = model.coefficientMatrix.toArray()
    weights = [
        {"gram": gram, "weights": [round(float(x), 6) for x in matrix[:, n]]}
        for n, gram in enumerate(vector.vocabulary)
        if abs(matrix[:, n]).max() > 1e-6
    ]
    table = rows_of(spark, weights, "gram:string,weights:array<double>")
    return LicenceModel(families, table, [float(x) for x in model.interceptVector], max(LEAST, passed))


def guesses(parts: DataFrame, model: LicenceModel, keys: list[str]) -> DataFrame:
    """The keys, ``guess`` and ``probability`` of each part, from its ``tokens``."""
    count = len(model.families)
    summed = parts.select(*keys, F.explode(all_grams(F.col("tokens"))).alias("gram")).join(F.broadcast(model.weights), "gram").groupBy(*keys).agg(
        *[F.sum(F.round(F.col("weights")[n] * 1e6).cast("long")).alias(f"w{n}") for n in range(count)]  # whole numbers: any order gives one sum
    )
    logits = [F.col(f"w{n}") / 1e6 + model.intercepts[n] for n in range(count)]
    scored = summed.select(*keys, F.array(*logits).alias("logits"))
    highest = F.array_max("logits")
    exps = F.transform("logits", lambda x: F.exp(x - highest))
    total = F.aggregate(exps, F.lit(0.0), lambda a, b: a + b)
    named = F.array(*map(F.lit, model.families))
    best = F.element_at(named, F.array_position("logits", highest).cast("int"))
    return scored.select(*keys, best.alias("guess"), (1 / total).alias("probability"))


def stretches(lines: DataFrame) -> DataFrame:
    """``line``, ``line2``, ``part``, ``holder``, ``tokens``: where a line holds enough triples of a template, the best place for each."""
    spark = lines.sparkSession
    last = F.size("tokens") - 2
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    triples = F.transform(places, lambda n: F.struct(n.alias("at"), F.array_join(F.slice("tokens", n, 3), " ").alias("gram")))
    known = rows_of(spark, template_grams(3), "template:int,family:string,gram:string,words:int,grams:int")
    hits = lines.select("line", "line2", F.inline(triples)).join(F.broadcast(known), "gram")
    # A stretch may be longer than its template by SLACK words, and a triple begins two words before its end.
    longest = max(row["words"] for row in template_grams(3)) + SLACK - 2
    ahead = Window.partitionBy("line", "line2", "template").orderBy("at").rangeBetween(0, longest - 1)
    held = F.filter(F.collect_list(F.struct("at", "gram")).over(ahead), lambda hit: hit["at"] < F.col("at") + F.col("words") + SLACK - 2)
    spans = hits.withColumn("held", held).select(
        "line", "line2", "template", "family", "grams", "at",
        F.size(F.array_distinct(F.col("held.gram"))).alias("shared"), (F.array_max("held.at") + 3).alias("end"),
    )
    best = F.max(F.struct("shared", (-F.col("at")).alias("first"), "end")).alias("best")
    enough = spans.where(F.col("shared") >= SHARED * F.col("grams")).groupBy("line", "line2", "template", "family").agg(best)
    first = F.greatest(F.lit(1), -F.col("best.first") - BESIDE)
    found = enough.join(lines, ["line", "line2"])
    return found.select(
        "line", "line2", F.col("template").alias("part"), F.col("family").alias("holder"),
        F.slice("tokens", first, F.col("best.end") + BESIDE - first).alias("tokens"),
    )


def classified(distinct: DataFrame, model: LicenceModel) -> DataFrame:
    """``paragraph``, ``family``, ``probability``, ``confirmed``, ``families`` (all confirmed) for each distinct paragraph.

    Family and probability are those of the surest confirmed part, or of the whole paragraph if there is none.
    """
    spark = distinct.sparkSession
    folder = fresh_path(spark, "licence-words")
    line = [code.alias(name) for name, code in zip(("line", "line2"), digests(F.col("paragraph")), strict=True)]
    distinct.select(*line, words(F.col("paragraph")).alias("tokens")).write.parquet(folder)
    lines = spark.read.parquet(folder)
    keys = ["line", "line2", "part", "holder"]
    whole = lines.select("line", "line2", F.lit(-1).alias("part"), F.lit("").alias("holder"), "tokens")
    folder = fresh_path(spark, "licence-parts")
    whole.unionByName(stretches(lines)).write.parquet(folder)
    parts = spark.read.parquet(folder)
    guessed = guesses(parts, model, keys)
    sure = (F.col("guess") != UNKNOWN) & (F.col("probability") >= model.least)
    named = guessed.withColumn("family", F.when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN)))
    own = named.where("part < 0").join(lines, ["line", "line2"]).join(F.broadcast(family_grams(spark)), "family", "left")  # one row per family
    triples = grams(F.col("tokens"), 3)
    share = F.size(F.array_intersect(triples, F.col("triples"))) / F.size(triples)
    held = F.when(F.size("tokens") < 3, F.array_contains("short", F.array_join("tokens", " "))).otherwise(share >= SHARED)
    judged = own.select("line", "line2", "part", "family", "probability", F.coalesce(held, F.lit(False)).alias("confirmed")).unionByName(
        named.where("part >= 0").select("line", "line2", "part", "family", "probability", (F.col("family") == F.col("holder")).alias("confirmed"))
    )
    confirmed = F.when(F.col("confirmed"), F.struct("probability", "family"))
    by_line = judged.groupBy("line", "line2").agg(
        F.max(confirmed).alias("best"),
        F.max(F.when(F.col("part") < 0, F.struct("probability", "family"))).alias("own"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
    )
    shown = F.coalesce("best", "own")
    return distinct.select("paragraph", *line).join(by_line, ["line", "line2"], "left").select(
        "paragraph",
        F.coalesce(shown["family"], F.lit(UNKNOWN)).alias("family"),
        shown["probability"].alias("probability"),
        F.col("best").isNotNull().alias("confirmed"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
    )


def licence_paragraphs(docs: DataFrame, model: LicenceModel, text_col: str = "text") -> DataFrame:
    """``ref``, ``ref2`` (digests of the whole text), ``paragraph``, ``family``, ``probability``, ``confirmed``, ``families``."""
    spark = docs.sparkSession
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    every = docs.select(text.alias("text")).select("text", F.explode(paragraphs(F.col("text"))).alias("paragraph"))
    lines = every.where(candidate(F.col("paragraph"))).select(*digests(F.col("text")), "paragraph")
    folder = fresh_path(spark, "licence-lines")
    lines.distinct().write.parquet(folder)
    lines = spark.read.parquet(folder)
    folder = fresh_path(spark, "licence-classes")
    classified(lines.select("paragraph").distinct(), model).write.parquet(folder)
    return lines.join(spark.read.parquet(folder), "paragraph", "left")


def digests(text: Column) -> list[Column]:
    """Two digests that stand for a whole text."""
    return [F.xxhash64(text).alias("ref"), F.xxhash64(F.lit("licence"), text).alias("ref2")]


def scan_licences(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``families`` (sorted, confirmed), ``licence`` (of the surest paragraph), ``probability``, ``cues``.

    ``cues`` counts the distinct paragraphs that have a cue word or are confirmed; ``licence`` is ``unknown`` if there
    are some and none is confirmed, and NULL without any. NULL and empty texts have none; repeated rows have a row each; an empty
    table gives no rows. Equal texts are scanned once.
    """
    spark = docs.sparkSession
    found = licence_paragraphs(docs, model, text_col)
    named = F.when(F.col("confirmed"), F.struct(F.col("probability"), F.col("family")))
    by_text = found.groupBy("ref", "ref2").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"),
        F.max(named).alias("best"),
        F.count_if(F.col("confirmed") | F.lower("paragraph").rlike(CUES)).alias("cues"),
    )
    folder = fresh_path(spark, "licence-texts")
    by_text.write.parquet(folder)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_col).alias("doc_id"), *digests(text))
    joined = rows.join(spark.read.parquet(folder), ["ref", "ref2"], "left")
    return joined.select(
        "doc_id",
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.when(F.col("cues") > 0, F.coalesce("best.family", F.lit(UNKNOWN))).alias("licence"),
        F.round("best.probability", 6).alias("probability"),
        F.coalesce("cues", F.lit(0)).cast("long").alias("cues"),
    )

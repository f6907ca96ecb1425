"""Licence families of paragraphs by sparse n-gram logistic regression (operator 7), in DataFrame functions.

A paragraph is a line with a word. Its features are its distinct runs of two and three
words that also occur in a template. A multinomial logistic regression over families
and `unknown` is fitted on variants of the templates and, as unknown, on one half of all
distinct lines of the corpus (by hash) that fit no template. Lines with the same features
are one row of the fit with their number as weight, so the fit grows with the number of
different sets of features. Lines that name a licence, and the others, weigh KIND_WEIGHT
together at most, so that a large corpus doesn't outweigh the templates, and those that
name one aren't lost among the others; within a kind all lines weigh the same.

The coefficients become one literal map, and every line is scored inside its row: its
features in the vocabulary, the sum of their coefficients, a softmax. Nothing is
shuffled or joined back. The probability that a prediction must reach is calibrated on
the half of the lines that was not fitted, all of them: at most one in a hundred of its
unlicensed lines, by weight, may pass. A prediction counts if a template of its family confirms it: the best
local alignment of the words, in order, scores at least CONFIRM of the template (or of
the line, if it is part of a longer notice), and the line doesn't deny the licence.

Cases: a null or empty text has no paragraphs; equal probabilities go to the family
first in the alphabet; every row is judged by itself, so null and repeated doc_ids are
rows like others; other columns are ignored. An empty table gives no rows."""

from __future__ import annotations

import json
import random

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poifuse.functions.text import let
from poifuse.llm import common

#: What the lines of one kind, naming a licence or not, weigh together at most; a variant of a template weighs 1.
KIND_WEIGHT = 2_000
VARIANTS = 12
FALSE_SHARE = 0.01
CONFIRM = 0.75
UNKNOWN = "unknown"
#: Opening notices of public licences.
TEMPLATES = (
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
)
_NAMES_LICENCE = r"(?i)licen[sc]e|copyright|all rights reserved|creative commons|public domain"
_DENIES = r"(?i)\b(not|never|neither|nor|nicht|keine|no)\b[^.]{0,20}\b(licen[sc]ed|released|granted|subject|distributed|lizenziert)\b"
_BLANK = r"[^\x20\x09-\x0D]"
Templates = tuple[tuple[str, str], ...]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def runs_of(words: Column) -> Column:
    two = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(words, i), w))
    three = F.transform(F.slice(words, 3, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), w))
    return F.array_distinct(F.concat(two, three))


def features(text: Column) -> Column:
    """Distinct runs of two and three words, lower case."""
    return let(words_of(text), runs_of)


def alignment(words: Column, wanted: Column) -> Column:
    """Score of the best local alignment of two word lists: 2 for a word in place, -2 for another word, -1 for a word more or less."""

    def next_row(row: Column, word: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            same = F.when(F.get(wanted, j - 1) == word, F.lit(2)).otherwise(F.lit(-2))
            best = F.greatest(F.lit(0), F.get(row, j - 1) + same, F.get(row, j) - 1, F.get(done, j - 1) - 1)
            return F.concat(done, F.array(best))

        return F.aggregate(F.sequence(F.lit(1), F.size(wanted)), F.array(F.lit(0)), cell)

    start = F.struct(F.array_repeat(F.lit(0), F.size(wanted) + 1).alias("row"), F.lit(0).alias("best"))
    step = lambda a, w: let(next_row(a["row"], w), lambda r: F.struct(r.alias("row"), F.greatest(a["best"], F.array_max(r)).alias("best")))
    return F.aggregate(words, start, step, lambda a: a["best"])


def confirms(words: Column, templates: Templates, family: Column | None = None) -> Column:
    """Whether one of the templates (of the family) fits the words."""
    rows = [{"family": f, "words": _plain_words(t)} for f, t in templates]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<family: string, words: array<string>>>")

    def fits(t: Column) -> Column:
        m, n = F.size(t["words"]), F.size(words)
        shared = F.size(F.array_intersect(words, t["words"])) * 4 >= F.size(F.array_distinct(t["words"]))  # else nothing fits
        fit = let(alignment(words, t["words"]), lambda best: (best >= 2 * CONFIRM * m) | ((n >= 6) & (best >= 2 * CONFIRM * n)))
        return (shared if family is None else (t["family"] == family) & shared) & fit

    return F.exists(table, fits)


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def variants(seed: int = 5, templates: Templates = TEMPLATES) -> list[tuple[str, str]]:
    """Templates as they are, with words before and after, and with some words missing."""
    draw, out = random.Random(seed), []
    around = ["this file is", "the text is", "see the notice below", "for details see the web site", "copyright by the authors", "note that", "and its documentation"]
    for family, text in templates:
        words = text.split()
        out.append((family, text))
        for _ in range(VARIANTS):
            kept = [w for w in words if len(words) < 6 or draw.random() > 0.08]
            out.append((family, " ".join([draw.choice(around) if draw.random() < 0.5 else "", *kept, draw.choice(around) if draw.random() < 0.5 else ""])))
    return out


def vocabulary_of(templates: Templates = TEMPLATES) -> list[str]:
    return sorted({" ".join(w[i : i + n]) for _, t in templates for w in [_plain_words(t)] for n in (2, 3) for i in range(len(w) - n + 1)})


def hits_of(line: Column, vocabulary: list[str]) -> Column:
    """Features of a line that the vocabulary has; null or empty if there is none."""
    known = sorted({w for g in vocabulary for w in g.split(" ")})
    # two neighbours must be words of the vocabulary before any run of words is made
    near = lambda w: F.exists(F.transform(w, lambda x, i: x.isin(known) & F.coalesce(F.get(w, i + 1).isin(known), F.lit(False))), lambda x: x)
    return let(words_of(line), lambda w: F.when(near(w), F.filter(runs_of(w), lambda g: g.isin(vocabulary))))


def unlicensed(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """How many distinct lines without a licence (n) there are by their features (terms), named and half; written once.

    Lines are told apart by two hashes of 64 bits; of their text only lines that name a licence are shuffled."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = docs.select(F.explode(F.split(text, "\n", -1)).alias("line")).where(F.col("line").rlike(_BLANK)).withColumn("named", F.col("line").rlike(_NAMES_LICENCE))
    terms = F.sort_array(F.coalesce(hits_of(F.col("line"), vocabulary_of(templates)), F.array().cast("array<string>")))
    hashes = [F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2")]
    half = F.pmod(F.hash("line"), F.lit(2))
    each = lines.select("named", half.alias("half"), terms.alias("terms"), *hashes, F.when(F.col("named"), F.col("line")).alias("line")).distinct()
    fits = let(words_of(F.col("line")), lambda w: confirms(w, templates))
    return common.stage(each.where(~F.col("named") | ~fits).groupBy("named", "half", "terms").agg(F.count(F.lit(1)).alias("n")), "lines")


# Rows of the fit that one task holds.
TASK_FITTED = 100_000


def train(spark: SparkSession, docs: DataFrame, templates: Templates = TEMPLATES) -> tuple[dict[str, list[float]], dict[str, float], float]:
    """Coefficients by feature and family, biases, and the calibrated least probability."""
    vocabulary = vocabulary_of(templates)
    families = sorted({f for f, _ in templates}) + [UNKNOWN]
    own = spark.createDataFrame(variants(templates=templates), "family string, line string")
    own = own.select("family", F.coalesce(hits_of(F.col("line"), vocabulary), F.array().cast("array<string>")).alias("terms"), F.lit(1.0).alias("weight"))
    lines = unlicensed(docs, templates)
    weight = F.lit(0.0)
    for r in lines.groupBy("named").agg(F.sum("n").alias("n")).collect():  # two rows
        weight = F.when(F.col("named") == r["named"], F.col("n") * min(1.0, KIND_WEIGHT / r["n"])).otherwise(weight)
    lines = lines.select("half", "terms", weight.alias("weight"))
    # the corpus may be without other paragraphs: unknown then is at least the empty one and words around notices
    empty = spark.createDataFrame([(UNKNOWN, [], 20.0)], "family string, terms array<string>, weight double")
    fitted = own.union(empty).union(lines.where("half = 0").select(F.lit(UNKNOWN), "terms", "weight"))
    labels = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    tasks = -(-fitted.count() // TASK_FITTED)
    ready = fitted.select(labels.alias("label"), "terms", "weight").repartition(tasks, "terms").sortWithinPartitions("terms", "label", "weight")
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features")
    table = common.stage(vectors.transform(ready).select("label", "features", "weight"), "fitted")
    # the fit ends by its tolerance (after 116 steps on sf0.1), not by a number of steps
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=10_000, weightCol="weight").fit(table)
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = {g: [float(x) for x in matrix[:, k]] for k, g in enumerate(vocabulary)}
    biases = {f: float(bias[k]) for k, f in enumerate(families)}
    held = lines.where("half = 1")
    allowed = FALSE_SHARE * (held.agg(F.sum("weight")).first()[0] or 0.0)
    # lines without a feature never pass; of the others the highest one in a hundred of all may
    judged_lines = held.select(prediction(F.col("terms"), weights, biases)["probability"].alias("p"), "weight").where("p is not null")
    limit = highest_above(common.stage(judged_lines, "held"), allowed)
    return weights, biases, max(0.5, min(limit + 1e-9, 1.0))


def highest_above(rows: DataFrame, allowed: float) -> float:
    """The highest p of (p, weight) whose rows and those above it weigh more than allowed; 0 if there is none.

    Exact: each round counts the weights in 1,000 ranges and goes on in the one where they pass what is allowed."""
    low, high, above = 0.0, 1.0, 0.0
    while True:
        inside = rows.where(F.col("p").between(low, high))
        ranges = inside.groupBy(F.floor((F.col("p") - low) / (high - low) * 1000).alias("k")).agg(F.sum("weight").alias("weight"), F.min("p").alias("low"), F.max("p").alias("high"))
        for r in sorted(ranges.collect(), key=lambda r: -r["k"]):  # at most 1,001 rows
            if above + r["weight"] > allowed:
                break
            above += r["weight"]
        else:
            return 0.0
        if r["low"] == r["high"]:
            return r["low"]
        low, high = r["low"], r["high"]


def prediction(hits: Column, weights: dict[str, list[float]], biases: dict[str, float]) -> Column:
    """family (the likeliest but unknown) and its probability by the features of a line; null without a feature."""
    families = list(biases)
    table = F.from_json(F.lit(json.dumps(weights)), "map<string,array<double>>")
    start = F.array(*[F.lit(biases[f]) for f in families])

    def softmax(logits: Column) -> Column:
        top, named = F.array_max(logits), F.slice(logits, 1, len(families) - 1)
        total = F.aggregate(F.transform(logits, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
        best = F.array_max(named)
        family = F.element_at(F.array(*[F.lit(f) for f in families]), F.array_position(named, best).cast("int"))
        return F.struct(family.alias("family"), (F.exp(best - top) / total).alias("probability"))

    added = F.aggregate(hits, start, lambda a, g: F.zip_with(a, F.element_at(table, g), lambda x, y: x + y))
    return F.when(F.size(hits) > 0, let(added, softmax))


def judged(line: Column, weights: dict[str, list[float]], biases: dict[str, float]) -> Column:
    """The prediction for a line; null if it has no feature of the vocabulary."""
    return let(hits_of(line, list(weights)), lambda hits: prediction(hits, weights, biases))


def score(lines: DataFrame, weights: dict[str, list[float]], biases: dict[str, float]) -> DataFrame:
    """id, family and probability of the rows of (id, line) with a feature."""
    return lines.select("id", judged(F.col("line"), weights, biases).alias("judged")).where("judged is not null").select("id", "judged.family", "judged.probability")


def marked(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """The rows of docs with n_paragraphs and found: (paragraph: line number from 0, family, probability, confirmed) of every paragraph predicted to be a licence."""
    weights, biases, limit = train(docs.sparkSession, docs, templates)

    def confirmed(line: Column, family: Column) -> Column:
        return ~line.rlike(_DENIES) & let(words_of(line), lambda w: confirms(w, templates, family))

    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    each = F.transform(lines, lambda x, i: F.struct(i.alias("paragraph"), x.alias("line"), F.when(x.rlike(_BLANK), judged(x, weights, biases)).alias("judged")))
    likely = F.filter(each, lambda x: F.coalesce(x["judged"]["probability"] >= limit, F.lit(False)))
    found = F.transform(likely, lambda x: F.struct(x["paragraph"], x["judged"]["family"].alias("family"), x["judged"]["probability"].alias("probability"), confirmed(x["line"], x["judged"]["family"]).alias("confirmed")))
    made = F.struct(F.size(F.filter(lines, lambda x: x.rlike(_BLANK))).cast("long").alias("n_paragraphs"), found.alias("found"))
    # one row in, one row out: what follows doesn't repeat the work
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.explode(F.array(made)).alias("made"))
    return rows.select("row", "made.n_paragraphs", "made.found")


def scan(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """doc_id, paragraph, family, probability, confirmed of every paragraph predicted to be a licence."""
    return marked(docs, templates).select("row.doc_id", F.inline("found"))


def report(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_paragraphs, n_predicted, families (confirmed ones, sorted, joined by a comma)."""
    rows = marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), templates)
    families = F.array_sort(F.array_distinct(F.transform(F.filter("found", lambda x: x["confirmed"]), lambda x: x["family"])))
    return rows.select("row.doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_predicted"), F.array_join(families, ",").alias("families"))

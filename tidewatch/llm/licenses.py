"""Licence notices: a trained classifier of paragraphs, confirmed against templates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

# Short notices of licence families.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
# Sentences with words of licences that name none.
OTHERS = [
    "All rights reserved.",
    "The licence of the driver was valid.",
    "Copyright of the pictures stays with the authors.",
    "Please ask for permission first.",
    "This comes without any warranty.",
    "A new version was released under great pressure.",
    "The work is under way and the terms are general.",
]

FEATURES = 1 << 12
# Documents whose lines stand for text that is no notice: those with the smallest ids.
SAMPLE_DOCS, SAMPLE_LINES = 200, 1_000
LEAST_SHARE = 0.6
# Words of licences in the languages of the documents; what has one may be an unknown notice.
_STEMS = [
    "licenc", "licens", "lizenz", "lizens", "copyright", "urheberrecht", "spdx", "redistribu", "weitergabe",
    "permission", "permiso", "genehmigung", "autorisation", "autoriza", "warrant", "gew\u00e4hrleistung",
    "garant\u00eda", "garantie", "derechos reservados", "droits r\u00e9serv", "rechte vorbehalten",
    "creative commons",
]
_ANCHORS = rf"(?i){'|'.join(_STEMS)}|\bCC BY\b"
# Words of templates that say little alone. Without any other word of a template less than
# ``LEAST_SHARE`` of it is left, so a notice has an anchor or one of the others.
_WEAK = {"a", "and", "any", "by", "for", "in", "is", "it", "of", "or", "person", "terms", "the", "this", "to", "under"}
_WEAK |= {"use", "with", "work", "you"}
_NONE = 0.0


_WORD = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"


def _grams_of_words(w: Column) -> Column:
    return F.array_distinct(
        F.concat(
            w,
            F.zip_with(
                F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
                F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
                lambda a, b: F.concat_ws(" ", a, b),
            ),
        )
    )


def _with_grams(paragraphs: DataFrame) -> DataFrame:
    """Add ``grams``: distinct words and pairs of neighbouring words, lower-case; marks other than
    ``.-`` inside a word cut it."""
    return paragraphs.withColumn("_words", _words(F.col("paragraph"))).withColumn("grams", _grams_of_words(F.col("_words"))).drop("_words")


def _features(paragraphs: DataFrame) -> DataFrame:
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    return hashing.transform(paragraphs)


def _lines(docs: DataFrame) -> DataFrame:
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("line"), line.alias("paragraph")))
    return docs.select(F.col("doc_id").cast("bigint"), F.explode(numbered).alias("_l")).select("doc_id", "_l.*")


def _template_words() -> list[list[str]]:
    return [re.findall(r"\w+(?:[.-]\w+)*", x.lower()) for notices in TEMPLATES.values() for x in notices]


def _trie(words: set[str]) -> str:
    """A pattern of ``words`` that looks at each letter of the text once."""
    following: dict[str, set] = {}
    for word in words - {""}:
        following.setdefault(word[0], set()).add(word[1:])
    options = "|".join(re.escape(c) + _trie(rest) for c, rest in sorted(following.items()))
    return f"(?:{options})" + ("?" if "" in words else "") if options else ""


def _hints() -> str:
    """A pattern that each line run with ``LEAST_SHARE`` of a template has in lower case, and each
    text with one of ``_ANCHORS``."""
    words = {w for words in _template_words() for w in words} - _WEAK | {"cc by"}

    def ahead(words: set[str]) -> str:
        return f"(?=[{''.join(sorted({re.escape(w[0]) for w in words}))}]){_trie(words)}"

    return rf"{ahead(set(_STEMS))}|\b{ahead(words)}\b"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _near(lines: Column, most: int) -> Column:
    """The first of ``lines``, arrays of words, until one has no word or there are ``most`` words."""

    def step(done: Column, line: Column) -> Column:
        go = done["open"] & (F.size(line) > 0)
        n = done["n"] + F.when(go, F.size(line)).otherwise(0)
        kept = F.when(go, F.concat(done["kept"], F.array(line))).otherwise(done["kept"])
        return F.struct(kept.alias("kept"), n.alias("n"), (go & (n < most)).alias("open"))

    nothing = F.array().cast("array<array<string>>")
    begin = F.struct(nothing.alias("kept"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    return F.aggregate(lines, begin, step, lambda done: done["kept"])


def _runs(docs: DataFrame) -> DataFrame:
    """``doc_id, line, text, alone, before, after, hot, hot_after`` for the lines near a word of ``_hints``.

    ``alone`` has the words of the line, ``before`` (nearest first) and ``after`` the words of the lines of
    the paragraph within the words of the longest template. ``hot`` says whether the line has a word of
    ``_hints``, ``hot_after`` whether one of the lines after has. The words of a line are found once."""
    most = max(map(len, _template_words())) - 1
    hints = _hints()
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("_text"))
    docs = docs.select("doc_id", F.split("_text", "\n", -1).alias("_lines"))
    hot = F.transform("_lines", lambda line: F.lower(line).rlike(hints))
    docs = docs.select("doc_id", F.inline(F.array(F.struct("_lines", hot.alias("_hot")))))
    docs = docs.where(F.exists("_hot", lambda hot: hot))
    docs = docs.select("doc_id", "_lines", "_hot", F.transform("_lines", _words).alias("_words"))
    at = F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1),
        lambda i: (F.size(F.get("_words", i)) > 0)
        & F.exists(F.slice("_hot", i + 1, F.lit(most + 1)), lambda hot: hot),
    )

    # Rows leave the text with the lines around them only, so a long text isn't copied for each line.
    def around(i: Column) -> Column:
        first = F.greatest(i - most, F.lit(0))
        after = _near(F.slice("_words", i + 2, F.lit(most)), most)
        return F.struct(
            i.alias("line"),
            F.get("_lines", i).alias("text"),
            F.get("_words", i).alias("alone"),
            _near(F.reverse(F.slice("_words", first + 1, i - first)), most).alias("before"),
            after.alias("after"),
            F.get("_hot", i).alias("hot"),
            F.slice("_hot", i + 2, F.lit(most)).alias("following"),
        )

    found = docs.select("doc_id", F.explode(F.transform(at, around)).alias("_r")).select("doc_id", "_r.*")
    hot_after = F.exists(F.slice("following", F.lit(1), F.size("after")), lambda hot: hot)
    return found.withColumn("hot_after", hot_after).drop("following")


def train(docs: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """A classifier of the families of ``TEMPLATES`` (1, 2, ...) and of no notice (0), and the
    probability that a family needs.

    Notices are the templates, alone and beside ordinary lines; ordinary lines and ``OTHERS`` are
    no notice. Ordinary lines come from the ``SAMPLE_DOCS`` documents with the smallest ids, at
    most ``SAMPLE_LINES``. Every other one of them is held out, and the probability needed is the
    highest that any family gets on those, 0.5 at least.
    """
    spark = docs.sparkSession
    sample = docs.select("doc_id", "text").orderBy("doc_id", F.xxhash64("text")).limit(SAMPLE_DOCS)
    plain = _lines(sample).where(~F.col("paragraph").rlike(_ANCHORS)).where(F.length("paragraph") > 0)
    plain = plain.select(F.substring("paragraph", 1, 400).alias("paragraph"))
    plain = [r[0] for r in plain.orderBy(F.xxhash64("paragraph"), "paragraph").limit(SAMPLE_LINES).collect()]
    trained, held_out = plain[::2], plain[1::2]
    rows = [(_NONE, line) for line in trained + OTHERS * 20]
    for label, notices in enumerate(TEMPLATES.values(), 1):
        for notice in notices:
            beside = [" ".join(line.split()[:8]) for line in trained[:10]]
            rows += [(float(label), x) for x in [notice] * 10 + [f"{notice} {b}" for b in beside]]
    learnt = _features(_with_grams(spark.createDataFrame(rows, "label double, paragraph string").coalesce(1)))
    model = LogisticRegression(maxIter=40, regParam=0.001, family="multinomial").fit(learnt)
    others = spark.createDataFrame([(x,) for x in held_out + OTHERS], "paragraph string").coalesce(1)
    scored = model.transform(_features(_with_grams(others)))
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(TEMPLATES)))
    highest = scored.agg(F.max(best)).first()[0] or 0.0
    return model, max(0.5, min(highest, 0.9))


def license_notices(docs: DataFrame) -> DataFrame:
    """``doc_id, line, family, probability, template_share`` of each notice in ``docs`` (doc_id, text), in
    whole texts; ``line`` is the one where it begins.

    Each line is classified alone, and together with the lines after it in its paragraph as far as
    the longest template reaches, so a notice may be wrapped at any width. It gets the likeliest
    family if that is likely enough and if at least ``LEAST_SHARE`` of the words and word pairs of one
    of the family's templates are there, else "unknown". A run of lines counts if neither its first
    line nor the rest has that share; it begins where the template's word pairs go on over line
    breaks. A line without family is unknown only if it has one of ``_ANCHORS`` and is no part of a run.
    What the classifier takes for no notice is left out. Only text near a word of ``_hints`` is
    classified, without which no template's share is reached. Scoring is a sparse product for
    each line and run, without shuffle. NULL and empty texts have no lines; repeated rows give repeated
    results; missing ids stay NULL; other columns are ignored. Without documents nothing is
    trained on ordinary lines, and nothing is found.
    """
    model, least = train(docs)
    names = list(TEMPLATES)
    templates = docs.sparkSession.createDataFrame(
        [(name, notice) for name, notices in TEMPLATES.items() for notice in notices], "name string, paragraph string"
    )
    grams: dict[str, list] = {name: [] for name in names}
    for row in _with_grams(templates).collect():
        grams[row["name"]].append(row["grams"])

    def part(column: str, g: list) -> Column:
        return F.size(F.array_intersect(column, F.array(*map(F.lit, g)))) / len(g)

    def share(name: str, column: str = "grams") -> Column:
        parts = [part(column, g) for g in grams[name]]
        return F.greatest(*parts) if len(parts) > 1 else parts[0]

    def of_family(value) -> Column:
        return F.coalesce(*[F.when(F.col("_name") == name, value(name)) for name in names])

    # Words of the line, of the lines after, of all others, and of all.
    rest, others = F.flatten("after"), F.flatten(F.concat(F.reverse("before"), F.col("after")))
    whole_run = F.flatten(F.concat(F.array("alone"), F.col("after")))
    around = F.flatten(F.concat(F.reverse("before"), F.array("alone"), F.col("after")))
    line = F.struct(F.lit(False).alias("run"), F.col("hot").alias("hot"), F.col("alone").alias("words"))
    run_hot = (F.size("after") > 0) & (F.col("hot") | F.col("hot_after"))
    run = F.struct(F.lit(True).alias("run"), run_hot.alias("hot"), whole_run.alias("words"))
    # Generated columns are computed once for each row: filters on them are not pushed below, where they
    # would be computed again for each use.
    both = F.transform(
        F.filter(F.array(line, run), lambda c: c["hot"]),
        lambda c: F.struct(c["run"].alias("run"), _grams_of_words(c["words"]).alias("grams")),
    )
    candidates = _runs(docs).select("*", F.inline(both)).drop("hot", "hot_after")
    scored = model.transform(_features(candidates))
    scored = scored.where(F.col("prediction") != _NONE).withColumn(
        "_name", F.get(F.array(*map(F.lit, names)), F.col("prediction").cast("int") - 1)
    )
    four = F.transform(F.array("alone", rest, others, around), _grams_of_words)
    found = {
        "probability": F.round(F.array_max(vector_to_array("probability")), 6),
        "_grams": F.col("grams"),
        "_alone": F.get(four, F.lit(0)),
        "_rest": F.get(four, F.lit(1)),
        "_others": F.get(four, F.lit(2)),
        "_around": F.get(four, F.lit(3)),
    }
    found = F.explode(F.array(F.struct(*[value.alias(name) for name, value in found.items()])))
    scored = scored.select("doc_id", "line", "run", "text", "alone", "before", "_name", found.alias("_found"))
    scored = scored.select("*", "_found.*").drop("_found")
    share_of_family = F.round(of_family(lambda name: share(name, "_grams")), 6)
    scored = scored.select("*", F.explode(F.array(share_of_family)).alias("template_share"))
    in_run = reduce(
        lambda a, b: a | b,
        [
            (part("_around", g) >= LEAST_SHARE) & (part("_others", g) < part("_around", g))
            for own in grams.values()
            for g in own
        ],
    )
    enough = F.col("template_share") >= LEAST_SHARE
    whole = enough & (of_family(lambda x: share(x, "_rest")) < LEAST_SHARE)
    whole &= of_family(lambda x: share(x, "_alone")) < LEAST_SHARE
    open_line = F.col("text").rlike(_ANCHORS) & ~in_run
    scored = scored.where(F.when(F.col("run"), whole).otherwise(enough | open_line))

    # Words at both sides of the line breaks before, nearest first.
    ends = F.concat(F.array("alone"), F.col("before"))
    pairs = F.zip_with(
        F.slice(ends, F.lit(1), F.size("before")),
        "before",
        lambda after, line: F.concat_ws(
            " ", F.try_element_at(line, F.lit(-1)), F.try_element_at(after, F.lit(1))
        ),
    )

    def back(name: str) -> Column:
        own = F.array(*[F.lit(x) for x in sorted({x for g in grams[name] for x in g if " " in x}) or [""]])
        begin = F.struct(F.lit(0).alias("n"), F.lit(True).alias("open"))

        def step(done: Column, pair: Column) -> Column:
            go = done["open"] & F.array_contains(own, pair)
            return F.struct((done["n"] + go.cast("int")).alias("n"), go.alias("open"))

        return F.aggregate(pairs, begin, step, lambda done: done["n"])

    scored = scored.withColumn("line", F.col("line") - F.when(enough, of_family(back)).otherwise(0))
    sure = (F.col("probability") >= least) & enough
    family = F.when(sure, F.col("_name")).otherwise("unknown")
    return scored.select(
        "doc_id", F.col("line").cast("bigint"), family.alias("family"), "probability", "template_share"
    )

"""License scans by diagonal voting, in DataFrame functions only.

Words are lower-cased runs of ASCII letters, digits and all that is beyond ASCII. The hashes of
all rolling ``GRAM``-word windows of the texts are joined to the positions they have in the
templates. Each hit votes for a diagonal, the place in the text minus the place in the
template. Neighbouring diagonals (words put in or left out move a template's rest by as many)
are merged, and a merged span is verified: it must hold enough of the template and not be much
longer. Where spans of one family overlap, the fullest stays. A phrase is a short template that
must be there whole, on one diagonal.

Defined results: a text that is null or has no word has no places, 0 words, null first and last
words and empty labels; equal rows get equal results; ties between overlapping spans of one
family keep all that tie. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared

#: Words of a rolling window.
GRAM = 3
#: Diagonals that are merged differ by this many words at most.
SHIFT = 4
#: Part of a template's windows that a span must hold, and how much longer than the template
#: it may be.
LEAST, LONGEST = 0.75, 1.5
#: Words of a block in which overlapping spans meet.
BLOCK = 256

# Phrases (label, words) of the contract, and public license notices
# (label, family, text).
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    (
        "mit",
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "apache-2",
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "bsd",
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ),
    (
        "gpl-2",
        "gpl",
        "under the terms of the GNU General Public License as published by the Free Software"
        " Foundation; either version 2 of the License, or (at your option) any later version",
    ),
    (
        "gpl-3",
        "gpl",
        "under the terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    ("gpl-2", "gpl", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "gpl", "licensed under the GNU General Public License, version 3"),
    (
        "mpl-2",
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
        " If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "cc-by",
        "cc",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    (
        "cc-by-sa",
        "cc",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0"
        " International License",
    ),
    (
        "cc-by-nc",
        "cc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License",
    ),
    (
        "unlicense",
        "unlicense",
        "This is free and unencumbered software released into the public domain",
    ),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def grams_of(words: Column) -> Column:
    """Hashes of all windows; shorter texts have none."""
    last = F.size(words) - GRAM
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[words[i + k] for k in range(GRAM)]))


def template_grams(spark: SparkSession) -> DataFrame:
    """template, label, family (null: a phrase), windows, place, gram of the fixed templates: a
    table of a few hundred rows."""
    rows = [(label, None, text) for label, text in PHRASES] + list(TEMPLATES)
    literal = F.array(
        *[
            F.struct(
                F.lit(k).alias("template"),
                F.lit(label).alias("label"),
                F.lit(family).cast("string").alias("family"),
                F.lit(text).alias("text"),
            )
            for k, (label, family, text) in enumerate(rows)
        ]
    )
    return (
        spark.range(1)
        .select(F.explode(literal).alias("t"))
        .select("t.*")
        .withColumn("words", words_of(F.col("text")))
        .withColumn("grams", grams_of(F.col("words")))
        .withColumn("windows", F.size("grams"))
        .select(
            "template", "label", "family", "windows", F.posexplode("grams").alias("place", "gram")
        )
    )


def hits_of(texts: DataFrame, templates: DataFrame) -> DataFrame:
    """Every place of a window of ``texts`` (doc_id, mark, words) that a template has too."""
    return (
        texts.select("doc_id", "mark", F.posexplode(grams_of(F.col("words"))).alias("at", "gram"))
        .join(F.broadcast(templates), "gram")
        .select("doc_id", "mark", "template", "label", "family", "windows", "at", "place")
        .distinct()
    )


def phrase_places(hits: DataFrame) -> DataFrame:
    """doc_id, mark, label, start: a diagonal with every window of the phrase."""
    return (
        hits.filter("family is null")
        .groupBy("doc_id", "mark", "template", "label", "windows", (F.col("at") - F.col("place")).alias("start"))
        .agg(F.count(F.lit(1)).alias("votes"))
        .filter("votes = windows")
        .select("doc_id", "mark", "label", "start")
    )


def spans_of(hits: DataFrame) -> DataFrame:
    """doc_id, mark, label, family, start, end, share of the verified spans."""
    own = ["doc_id", "mark", "template"]
    diagonals = (
        hits.filter("family is not null")
        .withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy(*own, "label", "family", "windows", "diagonal")
        .agg(
            F.min("at").alias("low"),
            F.max("at").alias("high"),
            F.collect_set("place").alias("places"),
        )
    )
    order = Window.partitionBy(*own).orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    merged = (
        diagonals.withColumn("new", F.when(step <= SHIFT, 0).otherwise(1))
        .withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*own, "label", "family", "windows", "span")
        .agg(
            F.min("low").alias("start"),
            (F.max("high") + GRAM).alias("end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("held"),
        )
        .withColumn("share", F.col("held") / F.col("windows"))
        .filter(F.col("share") >= LEAST)
        .filter(F.col("end") - F.col("start") <= LONGEST * (F.col("windows") + GRAM - 1))
    )
    return fullest(shared.stored(merged, "spans"))


def fullest(merged: DataFrame) -> DataFrame:
    """The spans that no fuller one of their family overlaps."""
    # Two spans that overlap share the block in which the later one begins; a span covers few blocks,
    # and a block holds as many spans as there are templates and places in it, however many a
    # document has.
    covered = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK)))
    names = ["doc_id", "mark", "template", "label", "family", "span", "start", "end", "share"]
    placed = merged.select(*names, covered.alias("block"))
    other = placed.select(
        *[F.col(c).alias(f"o_{c}") for c in ("doc_id", "mark", "family", "start", "end", "share", "block")]
    )
    fuller = (
        F.col("doc_id").eqNullSafe(F.col("o_doc_id"))
        & (F.col("mark") == F.col("o_mark"))
        & (F.col("family") == F.col("o_family"))
        & (F.col("block") == F.col("o_block"))
        & (F.col("o_start") < F.col("end"))
        & (F.col("start") < F.col("o_end"))
        & (F.col("o_share") > F.col("share"))
    )
    beaten = placed.join(other, fuller, "left_semi").select(
        *[F.col(c).alias(f"b_{c}") for c in ("doc_id", "mark", "template", "span")]
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("b_doc_id"))
        & (F.col("mark") == F.col("b_mark"))
        & (F.col("template") == F.col("b_template"))
        & (F.col("span") == F.col("b_span"))
    )
    return merged.join(beaten.distinct(), same, "left_anti").select(
        "doc_id", "mark", "label", "family", "start", "end", "share"
    )


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts (doc_id, mark of the text, words), phrase places and template spans."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    hits = shared.stored(hits_of(texts, template_grams(docs.sparkSession)), "hits")
    return texts, phrase_places(hits), spans_of(hits)


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: words, phrase places and labels of every document."""
    texts, places, spans = scan(shared.read(spark, sf_dir, "documents"))
    both = places.select(
        "doc_id", "mark", "label", "start", F.lit(1.0).alias("share"), F.lit(True).alias("base")
    ).union(
        spans.select(
            "doc_id", "mark", "label", F.lit(None).cast("int"), "share", F.lit(False)
        )
    )
    found = both.groupBy("doc_id", "mark").agg(
        F.count("start").alias("n_base"),
        F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias(
            "base_labels"
        ),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    left = texts.select("doc_id", "mark", F.size("words").cast("long").alias("n_words")).alias("l")
    same = F.col("l.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("l.mark") == F.col("f.mark"))
    return left.join(found.alias("f"), same, "left").select(
        "l.doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

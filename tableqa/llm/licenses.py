"""License scan by diagonal voting over rolling word grams; DataFrame operations only.

All runs of two words of all documents are hashed and joined with the runs of the templates (a few hundred rows). A hit
at word p of a text and word t of a template votes for the diagonal p - t. Votes are counted by diagonal; neighbouring
diagonals (a word more or less here and there) of a document and template are merged; a merged span is accepted if it
covers enough of the template's words within a stretch not much longer than the template. A base phrase stands where
one diagonal has the votes of all its runs.

Edges: null and empty texts have no words and no labels; repeated rows (equal id and text) give as many result rows;
templates of one word match nothing; an empty table gives no rows. Long texts are a single array of hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableqa.llm import common

GRAM = 2
# Phrases and labels asked for.
BASE_PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Usual notices, each with its label.
NOTICES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "CC BY-NC 4.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nd", "CC BY-ND 4.0"),
    ("all-rights-reserved", "All rights reserved."),
)


def templates(spark: SparkSession, base: Sequence[tuple[str, str]] = BASE_PHRASES,
              notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row for each template: template, label, text, whether it is a base phrase."""
    rows = [(i, label, text, i < len(base)) for i, (label, text) in enumerate([*base, *notices])]
    return spark.createDataFrame(rows, "template int, label string, text string, base boolean")


def template_grams(known: DataFrame) -> DataFrame:
    """(hash, template, at, runs): the runs of every template by their place in it."""
    return (
        known.select("template", common.words("text").alias("w")).where(F.size("w") >= GRAM)
        .select("template", (F.size("w") - GRAM + 1).alias("runs"), F.posexplode(common.word_grams(F.col("w"), GRAM)).alias("at", "hash"))
        .where(F.col("at") < F.col("runs"))
    )


def votes(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Votes by diagonal: key, mark, n_words, template, diagonal, hits (places in the template that voted), copies.

    `mark` is a hash of the text: rows of equal key and mark are copies and are counted in `copies` in the row without
    template that each of them has.
    """
    hashed = docs.select(
        F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), common.words(text).alias("w"),
    ).select("key", "mark", F.size("w").alias("n_words"), common.word_grams(F.col("w"), GRAM).alias("grams"))
    # the first entry stands for the document itself
    runs = hashed.select("key", "mark", "n_words", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), F.col("grams"))).alias("p", "hash"))
    hits = runs.join(F.broadcast(template_grams(known)), "hash", "left").where("template IS NOT NULL OR p = 0")
    hits = hits.withColumn("template", F.when(F.col("p") > 0, F.col("template")))
    return hits.groupBy("key", "mark", "n_words", "template", (F.col("p") - 1 - F.col("at")).alias("diagonal")).agg(
        F.array_sort(F.collect_set("at")).alias("hits"), F.count_if(F.col("p") == 0).alias("copies"),
    )


def spans(voted: DataFrame, known: DataFrame, reach: int = 2, cover: float = 0.9, stretch: float = 1.25) -> DataFrame:
    """Accepted spans: key, mark, label, base, exact, start, end (words, end exclusive), score (covered share).

    Diagonals of a document and template at most `reach` apart are merged; `cover` of the template's words must be in
    the span, which may be `stretch` times as long as the template.
    """
    sizes = known.select("template", "label", "base", F.size(common.words("text")).alias("size"))
    of = Window.partitionBy("key", "mark", "template").orderBy("diagonal")
    lined = (
        voted.where("template IS NOT NULL")
        .withColumn("new", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(of), F.lit(reach + 1)) > reach).cast("int"))
        .withColumn("island", F.sum("new").over(of))
    )
    merged = lined.groupBy("key", "mark", "template", "island").agg(
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.min(F.col("diagonal") + F.element_at("hits", 1)).alias("start"),
        F.max(F.col("diagonal") + F.element_at("hits", -1) + GRAM).alias("end"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h, h + GRAM - 1)))))
    return (
        merged.join(F.broadcast(sizes), "template")
        .withColumn("score", covered / F.col("size"))
        .where((F.col("score") >= cover) & (F.col("end") - F.col("start") <= F.ceil(F.col("size") * stretch)))
        .select("key", "mark", "label", "base", "start", "end", "score")
    )


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: n_words, base places (n_base, first_word, last_word, base_labels), labels and score."""
    voted = common.cut(votes(docs, known, key, text))
    full = template_grams(known).groupBy("template").agg(F.max("runs").alias("runs"))
    phrases = known.where("base").join(full, "template").select("template", "label", "runs")
    base = (
        voted.join(F.broadcast(phrases), "template").where(F.size("hits") == F.col("runs"))
        .select("key", "mark", "label", F.col("diagonal").alias("place"), F.lit(1.0).alias("score"))
    )
    added = spans(voted, known).select("key", "mark", "label", F.lit(None).cast("int").alias("place"), "score")
    found = base.unionByName(added).groupBy("key", "mark").agg(
        F.count("place").alias("n_base"), F.min("place").cast("long").alias("first_word"), F.max("place").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("place").isNotNull(), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"),
    ).select(F.col("key").alias("of"), F.col("mark").alias("of_mark"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = voted.where("template IS NULL").select("key", "mark", F.col("n_words").cast("long").alias("n_words"), "copies")
    return (
        rows.join(found, F.col("key").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            F.col("key").alias(key), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )

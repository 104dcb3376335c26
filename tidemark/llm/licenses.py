"""Licence scans by diagonal voting.

All rolling word k-gram hashes of the documents are joined with the places of the same k-grams in licence templates.
Hits of one copy of a template lie on one diagonal, document position minus template position; words put in or left out
move the rest of the copy to a neighbouring diagonal. Hits are counted per diagonal, neighbouring diagonals are merged,
and the span found is verified against the template word by word.

Beside it, the places of fixed phrases are found exactly.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import may_match, stored, text_of

# Phrases and what they are labelled, and wordings of common licence notices.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
     " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
     " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
     " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the"
     " License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
     " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
     " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
     " disclaimer"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 4
# Diagonals at most so far apart belong to one copy; a copy has at least this share of the template's k-grams and words.
SLACK = 4
LEAST_GRAMS = 0.5
LEAST_WORDS = 0.7
BASE_SCORE = 0.5


def words_of(text: Column) -> Column:
    """Words of a text with only A-Z lowered."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS, -1), "")


def _grams(words: str, k: int) -> Column:
    """Hashes of the k-grams from each place of an array column; empty for fewer than k words."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    made = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, made).otherwise(F.array().cast("array<bigint>"))


def _places(words: str, phrase: str) -> Column:
    parts = phrase.split()
    at = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        same = F.get(F.col(words), i) == parts[0]
        for j, w in enumerate(parts[1:], 1):
            same &= F.get(F.col(words), i + j) == w
        return same

    return F.when(F.size(words) >= len(parts), F.filter(at, here)).otherwise(F.array().cast("array<int>"))


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...], k: int) -> DataFrame:
    """``template, label, at, gram, grams, template_words``: one row per place of each template."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    rows = rows.withColumn("template_words", words_of(F.col("text"))).withColumn("all", _grams("template_words", k))
    return rows.select("template", "label", F.size("all").alias("grams"), F.array_distinct("template_words").alias("template_words"), F.posexplode("all").alias("at", "gram"))


def spans(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, k: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified copies: ``id, version, label, start, end, votes, share``.

    ``version`` is a hash of the text, so that rows that share an identifier are told apart; equal rows give their spans
    once. ``start`` and ``end`` are word positions, ``share`` is the part of the template's k-grams that was found.
    """
    spark = docs.sparkSession
    places = template_table(spark, templates, k)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    words = texts.select("id", F.xxhash64("text").alias("version"), words_of(F.col("text")).alias("words"))
    # The outer form: the plain one adds a filter for which the words would be split again at every place.
    grams = words.select("id", "version", _grams("words", k).alias("grams")).select("id", "version", F.posexplode_outer("grams").alias("pos", "gram"))
    # The templates are a parameter written by hand: a few hundred places.
    hits = grams.join(F.broadcast(places.select("template", "label", "at", "gram", F.col("grams").alias("of"))), "gram")
    per = hits.withColumn("diagonal", F.col("pos") - F.col("at")).groupBy("id", "version", "template", "label", "of", "diagonal").agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("first"), F.max("pos").alias("last")
    )
    along = Window.partitionBy("id", "version", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > SLACK).cast("int"), F.lit(1))
    merged = per.withColumn("new", new).withColumn("copy", F.sum("new").over(along)).groupBy("id", "version", "template", "label", "of", "copy").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("votes"), F.min("first").alias("start"), (F.max("last") + k).alias("end")
    )
    likely = stored(merged.filter(F.col("votes") >= F.col("of") * LEAST_GRAMS), "licence-spans")
    holders = may_match(texts, "id", likely).withColumn("version", F.xxhash64("text")).distinct()
    both = likely.join(holders.withColumnsRenamed({"id": "own", "version": "own_version"}), F.col("id").eqNullSafe(F.col("own")) & (F.col("version") == F.col("own_version")))
    both = both.join(F.broadcast(places.select("template", "template_words").distinct()), "template")
    inside = F.slice(words_of(F.col("text")), F.col("start") + 1, F.col("end") - F.col("start"))
    common = F.size(F.array_intersect("template_words", inside)) / F.size("template_words")
    return both.filter(common >= LEAST_WORDS).select("id", "version", "label", F.col("start").cast("long"), F.col("end").cast("long"), "votes", (F.col("votes") / F.col("of")).alias("share"))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, k: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    The base columns are about the places of the fixed phrases; ``labels`` adds those of verified template copies, and
    ``spans`` has (label, start, end). ``score`` is the largest share of a template that was found, at least 0.5 with a
    base phrase, else 0. A null text counts as empty. Rows without or with repeated identifiers are scanned like others.
    """
    found = spans(docs, templates, k, id_col, text_col).groupBy("id", "version").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share"), F.array_sort(F.collect_set(F.struct("label", "start", "end"))).alias("spans")
    )
    found = found.withColumnsRenamed({"id": "of_id", "version": "of_version"})
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("version"), words_of(text).alias("words"))
    none = F.array().cast("array<int>")
    may = F.array_contains("words", PHRASES[0][0].split()[-1])
    rows = rows.withColumns({f"at{i}": F.when(may, _places("words", phrase)).otherwise(none) for i, (phrase, _) in enumerate(PHRASES)})
    places = F.concat(*[F.col(f"at{i}") for i in range(len(PHRASES))])
    names = F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)])))
    base = rows.select(
        "id", "version", F.size("words").cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"), F.array_sort(names).alias("base"),
    )
    joined = base.join(found, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version")), "left")
    all_labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"), score.cast("double").alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<label:string,start:bigint,end:bigint>>")).alias("spans"),
    )

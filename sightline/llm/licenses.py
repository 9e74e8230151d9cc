"""License scans by diagonal voting over word k-grams (operator 11)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of texts in lower case
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
BROADCAST_GRAMS = 200_000  # rows of template positions that may be broadcast
COVERAGE = 0.8  # share of a notice's k-grams that a span must hold
SHIFT = 8  # words that may be put in or left out between two parts of a span


class Template(NamedTuple):
    """A text that stands for a license; a phrase must stand word for word."""

    label: str
    text: str
    phrase: bool = False


#: Phrases of the base labels, then notices as the licenses' authors ask for them.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("gpl-3", "licensed under the GNU General Public License, version 3"),
    Template("gpl-2", "licensed under the GNU General Public License, version 2"),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation"),
    Template("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike License"),
    Template("cc-by", "licensed under a Creative Commons Attribution License"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial License"),
    Template("public-domain", "This is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "all rights reserved", True),
)
# End of fixed values.


def words_of(text: str) -> list[str]:
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    return re.findall(WORD, lower)


def template_grams(spark: SparkSession, templates: Sequence[Template] = TEMPLATES, k: int = GRAM) -> DataFrame:
    """(template, label, phrase, n_grams, tpos, gram, hash): the k-grams of all templates.

    A template of fewer than ``k`` words is refused, since it has no k-gram.
    """
    rows = []
    for number, t in enumerate(templates):
        words = words_of(t.text)
        if len(words) < k:
            raise ValueError(f"template {t.label!r} has fewer than {k} words")
        n = len(words) - k + 1
        rows += [(number, t.label, t.phrase, n, i, words[i : i + k]) for i in range(n)]
    schema = "template int, label string, phrase boolean, n_grams int, tpos int, gram array<string>"
    return spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64(*[F.col("gram")[j] for j in range(k)]))


def _words(text: Column) -> Column:
    """The array of a text's words, cut at the runs between them, which is far cheaper than to match
    the words.  U+212A is the only other character whose lower case is an ASCII letter alone."""
    pieces = F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\ufffd"))), GAP, -1)
    before = (pieces[0] == "").cast("int")  # a gap at the start, and one at the end, leave an empty piece
    after = (F.element_at(pieces, -1) == "").cast("int")
    return F.slice(pieces, before + 1, F.greatest(F.size(pieces) - before - after, F.lit(0)))


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(key, doc_id, text); rows of the same id and text share a key."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), body).cast("binary"))
    return docs.select(key.alias("key"), F.col(doc_id).alias("doc_id"), body.alias("text"))


def diagonal_votes(keyed: DataFrame, grams: DataFrame, k: int = GRAM) -> DataFrame:
    """(key, template, label, phrase, n_grams, diagonal, hits): the template positions that stand in
    a document on the same diagonal, that is word position minus template position.

    Every rolling k-gram of a document meets the template positions of equal hash; the words are
    compared as well, so that no vote rests on a hash alone.  Votes are combined before the shuffle.
    """
    words = keyed.select("key", _words(F.col("text")).alias("words"))
    # a filter on the number of words would be pushed below and split every text twice
    places = F.when(F.size("words") >= k, F.sequence(F.lit(0), F.size("words") - k))
    rolled = words.select("key", "words", F.explode(places).alias("pos"))
    word = lambda j: F.col("words")[F.col("pos") + j]
    rolled = rolled.withColumn("doc_hash", F.xxhash64(*[word(j) for j in range(k)]))
    # one comparison for all words stays a check of the hash join and is not made a join key
    same = F.least(*[word(j) == F.col("gram")[j] for j in range(k)])
    hits = rolled.join(grams, (F.col("doc_hash") == F.col("hash")) & same)
    return hits.groupBy(
        "key", "template", "label", "phrase", "n_grams", (F.col("pos") - F.col("tpos")).alias("diagonal")
    ).agg(F.collect_set("tpos").alias("hits"))


def license_spans(votes: DataFrame, k: int = GRAM, coverage: float = COVERAGE, shift: int = SHIFT) -> DataFrame:
    """(key, template, label, phrase, start, end, coverage) of the spans that hold a template.

    A phrase stands where its diagonal has all its k-grams.  For other templates neighbouring
    diagonals, at most ``shift`` words (a quarter of a short template's) apart, are merged into one
    span from the first to the last word that they cover; coverage is the share of the template's
    distinct k-grams.  A merged span is verified: it must not be longer than the template by more
    than ``shift`` words and a quarter, else it is held to its best diagonal.  Spans of less than
    ``coverage`` are dropped.
    """
    first = F.col("diagonal") + F.array_min("hits")
    last = F.col("diagonal") + F.array_max("hits") + k
    own = (F.size("hits") / F.col("n_grams")).alias("coverage")
    rows = votes.select("key", "template", "label", "phrase", "n_grams", "diagonal", "hits", first.alias("start"), last.alias("end"), own)
    near = F.least(F.lit(shift), F.floor((F.col("n_grams") + k - 1) / 4))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("phrase") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > near, F.lit(True))
    rows = rows.withColumn("_new", apart.cast("int")).withColumn("_span", F.sum("_new").over(order))
    merged = rows.groupBy("key", "template", "label", "phrase", "n_grams", "_span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("_together"),
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.max(F.struct("coverage", F.col("start").alias("start"), F.col("end").alias("end"))).alias("_best"),
    )
    length = F.col("n_grams") + k - 1
    fits = F.col("end") - F.col("start") <= length + shift + F.floor(length / 4)
    spans = merged.select(
        "key", "template", "label", "phrase",
        F.when(fits, F.col("start")).otherwise(F.col("_best.start")).alias("start"),
        F.when(fits, F.col("end")).otherwise(F.col("_best.end")).alias("end"),
        F.when(fits, F.col("_together") / F.col("n_grams")).otherwise(F.col("_best.coverage")).alias("coverage"),
    )
    return spans.where(F.when(F.col("phrase"), F.col("coverage") >= 1).otherwise(F.col("coverage") >= coverage))


def scan_licenses(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, k: int = GRAM, base: int = 3, coverage: float = COVERAGE,
    shift: int = SHIFT, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    Words are runs of ASCII letters in lower case, digits and non-ASCII characters.  All rolling word
    k-grams of the documents are joined with the positions of the templates by hash, votes are
    counted per offset diagonal, neighbouring diagonals are merged and the spans verified (see
    ``license_spans``).  The first ``base`` templates are the base phrases: n_base counts all places
    where they stand, first_word and last_word are the least and greatest start, base_labels their
    labels.  labels are those of all spans, score is the greatest coverage among these (0 without),
    spans lists (label, start, end, coverage) in word positions.

    The table of template positions is counted and broadcast if it has at most ``BROADCAST_GRAMS``
    rows, else it is joined by a shuffle.  Only hits are shuffled, and a narrow row per document.
    Null and empty texts have no words: zeros, empty labels, null words.  Rows of one id are judged
    each on its own text; copies of a row get equal results; a null id is kept.  No other column of
    ``docs`` is read or returned, so none can clash.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, templates, k)
    if grams.count() <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    keyed = _keyed(docs, text, doc_id)
    spans = license_spans(diagonal_votes(keyed, grams, k), k, coverage, shift)
    is_base = F.col("template") < base
    found = spans.groupBy("key").agg(
        F.count_if(is_base).alias("n_base"), F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(is_base, F.col("label")))).alias("base"),
        F.array_sort(F.collect_set("label")).alias("all"), F.max("coverage").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "coverage"))).alias("spans"),
    )
    counted = keyed.select("key", "doc_id", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<struct<start: int, end: int, label: string, coverage: double>>")
    return counted.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", none).alias("spans"),
    )


def license_digest(docs: DataFrame) -> DataFrame:
    """The scan of every document without its list of spans."""
    return scan_licenses(docs.select("doc_id", "text")).drop("spans")

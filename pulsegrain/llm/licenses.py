"""Licence scan by a positional rare-token index, with DataFrame functions only.

Templates are notices and openings of public licences. Their words, but for the commonest, are the licence words: one pass
over the texts keeps where each stands in a file, which of the templates' key phrases the file has and where the exact phrases
stand. How many files have a licence word tells how rare it is. A file looks up, for every template, the rarest of the
template's words that it has, its anchors; each place of an anchor and each posting of it in the template say where the
template would begin in the file. Beginnings that two anchors agree on are candidates. A candidate is verified if the file has
all key phrases of the template; its score is the part of the template's words, weighed by rarity, that stand in their place.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import stored

# Exact phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices and openings of public licences as label, key phrases and words.
TEMPLATES = (
    ("mit", ("mit license",), "released under the mit license"),
    ("mit", ("mit license",), "licensed under the mit license"),
    ("mit", ("permission is hereby granted free of charge", "without restriction"),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
     "publish distribute sublicense and or sell copies of the software"),
    ("apache-2.0", ("apache license version 2 0",), "licensed under the apache license version 2 0"),
    ("bsd", ("redistribution and use in source and binary forms",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", ("permission to use copy modify and or distribute this software",),
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
     "the above copyright notice and this permission notice appear in all copies"),
    ("gpl-3.0", ("gnu general public license version 3",), "licensed under the gnu general public license version 3"),
    ("gpl-2.0", ("gnu general public license version 2",), "licensed under the gnu general public license version 2"),
    ("gpl", ("gnu general public license", "free software foundation"),
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published "
     "by the free software foundation"),
    ("lgpl", ("gnu lesser general public license",), "under the terms of the gnu lesser general public license"),
    ("agpl", ("gnu affero general public license",), "under the terms of the gnu affero general public license"),
    ("mpl-2.0", ("mozilla public license",), "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", ("eclipse public license",), "made available under the terms of the eclipse public license 2 0"),
    ("unlicense", ("released into the public domain",), "this is free and unencumbered software released into the public domain"),
    ("cc0", ("waived all copyright",), "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("cc-by-nc", ("cc by nc 4 0",), "licensed under cc by nc 4 0"),
    ("cc-by-sa", ("cc by sa 4 0",), "licensed under cc by sa 4 0"),
    ("cc-by-nd", ("cc by nd 4 0",), "licensed under cc by nd 4 0"),
    ("cc-by-4.0", ("creative commons attribution",), "licensed under a creative commons attribution 4 0 international license"),
)
# Words too common to be looked up.
COMMON = frozenset("a all and any are as by can for has in into is it of or that the this to with you".split())

#: Anchors of a file and template at most, and how many must agree on a beginning.
ANCHORS, AGREE = 8, 2
#: Part of a template's weight that a candidate's words must have in their place.
LEAST_SCORE = 0.6

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN, _OTHER = "K", "ĸ"


def normal(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, with one space before, between and after them."""
    # Lower-casing makes an ASCII letter of one sign beyond ASCII, the Kelvin sign; another letter takes its place first.
    low = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit(_KELVIN), F.lit(_OTHER)))
    return F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), _GAPS, " ")


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _places(norm: Column, n_words: Column, phrase: str) -> Column:
    """How often a phrase stands in a normal text, overlaps included, and the first and last word that it begins with; NULL without it."""
    mark = f" {phrase} "
    first = _spaces(F.substring_index(norm, mark, 1))
    last = n_words - _spaces(F.substring_index(norm, mark, -1)) - len(phrase.split())
    n = F.regexp_count(norm, F.lit(f" (?={phrase} )")).cast("bigint")
    return F.when(norm.contains(mark), F.struct(n.alias("n"), first.alias("first"), last.alias("last")))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


class Index:
    """Templates as words with their places; all of it is a fixed number of small values."""

    def __init__(self, templates=TEMPLATES) -> None:
        self.labels = [label for label, _, _ in templates]
        self.phrases = sorted({phrase for _, phrases, _ in templates for phrase in phrases})
        self.keys = [[self.phrases.index(phrase) for phrase in phrases] for _, phrases, _ in templates]
        self.places = [[(place, word) for place, word in enumerate(text.split()) if word not in COMMON] for _, _, text in templates]
        self.words = sorted({word for places in self.places for _, word in places})


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """One row per file, stored: row, doc_id, n_words, base (struct per exact phrase), phrases (numbers of the key phrases it
    has) and hits (places of licence words)."""
    norm = docs.select("doc_id", normal(F.col("text")).alias("norm")).withColumn("n_words", _spaces(F.col("norm")) - 1)
    own = F.filter(F.transform(F.split(F.col("norm"), " "), lambda word, at: F.struct(word.alias("word"), (at.cast("bigint") - 1).alias("at"))),
                   lambda hit: hit["word"].isin(index.words))
    found = norm.select(
        "doc_id", "n_words", F.array(*[_places(F.col("norm"), F.col("n_words"), phrase) for phrase, _ in BASE]).alias("base"),
        F.array_compact(F.array(*[F.when(F.col("norm").contains(f" {phrase} "), n) for n, phrase in enumerate(index.phrases)])).alias("phrases"),
        own.alias("hits"))
    # Numbers of rows are made once, when the table is written.
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "license-words")


def weights(scanned: DataFrame, index: Index) -> dict[str, int]:
    """Thousandths of the inverse document frequency of every licence word over all files; as many rows as licence words are read."""
    words = F.array_distinct(F.transform("hits", lambda hit: hit["word"]))
    seen = {r.word: r.n for r in scanned.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = scanned.count()
    return {word: round(1000 * (1 + math.log((1 + total) / (1 + seen.get(word, 0))))) for word in index.words}


def candidates(scanned: DataFrame, index: Index, weight: dict[str, int]) -> DataFrame:
    """row, template and start (the word of the file where the template would begin), where enough anchors agree."""
    present = F.array_distinct(F.transform("hits", lambda hit: hit["word"]))

    def anchors(number: int) -> Column:
        rarest = sorted({word for _, word in index.places[number]}, key=lambda word: (-weight[word], word))
        return F.slice(F.array_intersect(F.array(*[F.lit(word) for word in rarest]), F.col("present")), 1, ANCHORS)

    # Only files with enough words of a template have anchors of it.
    chosen = F.filter(F.array(*[F.struct(F.lit(n).alias("template"), anchors(n).alias("anchors")) for n in range(len(index.places))]),
                      lambda one: F.size(one["anchors"]) >= AGREE)
    named = scanned.where(F.size("hits") >= AGREE).select("row", "hits", present.alias("present")).select("row", "hits", F.explode(chosen).alias("one"))
    places = named.select("row", "one.template", F.explode(F.filter("hits", lambda hit: F.array_contains(F.col("one.anchors"), hit["word"]))).alias("hit"))
    # Postings are a literal: every place of a word in a template.
    postings = F.array(*[F.filter(
        F.array(*[F.struct(F.lit(word).alias("word"), F.lit(place).cast("bigint").alias("place")) for place, word in own]),
        lambda p: p["word"] == F.col("hit.word")) for own in index.places])
    votes = places.select("row", "template", "hit.word", "hit.at", F.explode(F.get(postings, F.col("template"))).alias("p"))
    return votes.select("row", "template", "word", (F.col("at") - F.col("p.place")).alias("start")).distinct().groupBy("row", "template", "start").agg(
        F.count("*").alias("agree")).where(F.col("agree") >= AGREE).drop("agree")


def verified(scanned: DataFrame, index: Index, weight: dict[str, int], least: float = LEAST_SCORE) -> DataFrame:
    """row, found (labels, sorted) and best (score) of the files with a template whose key phrases they have."""
    def of_template(values: list) -> Column:
        return F.get(F.array(*values), F.col("template"))

    keys = of_template([F.array(*[F.lit(k) for k in own]) for own in index.keys])
    met = stored(candidates(scanned, index, weight).join(scanned.select("row", "phrases"), "row").where(
        F.size(F.array_except(keys, "phrases")) == 0).select("row", "template", "start"), "license-candidates")
    # Every place of a candidate's template meets the word that the file has there.
    table = of_template([F.array(*[
        F.struct(F.lit(place).cast("bigint").alias("place"), F.lit(word).alias("word"), F.lit(weight[word]).cast("bigint").alias("weight")) for place, word in own])
        for own in index.places])
    wanted = met.select("*", F.explode(table).alias("p")).select("row", "template", "start", (F.col("start") + F.col("p.place")).alias("at"), "p.word", "p.weight")
    hits = scanned.join(met.select("row").distinct(), "row", "left_semi").select("row", F.explode("hits").alias("hit")).select("row", "hit.at", "hit.word")
    total = of_template([F.lit(sum(weight[word] for _, word in own)) for own in index.places])
    scored = wanted.join(hits, ["row", "at", "word"]).groupBy("row", "template", "start").agg(F.sum("weight").alias("weight")).select(
        "row", of_template([F.lit(name) for name in index.labels]).alias("label"), (F.col("weight") / total).alias("score"))
    return scored.where(F.col("score") >= least).groupBy("row").agg(F.array_sort(F.collect_set("label")).alias("found"), F.max("score").alias("best"))


def find_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row of docs (doc_id, text).

    A null text is empty: no words, no labels, score 0. Repeated rows are read each for itself, a null doc_id is kept, other
    columns are ignored and an empty table gives no rows. n_base counts all places of the exact phrases, overlapping ones
    too. The score is 1 where an exact phrase stands, else that of the best verified template, else 0.
    """
    index = Index()
    scanned = scan(docs, index)
    more = verified(scanned, index, weights(scanned, index))
    at = [F.col("base")[n] for n in range(len(BASE))]
    none = F.lit(None).cast("bigint")
    names = F.array_sort(F.array_compact(F.array(*[F.when(place.isNotNull(), label) for place, (_, label) in zip(at, BASE)])))
    n_base = _sum([F.coalesce(place["n"], F.lit(0).cast("bigint")) for place in at])
    return scanned.select(
        "row", "doc_id", "n_words", n_base.alias("n_base"), F.least(*[p["first"] for p in at], none).alias("first_word"),
        F.greatest(*[p["last"] for p in at], none).alias("last_word"), names.alias("names")).join(more, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("names", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("names", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))

"""License scans by an exact set-similarity join.

Text blocks are windows of consecutive words, across line breaks; a template's
windows are as long as its words over ``threshold``, so a statement may be
wrapped, or have a word changed, left out or put in.  A block meets a template
when at least ``threshold`` of the template's distinct tokens are in it, among
them its marks: the tokens that tell it from another template so alike that
one statement could meet both.

Tokens are ordered by how often the corpus holds them, rarest first.  A
template of n tokens that needs k of them keeps a prefix of its n - k + 1
rarest: the rarest token that it shares with a block is one of these (prefix
filter).  A text without the least number of distinct tokens is left out
(length filter), and the words around a prefix token must hold k tokens of the
template from this one on, in the order (positional filter).  What is left is
compared window by window, so the result is exact.

Only tokens of the templates matter, so texts are cut down to these, with
their places, before anything is exploded; a probe carries the tokens within a
window's reach, whatever the text's length.  No text is shuffled.

The base phrases are looked for in the whole text, word for word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finseries.llm.common import NON_WORD, ascii_lower, let, save, word_array

#: Base phrases and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: License statements and their labels.
TEMPLATES = [
    ("all rights reserved", "all-rights-reserved"),
    ("licensed under the apache license version 2.0", "apache-2"),
    ("licensed under cc by nc 4.0", "cc-by-nc"),
    ("licensed under cc by sa 4.0", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("released under the bsd 3 clause license", "bsd-3"),
    ("released under the mit license", "mit"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2.0 you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 2 of the license", "gpl-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 3 of the license", "gpl-3"),
]
#: Share of a template's distinct tokens that a block must hold (documented parameter).
THRESHOLD = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    tokens: tuple[str, ...]  # distinct
    need: int  # tokens that a block must hold
    span: int  # words of a block
    marks: tuple[str, ...]  # tokens that it must hold


def tokens_of(text: str) -> list[str]:
    """Distinct ASCII tokens of a template, in order."""
    return list(dict.fromkeys("".join(c if c.isalnum() else " " for c in text.lower()).split()))


def needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def _normal(text: Column) -> Column:
    """Lower-cased words, one space between, before and after."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD, " ")), F.lit(" "))


def prepared(templates: list[tuple[str, str]], threshold: float) -> list[Template]:
    """Templates with what a block needs.  Templates of one label are not told apart."""
    sets = [(label, tokens_of(text), len("".join(c if c.isalnum() else " " for c in text).split())) for text, label in templates]
    out = []
    for label, own, words in sets:
        need = needed(len(own), threshold)
        marks = {t for other, theirs, _ in sets if other != label and len(set(own) & set(theirs)) >= need for t in set(own) - set(theirs)}
        out.append(Template(label, tuple(own), need, math.ceil(words / threshold - 1e-9), tuple(sorted(marks))))
    return out


def _token(x: Column) -> Column:
    return x["t"]


def set_matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct (doc_id, thash, label, containment) of all texts with a block that meets a template; the largest containment.

    Null and empty texts meet none; repeated rows give one row; only doc_id and text are read.
    """
    spark = docs.sparkSession
    wanted = prepared(templates, threshold)
    vocabulary = sorted({t for x in wanted for t in x.tokens})
    placed = F.transform(word_array(F.col("text")), lambda w, i: F.struct(i.alias("at"), w.alias("t")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("thash"), F.filter(placed, lambda x: x["t"].isin(vocabulary)).alias("hits"))
    least = min(x.need for x in wanted)
    rows = save(rows.where(F.size(F.array_distinct(F.transform("hits", _token))) >= least), "license_tokens")
    counts = {t: n for t, n in rows.select(F.explode(F.transform("hits", _token)).alias("t")).groupBy("t").count().collect()}  # the templates' tokens: bounded
    order = {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (counts.get(t, 0), t)))}
    prefixes = []
    for no, x in enumerate(wanted):
        ranked = sorted(x.tokens, key=order.__getitem__)
        prefixes += [(t, no, x.label, len(ranked), x.need, x.span, list(x.marks), ranked, ranked[i:]) for i, t in enumerate(ranked[:len(ranked) - x.need + 1])]
    table = F.broadcast(spark.createDataFrame(  # bounded by the templates
        prefixes, "t string, template int, label string, n int, k int, span int, marks array<string>, whole array<string>, later array<string>"))
    reach = max(x.span for x in wanted)
    rare = sorted({r[0] for r in prefixes})
    spots = F.filter(F.transform("hits", lambda x, i: F.struct(x["at"].alias("at"), x["t"].alias("t"), i.alias("i"))), lambda x: x["t"].isin(rare))
    spots = F.transform(spots, lambda x: F.struct(x["at"].alias("at"), x["t"].alias("t"), F.slice(
        "hits", F.greatest(x["i"] + 1 - reach, F.lit(1)), F.lit(2 * reach + 1)).alias("near")))
    probes = rows.select("doc_id", "thash", F.explode(spots).alias("s")).select("doc_id", "thash", "s.*")
    own = F.filter("near", lambda x: (x["at"] > F.col("at") - F.col("span")) & (x["at"] < F.col("at") + F.col("span")) & F.array_contains("whole", x["t"]))
    met = probes.join(table, "t").withColumn("own", own).where(F.size(F.array_intersect(F.transform("own", _token), F.col("later"))) >= F.col("k"))

    def held(x: Column) -> Column:
        """Tokens in the block that starts at ``x``; none without the marks."""
        block = F.filter("own", lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + F.col("span")))
        return let(F.array_distinct(F.transform(block, _token)), lambda ts: F.when(F.size(F.array_except("marks", ts)) == 0, F.size(ts)).otherwise(0))
    best = met.select("doc_id", "thash", "label", "n", "k", F.array_max(F.transform("own", held)).alias("common")).where("common >= k")
    return best.groupBy("doc_id", "thash", "label").agg(F.max(F.col("common") / F.col("n")).alias("containment"))


def places(normal: Column, phrase: str) -> Column:
    """Word numbers (from 0) at which the phrase starts; null where it does not occur."""
    words = phrase.split(" ")
    n = len(words)

    def found(w: Column) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
        return F.filter(starts, lambda i: F.slice(w, i + 1, F.lit(n)) == F.array(*map(F.lit, words)))
    return F.when(F.contains(normal, F.lit(f" {phrase} ")), F.flatten(F.transform(F.array(F.split(F.trim(normal), " ")), found)))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, places (word, label), base_labels, labels, score.

    ``labels`` are the base phrases' and the templates' distinct labels,
    sorted; ``score`` is the largest containment (1 where a base phrase
    stands, 0 without any label).  Null and empty texts have no words.
    Repeated rows each get their result; only doc_id and text are read.
    """
    found = set_matches(docs.select("doc_id", "text"), templates, threshold).groupBy("doc_id", "thash").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("thash").alias("_th"), "more", "best")
    rows = docs.select("doc_id", F.xxhash64("text").alias("thash"), _normal(F.col("text")).alias("normal"))
    kind = "array<struct<word:int,label:string>>"

    def placed(phrase: str, label: str) -> Column:
        return F.coalesce(F.transform(places(F.col("normal"), phrase), lambda i: F.struct(i.alias("word"), F.lit(label).alias("label"))).cast(kind), F.array().cast(kind))

    spaces = F.length("normal") - F.length(F.replace("normal", F.lit(" "), F.lit("")))
    base = rows.select("doc_id", "thash", F.when(F.trim("normal") == "", 0).otherwise(spaces - 1).cast("long").alias("n_words"),
                       F.concat(*(placed(p, x) for p, x in PHRASES)).alias("places"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("thash") == F.col("_th")), "left")
    own = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.coalesce("more", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", "places", own.alias("base_labels"), F.array_sort(F.array_union(own, more)).alias("labels"),
                      F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))

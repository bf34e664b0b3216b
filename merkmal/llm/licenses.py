"""Licence scans by a positional index of rare template words."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from merkmal.llm.common import alnum_words, ascii_lower, read_table

# Phrases that count as base places, and their labels.
BASE_PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Fixed values: (label, words of the template, mandatory key phrases inside it).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license", ["apache license"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", ["general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ["lesser general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["public domain"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
]

ANCHORS = 4


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[int, tuple[str, ...]], ...]


def _templates(raw) -> list[Template]:
    out = []
    for label, text, keys in raw:
        words = tuple(text.split())
        placed = []
        for key in keys:
            k = tuple(key.split())
            placed.append((next(i for i in range(len(words)) if words[i : i + len(k)] == k), k))
        out.append(Template(label, words, tuple(placed)))
    return out


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents per licence word over all rows, and their number under ``""``.

    Lines are bounded by the vocabulary; counts combine before the shuffle.
    """
    marks = F.explode(F.concat(F.array_intersect("words", _strings(vocabulary)), F.array(F.lit(""))))
    return {r["word"]: r["n"] for r in words.select(marks.alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _phrase_at(words: Column, start: Column, phrase: tuple[str, ...]) -> Column:
    """True where ``phrase`` stands at word ``start`` (from 0)."""
    hit = (start >= 0) & (start + len(phrase) <= F.size(words))
    for i, w in enumerate(phrase):
        hit = hit & (F.get(words, (start + i).cast("int")) == w)
    return F.coalesce(hit, F.lit(False))


def _base_places(words: Column, phrase: tuple[str, ...]) -> Column:
    """Every start of ``phrase``: places of its last word, moved back and verified."""
    ends = F.transform(words, lambda w, i: F.when(w == phrase[-1], i))
    ends = F.filter(ends, lambda i: i.isNotNull())
    starts = F.transform(ends, lambda i: i - (len(phrase) - 1))
    return F.filter(starts, lambda s: _phrase_at(words, s, phrase))


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE_PHRASES, anchors: int = ANCHORS) -> DataFrame:
    """doc_id, base places, labels, score and matched templates of every row.

    Inverse document frequencies of the template words come from all rows. The
    index holds, per template, its ``anchors`` rarest words with their places.
    Every indexed word of a file is looked up, so any number of templates can
    stand in one file; a posting votes for the start ``place in file - place in
    template``. A start with votes of two indexed words (one, if the template has
    only one) is verified: all mandatory phrases must stand at their places.
    Votes of a start are read at its places, so work grows with the votes, not
    with their square. score is the share of the
    template's words in place at the best verified start; a base place alone
    scores at least 0.5. No shuffle besides the word counts.

    A null or empty text has no words, no labels and score 0.
    """
    parsed = _templates(templates)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    listed = rows.select("doc_id", "text", alnum_words(F.col("text")).alias("words"))
    vocabulary = sorted({w for t in parsed for w in t.words})
    counts = document_frequencies(listed, vocabulary)
    total = counts.get("", 0)
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}

    postings: dict[str, list[tuple[int, int]]] = {}
    needed: list[int] = []
    anchored: list[list[tuple[str, int]]] = []
    for number, t in enumerate(parsed):
        chosen = sorted(set(t.words), key=lambda w: (-idf[w], w))[:anchors]
        needed.append(min(2, len(chosen)))
        anchored.append([(w, place) for place, w in enumerate(t.words) if w in chosen])
        for place, w in enumerate(t.words):
            if w in chosen:
                postings.setdefault(w, []).append((number, place))

    indexed = sorted(postings)
    index = F.create_map(*[x for w in indexed for x in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in postings[w]]))])

    words = F.col("words")
    empty_votes = F.array().cast("array<struct<t:int,s:int>>")
    looked = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(indexed), F.struct(w.alias("w"), i.alias("i")))),
        lambda h: h.isNotNull(),
    )
    votes = F.flatten(F.transform(F.col("looked"), lambda h: F.transform(
        index[h["w"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("s")))))

    def verified(number: int, t: Template) -> Column:
        """Starts of one template that have votes enough and hold its phrases."""
        own = F.filter("votes", lambda v: v["t"] == number)
        starts = F.array_distinct(F.transform(own, lambda v: v["s"]))

        def holds(s):
            same = [F.when(F.get(words, (s + p).cast("int")) == w, 1).otherwise(0) for w, p in anchored[number]]
            hit = sum(same[1:], same[0]) >= needed[number]
            for place, phrase in t.phrases:
                hit = hit & _phrase_at(words, s + place, phrase)
            return hit

        def share(s):
            same = [F.when(F.get(words, (s + i).cast("int")) == w, 1).otherwise(0) for i, w in enumerate(t.words)]
            return sum(same[1:], same[0]) / F.lit(len(t.words))

        return F.array_max(F.transform(F.filter(starts, holds), share))

    cue = ascii_lower(F.col("text")).contains("license")
    no_places = F.array().cast("array<int>")
    base_starts = {
        phrase: F.when(cue, _base_places(words, tuple(phrase.split()))).otherwise(no_places) for phrase, _ in base
    }
    found = (
        listed.withColumn("looked", looked)
        .withColumn("votes", F.when(F.size("looked") > 0, votes).otherwise(empty_votes))
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.array(*[base_starts[p].alias(p) for p, _ in base]).alias("places"),
            F.array(*[F.when(F.size("votes") > 0, verified(n, t)) for n, t in enumerate(parsed)]).alias("shares"),
        )
    )
    places = F.flatten("places")
    base_labels = F.array_sort(F.array_distinct(F.filter(
        F.array(*[F.when(F.size(F.get("places", F.lit(i))) > 0, label) for i, (_, label) in enumerate(base)]), lambda x: x.isNotNull())))
    own_labels = F.filter(
        F.array(*[F.when(F.get("shares", F.lit(i)).isNotNull(), t.label) for i, t in enumerate(parsed)]), lambda x: x.isNotNull())
    best = F.coalesce(F.array_max("shares"), F.lit(0.0))
    return found.select(
        "doc_id", "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own_labels))), ",").alias("labels"),
        F.when(F.size(places) > 0, F.greatest(best, F.lit(0.5))).otherwise(best).cast("double").alias("score"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence scan of every document."""
    return scan(read_table(spark, sf_dir, "documents"))

"""License notices: phrases counted in every text, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import ascii_lower, row_key, text_or_empty, whole_rows, written

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINMENT = 0.8

#: Known words of a text that are looked at in one row.
SEGMENT = 2048

#: Phrase -> label.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Label of a family of licenses -> sentences of its notices, in words. A label stands for a family where
#: notices of its members differ by fewer words than the threshold lets pass.
TEMPLATES: Mapping[str, Sequence[str]] = {
    "apache-2.0": ["licensed under the apache license version 2 0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsl-1.0": ["distributed under the boost software license version 1 0"],
    "cc0-1.0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "creative-commons": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "epl-2.0": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

#: Label -> words of which a block must have one, if its template has any. Without them little in these short
#: templates is distinctive.
DISTINCTIVE: Mapping[str, Sequence[str]] = {"bsl-1.0": ["boost"], "creative-commons": ["cc", "creative"]}


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), NOT_WORD, -1), lambda word: word != "")


def needed(size: int, containment: float) -> int:
    """The least number of a template's words that a block must have."""
    return math.ceil(containment * size - 1e-9)


def phrase_places(words: str, phrase: str) -> Column:
    """Starts of the phrase in the column words. Only texts with the phrase's longest word are looked through."""
    parts = phrase.split()
    at = F.transform(words, lambda word, i: F.when((word == parts[0]) & _all([F.get(words, i + k) == part for k, part in enumerate(parts) if k]), i))
    return F.when(F.array_contains(words, max(parts, key=len)), F.filter(at, lambda i: i.isNotNull())).otherwise(F.array().cast("array<int>"))


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def _literal(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(word) for word in words])


def span_of(size: int) -> int:
    """The words of a block for a template of size words: half as many again."""
    return size + size // 2


def _segments(known: str, reach: int) -> Column:
    """The array of known words in pieces of SEGMENT, each with reach words more on both sides; own is where the piece begins."""
    first = lambda s: F.greatest(s * SEGMENT - reach, F.lit(0))
    piece = lambda s: F.slice(known, first(s) + 1, s * SEGMENT - first(s) + SEGMENT + reach)
    last = F.floor((F.size(known) - 1) / SEGMENT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda s: F.struct((s * SEGMENT - first(s)).alias("own"), piece(s).alias("near")))


def _words(places: Column) -> Column:
    return F.array_distinct(F.transform(places, lambda place: place["word"]))


def anchors(rows: DataFrame, vocabulary: Sequence[str], least_with: Mapping[str, int], reach: int) -> DataFrame:
    """row, word, at, region: the places of the words of least_with that have enough known words around them.

    region holds the words of the vocabulary, with their places, less than reach words before or after; enough are
    least_with[word] different ones. A text is read across line ends. Only what passes is kept of a text, and of a
    text with very many known words a segment at a time.
    """
    whole = rows.select("row", words_of(text_or_empty()).alias("words")).where(F.arrays_overlap("words", _literal(sorted(least_with))))
    known = F.filter(F.transform("words", lambda word, i: F.struct(word.alias("word"), i.alias("at"))), lambda place: place["word"].isin(list(vocabulary)))
    pieces = whole.select("row", known.alias("known")).select("row", F.explode_outer(_segments("known", reach)).alias("piece")).select("row", "piece.*")
    by_least = {n: [word for word, least in least_with.items() if least == n] for n in sorted(set(least_with.values()))}

    def least_of(word: Column) -> Column:
        return F.coalesce(*[F.when(word.isin(words), F.lit(n)) for n, words in by_least.items()])

    def region(place: Column, k: Column) -> Column:
        beside = F.slice("near", F.greatest(k - reach, F.lit(0)) + 1, 2 * reach + 1)
        return F.filter(beside, lambda other: F.abs(other["at"] - place["at"]) < reach)

    def held(place: Column, k: Column) -> Column:
        own = place["word"].isin(list(least_with)) & (k >= F.col("own")) & (k < F.col("own") + SEGMENT)
        enough = F.size(_words(region(place, k))) >= least_of(place["word"])
        return F.when(own & enough, F.struct(place["word"].alias("word"), place["at"].alias("at"), region(place, k).alias("region")))

    found = F.filter(F.transform("near", held), lambda anchor: anchor.isNotNull())
    # An outer explode, as before an inner one Spark adds a filter on the size, which computes the array twice.
    return pieces.select("row", F.explode_outer(found).alias("anchor")).where(F.col("anchor").isNotNull()).select("row", "anchor.*")


def matched_templates(rows: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """row, found (labels), best (the greatest containment) of the rows (row, doc) with a block that meets a template.

    A block is a run of span_of(words of the template) words of a text; containment is the share of a template's different
    words that the block has. Words are ordered by the number of texts of the whole table that have them, rarest first. A
    block that meets a template has one of the first words of it in this order (the prefix), so only the surroundings of
    these are looked at: they must hold enough known words (length), then enough of the template's within a block's reach
    (position). Then every block around the prefix word that begins with a word of the template is counted; one that meets
    it has the same words of it from the first of them on. The work follows the number of prefix words, times a bound that
    the templates set. The templates are a fixed list; what is broadcast has a row for each of their words at most.
    """
    sentences = [(label, sentence.split()) for label in templates for sentence in templates[label]]
    vocabulary = sorted({word for _, words in sentences for word in words})
    seen = rows.select(F.explode_outer(F.array_intersect(_literal(vocabulary), words_of(text_or_empty()))).alias("word")).where("word IS NOT NULL").groupBy("word").count()
    frequency = {row["word"]: row["count"] for row in seen.collect()}
    prefixes = []
    least_with: dict[str, int] = {}
    for label, sentence in sentences:
        words = sorted(set(sentence), key=lambda word: (frequency.get(word, 0), word))
        least = needed(len(words), containment)
        telling = [word for word in words if word in DISTINCTIVE.get(label, words)]
        for word in words[: len(words) - least + 1]:
            least_with[word] = min(least, least_with.get(word, least))
            prefixes.append(F.struct(F.lit(word).alias("word"), F.lit(label).alias("label"), F.lit(len(words)).alias("size"), F.lit(least).alias("least"), F.lit(span_of(len(sentence))).alias("span"), _literal(words).alias("words"), _literal(telling).alias("telling")))
    table = rows.sparkSession.range(1).select(F.explode(F.array(*prefixes)).alias("prefix")).select("prefix.*")
    reach = max(span_of(len(sentence)) for _, sentence in sentences)

    met = anchors(rows, vocabulary, least_with, reach).join(F.broadcast(table), "word")
    close = F.filter("region", lambda place: (F.abs(place["at"] - F.col("at")) < F.col("span")) & F.array_contains("words", place["word"]))
    met = met.select("row", "label", "size", "least", "span", "telling", "at", close.alias("close")).where(F.size(_words(F.col("close"))) >= F.col("least"))

    def common(first: Column) -> Column:
        block = F.filter("close", lambda place: (place["at"] >= first["at"]) & (place["at"] < first["at"] + F.col("span")))
        return F.when(F.arrays_overlap(_words(block), "telling"), F.size(_words(block))).otherwise(0)

    best = F.array_max(F.transform(F.filter("close", lambda place: place["at"] <= F.col("at")), common))
    met = met.select("row", "label", "size", "least", best.alias("common")).where(F.col("common") >= F.col("least"))
    return met.groupBy("row").agg(F.collect_set("label").alias("found"), F.max(F.col("common") / F.col("size")).alias("best"))


def scan_licenses(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs (doc_id, text).

    Words are runs of digits, letters a-z after lower-casing A-Z, and code points beyond ASCII; a null text has none.
    n_base counts the places where a phrase of PHRASES stands, first_word and last_word are their least and greatest
    start. labels adds those of the templates met (matched_templates). Both are distinct, sorted, joined by commas, or
    empty. score is 1 with a base label, else the greatest containment of a template met, else 0. Repeated rows are
    scanned one by one; an empty table gives an empty table; other columns are left out.
    """
    rows = whole_rows(docs).select("doc", row_key(F.col("doc.doc_id"), F.col("doc.text")).alias("row"))
    found = written(matched_templates(rows, templates, containment))
    read = rows.select("row", F.col("doc.doc_id").alias("doc_id"), words_of(text_or_empty()).alias("words"))
    places = read.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), *[phrase_places("words", phrase).alias(label) for phrase, label in PHRASES.items()])
    every = F.concat(*[F.col(f"`{label}`") for label in PHRASES.values()])
    has = F.filter(F.array(*[F.when(F.size(F.col(f"`{label}`")) > 0, F.lit(label)) for label in PHRASES.values()]), lambda label: label.isNotNull())
    base = places.select("row", "doc_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_sort(has).alias("base"))
    joined = base.join(found, "row", "left")
    both = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), score.alias("score"))

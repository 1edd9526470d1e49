"""Operator 12: license scan by diagonal voting, in DataFrame functions only.

Words are lower-cased runs of letters, digits and all characters beyond ASCII. The hashes of all
rolling k-grams of every text are joined to the places of the same grams in the templates, a
fixed table of a few hundred rows; each meeting of equal grams votes for its offset diagonal,
the document's word less the template's. A vote is the template place as one bit of a mask, so
votes of a diagonal are one bit_or, and repeated votes count once. Neighbouring diagonals, a few
words apart, are one span with words put in or left out; its verified coverage is the share of
the template's words that its grams hold. Phrases are found whole and on one diagonal.

Grams are compared word by word after the join on their hash, so a collision casts no vote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Words of a gram of a phrase and of a notice, words that neighbouring diagonals are apart, and the
# share of a notice's words that a span must hold.
PHRASE, NOTICE, DRIFT, COVERAGE = 2, 4, 3, 0.6

# Phrases with their labels, as the contract has them.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Notices of usual licenses, of 5 to 60 words.
NOTICES = (
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "licensed under the bsd license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOCUMENT = ["doc_id", "digest", "second_digest", "n_words"]


@dataclass(frozen=True)
class Template:
    """A text to look for; a phrase is found whole on one diagonal."""

    label: str
    text: str
    base: bool

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def k(self) -> int:
        return PHRASE if self.base else NOTICE

    def places(self) -> list[tuple[int, list[str]]]:
        return [(at, self.words[at : at + self.k]) for at in range(len(self.words) - self.k + 1)]


TEMPLATES = [Template(*x, True) for x in PHRASES] + [Template(*x, False) for x in NOTICES]


def template_grams(spark: SparkSession, templates: list[Template] = TEMPLATES) -> DataFrame:
    """A row for each place of a template: the hash of its gram, the gram, and the template's facts.

    A template has at least as many words as its grams, and at most 60, the bits of a mask.
    """
    if any(not t.k <= len(t.words) <= 60 for t in templates):
        raise ValueError("a template has as many words as its grams at least, and 60 at most")
    rows = [
        (i, t.label, t.base, len(t.words), at, " ".join(words))
        for i, t in enumerate(templates)
        for at, words in t.places()
    ]
    frame = spark.createDataFrame(rows, "template int, label string, base boolean, size int, at int, gram string")
    return frame.withColumn("hash", F.xxhash64("gram"))


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _BLANKS), "")


def rolling_grams(docs: DataFrame) -> DataFrame:
    """A row for each word of each text and gram length: `word` and the gram that begins there, null if the text ends before.

    One more row of each text has a null `word`: it stands for the text itself.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(
        "doc_id",
        F.xxhash64(text).alias("digest"),
        F.xxhash64(F.lit("second"), text).alias("second_digest"),
        words_of(text).alias("words"),
    ).withColumn("n_words", F.size("words").cast("long"))
    ended = F.array_append("words", F.lit(None).cast("string"))
    shifted = [F.slice(ended, i + 1, (F.col("n_words") + 1).cast("int")).alias(f"w{i}") for i in range(NOTICE)]
    rows = words.select(*_DOCUMENT, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w"))
    grams = [
        F.when(F.col(f"w.w{k - 1}").isNotNull(), F.concat_ws(" ", *[f"w.w{i}" for i in range(k)]))
        for k in (PHRASE, NOTICE)
    ]
    inside = F.col("w.w0").isNotNull()
    return rows.select(
        *_DOCUMENT,
        F.when(inside, F.col("at")).alias("word"),
        F.explode(F.when(inside, F.array(*grams)).otherwise(F.array(F.lit(None).cast("string")))).alias("gram"),
    )


def spans(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Spans of templates in texts: a text's key, `template`, `label`, `base`, `size`, `start`, `coverage`, `rows`.

    One row of each text has a null template, and in `rows` how many rows the text's key has; equal rows
    have one key. The table of template places is of fixed size, so it is broadcast.
    """
    places = F.broadcast(template_grams(docs.sparkSession, templates).withColumnRenamed("gram", "template_gram"))
    met = rolling_grams(docs).withColumn("hash", F.xxhash64("gram")).join(places, "hash", "left")
    votes = met.filter((F.col("template_gram") == F.col("gram")) | F.col("word").isNull())
    facts = ["template", "label", "base", "size"]
    diagonals = (
        votes.withColumn("diagonal", F.col("word") - F.col("at"))
        .groupBy(*_DOCUMENT, *facts, "diagonal")
        .agg(
            F.bit_or(F.expr("shiftleft(1L, at)")).alias("votes"),
            F.min("word").alias("start"),
            F.count_if(F.col("word").isNull()).alias("rows"),
        )
    )
    along = W.partitionBy(*_DOCUMENT, "template").orderBy("diagonal")
    drift = F.when(F.col("base"), 0).otherwise(DRIFT)
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > drift, F.lit(True))
    merged = (
        diagonals.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(along))
        .groupBy(*_DOCUMENT, *facts, "span")
        .agg(F.bit_or("votes").alias("votes"), F.min("start").alias("start"), F.max("rows").alias("rows"))
    )

    def held(k: int) -> str:
        return f"bit_count({' | '.join(f'shiftleft(votes, {i})' for i in range(k))})"

    share = F.expr(f"CASE WHEN base THEN {held(PHRASE)} ELSE {held(NOTICE)} END / CAST(size AS DOUBLE)")
    return merged.withColumn("coverage", share)


def license_scan(docs: DataFrame, templates: list[Template] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """Licenses of every text: `doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    docs: `doc_id`, `text`; other columns are ignored. Base templates are phrases found whole: n_base
    counts all their places, first_word and last_word are the smallest and largest start. `labels`
    adds those of the other templates of which one span holds `coverage` of the words at least. Both
    lists are distinct, sorted and joined by commas. `score` is the best coverage of any template that
    counts so, 0 where none does. Null, empty and wordless texts have no words, empty lists, null
    places and score 0. Null ids and repeated rows give a row each; an empty table gives none. Texts
    are taken whole; a long one's rows are spread as any others.
    """
    keys = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = spans(keys, templates)
    base = F.col("base") & (F.col("coverage") == 1)
    counts = F.col("template").isNotNull() & F.when(F.col("base"), F.col("coverage") == 1).otherwise(F.col("coverage") >= coverage)
    listed = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    texts = found.groupBy(*_DOCUMENT).agg(
        F.max("rows").alias("rows"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(counts).alias("labels"),
        F.coalesce(F.max(F.when(counts, F.col("coverage"))), F.lit(0.0)).alias("score"),
    )
    every = texts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return every.drop("rows", "copy", "digest", "second_digest")

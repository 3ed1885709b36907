"""License scans by a positional index of each template's rarest words, in DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE = 3  # positions of a template that are looked up, those of its rarest words
STEP = 1 << 40  # codes of places: template * STEP + first word + MARGIN
MARGIN = 1 << 10


@dataclass(frozen=True)
class Template:
    """A passage of a licence; ``phrases`` must stand in their places, of its other words some may differ."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(str.maketrans(UPPER, LOWER)))

    @property
    def mandatory(self) -> list[int]:
        """Places of the words of all phrases."""
        words, places = self.words, set()
        for phrase in self.phrases:
            sought = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(sought)] == sought]
            if not at:
                raise ValueError(f"{self.label}: no {phrase!r} in the template")
            places |= {at[0] + k for k in range(len(sought))}
        return sorted(places)

    @property
    def looked_up(self) -> int:
        return 1 if self.base else min(RARE, len(self.words))

    @property
    def agreeing(self) -> int:
        """How many of the words that are looked up have to stand in one alignment: two thirds."""
        return -(-2 * self.looked_up // 3)


# Passages of public licences and notices, and what of them may not differ.
TEMPLATES = (
    Template("cc-by", "cc by", ("cc by",), base=True),
    Template("gpl", "general public license", ("general public license",), base=True),
    Template("reserved", "all rights reserved", ("all rights reserved",), base=True),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("use this file except in compliance with the license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-sa", "Creative Commons Attribution-ShareAlike", ("creative commons attribution sharealike",)),
    Template("cc0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights", ("waived all copyright and related",)),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl", "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ("redistribute it and or modify it", "gnu general public license")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("mit", "Released under the MIT License", ("the mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def words_of(text: str = "text") -> Column:
    """Words of the whole text, A-Z lower-cased; null text has none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def among(words: set[str], column: Column) -> Column:
    return column.isin(sorted(words)) if words else F.lit(False)


def document_frequencies(worded: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """In how many rows of ``worded`` (words) each licence word stands: a row for each word of the templates."""
    vocabulary = {w for t in templates for w in t.words}
    found = worded.select(F.explode(F.array_distinct(F.filter("words", lambda x: among(vocabulary, x)))).alias("word"))
    return {r.word: r["count"] for r in found.groupBy("word").count().collect()}


def rarest(template: Template, frequency: dict[str, int]) -> list[int]:
    """Places of the template's words of highest inverse document frequency; ties by word and place."""
    words = template.words
    return sorted(range(len(words)), key=lambda i: (frequency.get(words[i], 0), words[i], i))[: template.looked_up]


def numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places) per row of ``docs`` (doc_id, text): where licence passages stand.

    ``places`` is an array of (start, label, base, share): the number of the passage's first word from 0,
    its label, whether it is a base phrase, and the share of its words that stand in their places. A
    licence word of the row is looked up if it is among the RARE words of a template that are rarest in
    all rows, and yields the place where that template would begin. Where two thirds of the words looked
    up agree, every word of the template's mandatory phrases must stand in its place too. Base phrases
    are templates that are mandatory as a whole.

    Two scans, one for document frequencies and one for the places; nothing but the frequencies of the
    templates' words is shuffled or collected. Null text is empty; a place is given once however often
    its words are looked up; rows stay as they are, repeated or with a null id; further columns are
    ignored; an empty table gives no rows.
    """
    worded = docs.select("doc_id", words_of().alias("words"))
    frequency = document_frequencies(worded, templates)
    postings: dict[str, list[int]] = {}
    for t, template in enumerate(templates):
        for place in rarest(template, frequency):
            postings.setdefault(template.words[place], []).append(t * STEP + MARGIN - place)
    pairs = [(F.lit(word), F.array(*[F.lit(code).cast("long") for code in codes])) for word, codes in sorted(postings.items())]
    index = F.create_map(*[x for pair in pairs for x in pair])
    details = F.array(*[
        F.struct(
            F.lit(t.label).alias("label"),
            F.lit(t.base).alias("base"),
            F.array(*[F.lit(w) for w in t.words]).alias("words"),
            numbers(t.mandatory).alias("mandatory"),
            numbers(rarest(t, frequency)).alias("rare"),
            F.lit(t.agreeing).alias("agreeing"),
        )
        for t in templates
    ])

    at_word = F.filter(F.transform("words", lambda x, i: F.struct(x.alias("word"), i.alias("at"))), lambda p: among(set(postings), p["word"]))
    hits = worded.select("doc_id", "words", at_word.alias("hits"))
    codes = F.flatten(F.transform("hits", lambda p: F.transform(index[p["word"]], lambda code: code + p["at"])))
    coded = hits.select("doc_id", "words", F.when(F.size("hits") > 0, F.array_distinct(codes)).otherwise(F.array().cast("array<bigint>")).alias("codes"))

    def place(code: Column) -> Column:
        start = (code % F.lit(STEP) - MARGIN).cast("int")
        return F.struct(start.alias("start"), F.get(details, F.floor(code / F.lit(STEP)).cast("int")).alias("of"))

    def stands(p: Column, i: Column) -> Column:
        return F.coalesce(F.get("words", p["start"] + i) == F.get(p["of"]["words"], i), F.lit(False))

    def agrees(p: Column) -> Column:
        rare = F.size(F.filter(p["of"]["rare"], lambda i: stands(p, i))) >= p["of"]["agreeing"]
        return rare & F.forall(p["of"]["mandatory"], lambda i: stands(p, i))

    def found(p: Column) -> Column:
        size = F.size(p["of"]["words"])
        matched = F.size(F.filter(F.sequence(F.lit(0), size - 1), lambda i: stands(p, i)))
        return F.struct(p["start"].alias("start"), p["of"]["label"].alias("label"), p["of"]["base"].alias("base"), (matched / size).alias("share"))

    places = F.transform(F.filter(F.transform("codes", place), agrees), found)
    return coded.select("doc_id", F.size("words").cast("long").alias("n_words"), places.alias("places"))


def label_list(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def license_labels(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of ``docs``.

    Base phrases are counted place by place; labels are distinct, sorted and joined by commas, empty
    where there are none; the score is the greatest share of a passage found, 0 without one. See
    ``scan_licenses`` for the rows.
    """
    scanned = scan_licenses(docs, templates).withColumn("bases", F.filter("places", lambda p: p["base"]))
    starts = F.transform("bases", lambda p: p["start"].cast("long"))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("bases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        label_list(F.col("bases")).alias("base_labels"),
        label_list(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )


def license_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The same rows by joining all words with all words of the templates."""
    passages = ", ".join(f"({t}, '{x.label}', {x.base}, {len(x.words)}, {x.looked_up}, {x.agreeing})" for t, x in enumerate(templates))
    words = ", ".join(f"({t}, {i}, '{w}', {i in x.mandatory})" for t, x in enumerate(templates) for i, w in enumerate(x.words))
    return f"""
WITH passage(t, label, base, size, looked_up, agreeing) AS (VALUES {passages}),
part(t, i, x, mandatory) AS (VALUES {words}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM documents
),
word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS p FROM d),
known AS (SELECT * FROM word WHERE x IN (SELECT x FROM part)),
often AS (SELECT x, count(DISTINCT r) AS docs FROM known GROUP BY x),
ranked AS (
  SELECT t, i, x, row_number() OVER (PARTITION BY t ORDER BY coalesce(docs, 0), x, i) AS k FROM part LEFT JOIN often USING (x)
),
rare AS (SELECT t, i, x FROM ranked JOIN passage USING (t) WHERE k <= looked_up),
aligned AS (SELECT r, t, p - i AS s, count(*) AS n FROM known JOIN rare USING (x) GROUP BY r, t, p - i),
likely AS (SELECT r, t, s FROM aligned JOIN passage USING (t) WHERE n >= agreeing),
compared AS (
  SELECT l.r, l.t, l.s, count(k.x) AS same, count(*) FILTER (WHERE q.mandatory AND k.x IS NULL) AS missing
  FROM likely l JOIN part q USING (t) LEFT JOIN known k ON k.r = l.r AND k.p = l.s + q.i AND k.x = q.x
  GROUP BY l.r, l.t, l.s
),
place AS (SELECT r, s, label, base, CAST(same AS DOUBLE) / size AS share FROM compared JOIN passage USING (t) WHERE missing = 0),
doc AS (
  SELECT r, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM place GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN doc USING (r)
"""

"""Operator 1: licence scans with a positional index of rare template words.

Every licence template has a mandatory key phrase.  The phrase's word with the highest IDF in
the corpus at hand is the template's posting: (word, position in the template).  A file looks
its words up in these postings; a hit at word ``i`` with posting position ``p`` puts the
template's start at ``i - p``, where the other words are intersected by relative position and
the key phrase is verified word by word.  All of it works inside the row: after the one
aggregate that counts the licence words nothing is shuffled, however often a word occurs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import spare_name

#: Lower-case words: runs of characters that are neither ASCII punctuation, space, control nor upper case.
LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Share of a template's words that must stand at their relative position.
LEAST_COVERAGE = 0.6


class Template(NamedTuple):
    label: str
    text: str
    key: str
    base: bool = False

    def words(self) -> list[str]:
        return self.text.split()

    def key_at(self) -> int:
        words, key = self.words(), self.key.split()
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


#: The three base phrases, then our own templates: label, words, mandatory phrase.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                    "and associated documentation files", "any person obtaining a copy of this software"),
    Template("apache-2", "you may not use this file except in compliance with the license",
             "use this file except in compliance with the license"),
    Template("gpl-3", "under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-3", "gnu gpl version 3", "gnu gpl version 3"),
    Template("gpl-2", "under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl", "under the terms of the gnu general public license as published by the free software foundation",
             "gnu general public license as published"),
    Template("lgpl", "under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl-3", "under the gnu affero general public license version 3", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    Template("mpl-2", "mozilla public license version 2", "mozilla public license version 2"),
    Template("epl-2", "eclipse public license version 2", "eclipse public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
                    "is hereby granted", "for any purpose with or without fee"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software released into the public domain"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd", "cc by nd"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    Template("cc-by", "creative commons attribution 4 0 international", "creative commons attribution 4 0"),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once in the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Lower-case words.  ``lower`` maps no other letter onto a whole ASCII letter of a base phrase."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LICENCE_WORD), 0)


def strings(values) -> Column:
    return F.array(*map(F.lit, values))


def frequencies(docs: DataFrame, text: str, words: list[str]) -> dict[str, int]:
    """Documents that hold each licence word; as many rows as the templates have words."""
    seen = docs.select(F.explode(F.array_intersect(words_of(F.col(f"`{text}`")), strings(words))).alias("word"))
    return {r["word"]: r["count"] for r in seen.groupBy("word").count().collect()}


def postings(templates, found: dict[str, int]) -> list[tuple[str, int]]:
    """For each template its rarest key word and that word's position in the template."""
    out = []
    for t in templates:
        key = t.key.split()
        rarest = min(range(len(key)), key=lambda i: (found.get(key[i], 0), i))
        out.append((key[rarest], t.key_at() + rarest))
    return out


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, least: float = LEAST_COVERAGE) -> DataFrame:
    """Adds ``n_words`` and ``licences`` to every row.

    ``licences`` lists each verified place: label, start (of the key phrase, in words from 0),
    coverage (share of the template's words at their relative position) and base.  Null and
    empty texts have no words and an empty list; an empty table gives no rows; repeated rows
    are scanned alike; clashing column names get an underscore appended.
    """
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    index = postings(templates, frequencies(docs, text, vocabulary))
    anchors = strings(sorted({w for w, _ in index}))
    table = F.array(*(
        F.struct(F.lit(word).alias("word"), F.lit(at).alias("at"), strings(t.words()).alias("words"),
                 F.lit(t.key_at()).alias("key_at"), strings(t.key.split()).alias("key"),
                 F.lit(t.label).alias("label"), F.lit(t.base).alias("base"))
        for t, (word, at) in zip(templates, index)))

    def look_up(words: Column) -> Column:
        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i"))),
                        lambda h: F.array_contains(anchors, h["word"]))
        starts = F.flatten(F.transform(hits, lambda h: F.transform(
            F.filter(table, lambda p: p["word"] == h["word"]),
            lambda p: F.struct(p.alias("p"), (h["i"] - p["at"]).alias("start")))))
        keyed = F.filter(starts, lambda s: (s["start"] + s["p"]["key_at"] >= 0) & (
            F.slice(words, F.greatest(s["start"] + s["p"]["key_at"], F.lit(0)) + 1, F.size(s["p"]["key"])) == s["p"]["key"]))
        placed = F.transform(keyed, lambda s: F.struct(
            s["p"]["label"].alias("label"), (s["start"] + s["p"]["key_at"]).cast("long").alias("start"),
            (F.size(F.filter(s["p"]["words"], lambda w, j: F.coalesce(
                F.get(words, s["start"] + j) == w, F.lit(False)))) / F.size(s["p"]["words"])).alias("coverage"),
            s["p"]["base"].alias("base")))
        return F.filter(placed, lambda x: x["coverage"] >= least)

    none = F.array().cast("array<struct<label:string,start:bigint,coverage:double,base:boolean>>")
    made = spare_name(docs.columns, "made")
    n_words, licences = (spare_name(docs.columns, c) for c in ("n_words", "licences"))
    out = docs.withColumn(made, let(words_of(F.col(f"`{text}`")), lambda words: F.struct(
        F.size(words).cast("long").alias("n"),
        F.when(F.arrays_overlap(words, anchors), look_up(words)).otherwise(none).alias("found"))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), F.col(made)["n"].alias(n_words), F.col(made)["found"].alias(licences))


def label_list(licences: Column) -> Column:
    """The labels, distinct, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(licences, lambda x: x["label"]))), ",")

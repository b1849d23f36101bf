"""License scans by an exact set-similarity join with license notices.

Two findings, both over whole texts. Base: places where a short phrase's words
stand one after the other. Join: text blocks whose word set holds at least
`CONTAINMENT` of a notice's word set. A notice of L words is sought in blocks of
2 L words that begin every L words, so every run of L words lies whole in one.

The join is exact: words of the notices are ordered by how many documents hold
them, the rarest first; a block that holds t of a notice's n words must share
one of the first n - t + 1 words of the notice in that order, which must be
among all but the last t - 1 of the block's own (prefix filter); blocks that
hold too few notice words are left out (length filter), and so are
pairs whose words after the shared one cannot make up t (positional filter). What
is left is verified. Words in no notice cannot add to an overlap and are dropped
from blocks first. Only DataFrame functions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, let, lower_ascii, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINMENT = 0.9

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Sentences of public license notices and their labels.
NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                 "compliance with the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]


def notice_words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans(UPPER, LOWER))) if w]


@dataclass(frozen=True)
class Notice:
    number: int
    label: str
    length: int  # words, repeats included
    words: frozenset[str]
    needed: int  # words that a block must share


def notices(texts: list[tuple[str, str]], containment: float) -> list[Notice]:
    split = [(label, notice_words(text)) for label, text in texts]
    return [Notice(i, label, len(w), frozenset(w), math.ceil(containment * len(set(w)) - 1e-9))
            for i, (label, w) in enumerate(split) if w]


def words(text: Column) -> Column:
    """The words of a whole text; null counts as empty."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def places(w: Column, phrase: str) -> Column:
    """Where a phrase's words stand one after the other, from 0."""
    parts = phrase.split()
    line = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))

    def stands(i: Column) -> Column:
        here = F.get(w, i) == parts[0]
        for k, word in enumerate(parts[1:], 1):
            here = here & (F.get(w, i + k) == word)
        return here

    found = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - len(parts), F.lit(0))), stands)
    return F.when(F.contains(line, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def word_counts(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """How many documents hold each word of the notices: a row a word comes to
    the driver, however many documents there are."""
    held = docs.select(F.explode(F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, vocabulary)))).alias("w"))
    return {r.w: r.n for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}


def _rows(spark, schema: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(schema, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def matches(docs: DataFrame, texts: list[tuple[str, str]] = NOTICES, containment: float = CONTAINMENT,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each block and notice that it holds: (doc_id, doc_key,
    label, notice, block, first_word, n_shared, share).

    doc_key is a hash of the text; rows that repeat id and text give their
    matches once each; null and empty texts have none. first_word is where the block begins.
    """
    spark = docs.sparkSession
    wanted = notices(texts, containment)
    vocabulary = sorted(set().union(*(n.words for n in wanted)))
    seen = word_counts(docs, vocabulary, text_col)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ordered = {n.number: sorted(rank[w] for w in n.words) for n in wanted}
    by_rank = sorted(vocabulary, key=rank.get)
    firsts = {n.number: ordered[n.number][:len(n.words) - n.needed + 1] for n in wanted}
    rare = F.array(*[F.lit(by_rank[r]) for r in sorted(set().union(*map(set, firsts.values())))])
    least = {}  # by length: words that any notice needs
    for n in wanted:
        least[n.length] = min(least.get(n.length, n.needed), n.needed)

    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    held = docs.select(F.col(id_col).alias("doc_id"), key.alias("doc_key"), words(F.col(text_col)).alias("w"))
    held = stored(held.where(F.arrays_overlap("w", rare)).select("doc_id", "doc_key", "w"), "notice-words")

    index = F.map_from_arrays(F.array(*map(F.lit, by_rank)), F.array(*[F.lit(i) for i in range(len(by_rank))]))
    known = F.array(*map(F.lit, by_rank))

    def blocks_of(w: Column, length: int) -> Column:
        # words of a block one by one: `slice` would copy the whole text's words for each block
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(length)), lambda i: F.struct(
            F.lit(length).alias("length"), i.alias("first_word"), F.array_sort(F.transform(
                F.array_intersect(known, F.array(*[F.get(w, i + k) for k in range(2 * length)])),
                lambda x: F.element_at(index, x))).alias("ranks")))

    def blocks(w: Column) -> Column:
        return F.flatten(F.array(*[blocks_of(w, length) for length in sorted(least)]))

    block = held.select("doc_id", "doc_key", F.explode(blocks(F.col("w"))).alias("b")).select("doc_id", "doc_key", "b.*")
    too_few = F.lit(False)
    for length, needed in least.items():
        too_few = too_few | ((F.col("length") == length) & (F.size("ranks") < needed))
    needed_least = F.coalesce(*[F.when(F.col("length") == k, v) for k, v in least.items()])
    block = block.where(~too_few).select("*", F.posexplode(F.expr("ranks")).alias("at", "word"))
    block = block.where(F.col("at") <= F.size("ranks") - needed_least)
    heads = _rows(spark, ["n_length", "n_word", "n_at", "notice"],
                  [(n.length, r, i, n.number) for n in wanted for i, r in enumerate(firsts[n.number])])
    notes = _rows(spark, ["notice", "label", "n_size", "needed"],
                  [(n.number, n.label, len(n.words), n.needed) for n in wanted])
    notes = notes.join(_rows(spark, ["notice", "n_ranks"], [(k, v) for k, v in ordered.items()]), "notice")
    # both tables hold a few numbers for each notice, whatever the documents
    pairs = (block.join(F.broadcast(heads), (F.col("length") == F.col("n_length")) & (F.col("word") == F.col("n_word")))
             .join(F.broadcast(notes), "notice")
             .where(F.least(F.col("n_size") - F.col("n_at"), F.size("ranks") - F.col("at")) >= F.col("needed")))
    shared = F.size(F.array_intersect("ranks", "n_ranks"))
    return (pairs.withColumn("n_shared", shared).where("n_shared >= needed")
            .select("doc_id", "doc_key", "label", "notice", "first_word", "n_shared",
                    (F.col("n_shared") / F.col("n_size")).alias("share")).distinct())


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, texts: list[tuple[str, str]] = NOTICES,
         containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: (doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score).

    Base findings are the phrases' places; labels adds those of notices that a
    block holds; score is 1 with a base label, else the greatest share of a notice held
    by a block that reaches the threshold, else 0. Null and empty texts have no
    words and no labels; ids may be null or repeated; other columns are ignored.
    """
    def base(w: Column) -> Column:
        each = [F.struct(F.lit(label).alias("label"), places(w, p).alias("at")) for p, label in phrases.items()]
        return let(F.array(*each), lambda f: F.struct(
            F.size(w).cast("long").alias("n_words"), F.flatten(F.transform(f, lambda x: x["at"])).alias("at"),
            F.array_distinct(F.transform(F.filter(f, lambda x: F.size(x["at"]) > 0), lambda x: x["label"])).alias("labels")))

    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    docs_base = docs.select(F.col(id_col).alias("doc_id"), key.alias("doc_key"),
                            let(words(F.col(text_col)), base).alias("b")).select("doc_id", "doc_key", "b.*")
    found = (matches(docs, texts, containment, id_col, text_col).groupBy("doc_id", "doc_key")
             .agg(F.collect_set("label").alias("more"), F.max("share").alias("share")))
    found = stored(found.withColumnsRenamed({"doc_id": "f_id", "doc_key": "f_key"}), "notice-matches")
    joined = docs_base.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("doc_key") == F.col("f_key")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"), F.array_join(F.array_sort("labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("labels", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("labels") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


# -------------------------------------------------------------------- SQL
def oracle() -> str:
    """DuckDB SQL of the registered query: every block against every notice."""
    def quoted(items) -> str:
        return "[" + ", ".join("'" + w + "'" for w in items) + "]"

    phrase_rows = ", ".join(f"('{label}', {quoted(p.split())})" for p, label in PHRASES.items())
    notice_rows = ", ".join(f"('{n.label}', {n.length}, {quoted(sorted(n.words))}, {n.needed})"
                            for n in notices(NOTICES, CONTAINMENT))
    return rf"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
p(label, words) AS (VALUES {phrase_rows}),
n(label, len, words, needed) AS (VALUES {notice_rows}),
spots AS (SELECT k, label, words, unnest(range(len(w) - len(words) + 1)) AS i, w FROM w, p),
base AS (SELECT k, label, i FROM spots WHERE w[i + 1:i + len(words)] = words),
b AS (SELECT k, count(*) AS n, min(i) AS lo, max(i) AS hi FROM base GROUP BY k),
blocks AS (SELECT k, n.label, n.words, n.needed, w, n.len, unnest(range(0, len(w), n.len)) AS i FROM w, n),
shares AS (SELECT k, label, words, needed, len(list_intersect(list_distinct(w[i + 1:i + 2 * len]), words)) AS got FROM blocks),
found AS (SELECT k, label, max(got / len(words)) AS share FROM shares WHERE got >= needed GROUP BY ALL),
every AS (SELECT k, label FROM base UNION SELECT k, label FROM found)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.lo::BIGINT AS first_word, b.hi::BIGINT AS last_word,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM base x WHERE x.k = w.k), '') AS base_labels,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM every x WHERE x.k = w.k), '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce((SELECT max(share) FROM found x WHERE x.k = w.k), 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (k)"""

"""License scans by an exact set-similarity join; DataFrame operations only.

A text is cut into overlapping blocks of consecutive words, so long that any run of words as long as a
template lies within one. A block meets a template if it holds at least `threshold` of the template's
distinct words. Which blocks do is found by a join on words:

* All templates' words are ordered by the number of documents that hold them, rarest first.
* A block is reduced to those words, in that order; no other word can count.
* Prefix filter: a pair with `need` words in common shares one of the first `size - need + 1` of either
  side, so only those words of a template are joined with those of a block.
* Length filter: a block of fewer than `need` such words goes.
* Positional filter: from the words that pair's first match leaves on either side, `need` must be possible.
* What is left is verified by counting.

Only blocks that hold a word of some prefix leave their row; rare words come first, so that few do. Texts
are never shuffled: what is exchanged are digests and labels. The templates are constants, so the table of
their prefixes, which is broadcast, has at most a few hundred rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotidian.llm import columns

THRESHOLD = 0.9
#: Words from one block's start to the next one's; a template takes the first that is no shorter than it is.
SPANS = (16, 64)

#: Words that stand consecutively, and the label of a place where they do.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Fixed texts of public licenses: label, notice in words.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met redistributions of source code must retain the above copyright "
            "notice this list of conditions and the following disclaimer"),
    ("cc-by", "licensed under cc by 4 0 international"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike 4 0 international license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not "
            "limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    span: int

    def need(self, threshold: float) -> int:
        """The words that a block must hold; whole thousandths, so that no rounding moves it."""
        return -(-round(threshold * 1000) * len(self.words) // 1000)


def read_templates(texts=TEMPLATES) -> list[Template]:
    """The texts in words. One longer than all spans gets blocks of its own length."""
    out = []
    for i, (label, text) in enumerate(texts):
        words = text.split()
        span = next((s for s in SPANS if s >= len(words)), len(words))
        out.append(Template(i, label, tuple(dict.fromkeys(words)), span))
    return out


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def _key(docs: DataFrame) -> list[Column]:
    """What tells texts apart; rows equal in it have equal answers."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("digest")]


def word_order(docs: DataFrame, templates: list[Template]) -> list[str]:
    """All words of the templates, by the number of documents that hold them, then by code point."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode_outer(F.array_intersect(_array(vocabulary), columns.terms(F.col("text")))).alias("word"))
    counts = dict(map(tuple, held.where("word IS NOT NULL").groupBy("word").count().collect()))  # one row a word
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def blocks(words: Column, span: int, rare: Column) -> Column:
    """(span, words) of the runs of 2 * span words, one from every span-th word on, that hold a rare one."""
    none = F.array().cast("array<struct<span: int, words: array<string>>>")
    starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(span))
    cut = F.transform(starts, lambda i: F.struct(F.lit(span).alias("span"), F.slice(words, i + 1, 2 * span).alias("words")))
    kept = F.filter(cut, lambda block: F.arrays_overlap(block["words"], rare))
    return F.when(F.arrays_overlap(words, rare), kept).otherwise(none)


def similar(docs: DataFrame, templates: list[Template], threshold: float) -> DataFrame:
    """(doc_id, digest, template, label, containment) of every block that meets a template, repeats possible."""
    order = word_order(docs, templates)
    rank = {w: i for i, w in enumerate(order)}
    rows, rare = [], {}
    for t in templates:
        words, need = sorted(t.words, key=rank.get), t.need(threshold)
        prefix = words[: len(words) - need + 1]
        rare.setdefault(t.span, set()).update(prefix)
        rows += [(w, t.span, t.number, t.label, i, need, words) for i, w in enumerate(prefix)]
    prefixes = docs.sparkSession.createDataFrame(
        rows, "word string, span int, template int, label string, at int, need int, words array<string>")

    terms = F.col("terms")
    cut = F.concat(*[blocks(terms, span, _array(sorted(words))) for span, words in sorted(rare.items())])
    # explode_outer: the inner form would have its argument worked out a second time, for a filter
    reduced = docs.select(*_key(docs), columns.terms(F.col("text")).alias("terms")).select(
        "doc_id", "digest", F.explode_outer(cut).alias("block")).select(
        "doc_id", "digest", "block.span", F.array_intersect(_array(order), F.col("block.words")).alias("held"))
    first = F.filter(
        F.transform("held", lambda w, i: F.struct(w.alias("word"), i.alias("place"))),
        lambda x: F.array_contains(_array(sorted(set().union(*rare.values()))), x["word"]))
    matched = reduced.select("doc_id", "digest", "span", "held", F.explode_outer(first).alias("x")).select(
        "doc_id", "digest", "span", "held", "x.word", "x.place").join(F.broadcast(prefixes), ["word", "span"])
    need, left = F.col("need"), F.size("held") - F.col("place")
    passed = matched.where(
        (F.size("held") >= need)  # length
        & (F.col("place") <= F.size("held") - need)  # prefix of the block
        & (F.least(F.size("words") - F.col("at"), left) >= need))  # position
    common = F.size(F.array_intersect("held", "words"))
    return passed.where(common >= need).select(
        "doc_id", "digest", "template", "label", (common / F.size("words")).alias("containment"))


def places(words: Column, phrase: str) -> Column:
    """Numbers of the words where the phrase begins."""
    parts = phrase.split()

    def begins(i: Column) -> Column:
        same = [F.get(words, i + k) == part for k, part in enumerate(parts)]
        return F.coalesce(F.reduce(F.array(*same), F.lit(True), lambda a, b: a & b), F.lit(False))

    return F.when(
        F.arrays_overlap(words, _array(parts[-1:])),
        F.filter(F.sequence(F.lit(0), F.size(words) - 1), begins)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    base_labels: of the phrases that stand in the text. labels: those and the labels of templates of which
    some block holds `threshold` of the distinct words. score: the largest share held of a template that is
    met, 1 where a phrase stands, 0 where neither. Null and empty texts have no words, no labels and no
    places. Repeated rows have equal answers, each its own; rows without a doc_id stay. An empty table gives
    no rows. Further columns of docs don't matter. Texts may be of any length.
    """
    docs = docs.select("doc_id", "text")
    labels = sorted({label for _, label in phrases})
    rows = docs.select(*_key(docs), columns.terms(F.col("text")).alias("terms")).select(
        "doc_id", "digest", F.size("terms").cast("long").alias("n_words"),
        *[places(F.col("terms"), phrase).alias(f"p{i}") for i, (phrase, _) in enumerate(phrases)])
    every = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    stands = [F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]
    base = rows.select(
        "doc_id", "digest", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_distinct(F.array_sort(F.array_compact(F.array(*stands)))).alias("named"))
    met = similar(docs, read_templates(templates), threshold).groupBy("doc_id", "digest").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("share"))
    met = met.select(F.col("doc_id").alias("met_id"), F.col("digest").alias("met_digest"), "found", "share")
    both = base.join(met, base["doc_id"].eqNullSafe(met["met_id"]) & base["digest"].eqNullSafe(met["met_digest"]), "left")
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("named", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("named", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def _sql(threshold: float = THRESHOLD) -> str:
    """The same by comparing every block with every template."""
    known = read_templates()
    rows = ",\n  ".join(
        f"({t.number}, '{t.label}', {list(t.words)}, {t.need(threshold)}, {t.span})" for t in known)
    found = []
    for phrase, _ in PHRASES:
        same = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        found.append(f"list_filter(range(0, len(words)), lambda i: coalesce({same}, false))")
    names = ", ".join(
        f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (_, label) in enumerate(PHRASES))
    every = " || ".join(f"p{i}" for i in range(len(PHRASES)))
    return f"""
WITH templates(number, label, wanted, need, span) AS (VALUES
  {rows}
), docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {columns.SQL_TERMS % "text"} AS words FROM documents
), placed AS (
  SELECT rid, doc_id, len(words)::BIGINT AS n_words, {", ".join(f"{f} AS p{i}" for i, f in enumerate(found))} FROM docs
), blocks AS (
  SELECT rid, span, words[start + 1 : start + 2 * span] AS block
  FROM (SELECT rid, span, words, unnest(range(0, len(words), span)) AS start
        FROM docs, (SELECT DISTINCT span FROM templates))
), met AS (
  SELECT rid, list_distinct(list(label)) AS found, max(common::DOUBLE / len(wanted)) AS share
  FROM (SELECT rid, label, wanted, need, len(list_intersect(list_distinct(block), wanted)) AS common
        FROM blocks JOIN templates USING (span))
  WHERE common >= need GROUP BY rid
), base AS (
  SELECT rid, doc_id, n_words, {every} AS spots, list_filter([{names}], lambda x: x IS NOT NULL) AS named FROM placed
)
SELECT doc_id, n_words, len(spots)::BIGINT AS n_base, list_min(spots)::BIGINT AS first_word,
       list_max(spots)::BIGINT AS last_word, array_to_string(list_sort(list_distinct(named)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(named || coalesce(found, []))), ',') AS labels,
       CASE WHEN len(spots) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM base LEFT JOIN met USING (rid)
"""


SQL = _sql()

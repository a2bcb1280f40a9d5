"""Licence scans by an exact set-similarity join (operator 5), in DataFrame functions only.

A template is the set of words of a licence notice.  Blocks are the lines of a text, and all runs of
consecutive words, over lines and paragraphs, that are at most RUN times as long as the notice; so a
notice is found however it is wrapped.  A block matches when it holds at least `threshold` of the
template's words.

Every text is split into words once.  A text that holds enough words of no template is done; of the
others the lines and the places of template words are kept.  A run may be taken to start at a template
word, so there is one block a place, as long as the longest run, and cut to a template's own length
when the pair is verified.

Template words are ordered by how many of the texts kept hold them, rarest first.  A block is reduced to its template words in this order; it meets a template
when one of its words is in the template's prefix, it has words enough (length), and enough words
are left behind the meeting point on both sides (positional).  The first common word of a pair is
the one that verifies it, so each pair is verified once.  The index of prefixes is bounded by the
templates and broadcast.

Beside the join, fixed phrases are found as consecutive words of the whole text (base labels).

Edge cases: null and empty texts have no words, score 0 and empty labels.  Texts and lines of any
length are scanned whole.  Rows are told apart by a row number, so repeated rows and rows that share
an id are not mixed; null ids are kept.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioql.llm._common import cut

#: Runs of these are words, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
#: Longest run of words that is compared with a notice, in lengths of the notice: room for comment marks and changes.
RUN = 1.25
#: Places of template words whose runs are laid out at a time.
PLACES = 256
#: Phrases of the base labels.
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
#: Notices whose words are the templates.
TEMPLATES = {
    "apache-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit-notice": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
}


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(WORD), F.lit(0))


def _notice_words(notice: str) -> list[str]:
    import re

    return re.findall(WORD, "".join(c.lower() if c.isascii() else c for c in notice))


def template_words(templates: Mapping[str, str]) -> dict[str, list[str]]:
    return {label: sorted(set(_notice_words(notice))) for label, notice in templates.items()}


def run_words(notice: str) -> int:
    """Words of the longest run that is compared with a notice."""
    return math.ceil(RUN * len(_notice_words(notice)))


def _need(ws: Sequence[str], threshold: float) -> int:
    return max(1, math.ceil(threshold * len(ws) - 1e-9))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _places(tokens: Column, phrase: Sequence[str]) -> Column:
    """Indices of the words where a phrase starts."""

    def here(i: Column) -> Column:
        found = F.get(tokens, i) == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            found = found & (F.get(tokens, i + k) == w)
        return found

    return F.when(F.array_contains(tokens, phrase[0]) & (F.size(tokens) >= len(phrase)), F.filter(F.sequence(F.lit(0), F.size(tokens) - len(phrase)), here)).otherwise(F.array().cast("array<int>"))


def _base(phrases: Mapping[str, str]) -> Column:
    """Places and labels of the fixed phrases among the words _w."""
    split = {label: phrase.split() for label, phrase in phrases.items()}
    # most texts hold none of the first words
    maybe = F.arrays_overlap("_w", _strings(sorted({p[0] for p in split.values()})))
    return F.when(maybe, F.flatten(F.array(*(F.transform(_places(F.col("_w"), p), _tagged(label)) for label, p in split.items()))))


def _tagged(label: str):
    return lambda i: F.struct(i.alias("at"), F.lit(label).alias("label"))


def look(docs: DataFrame, sets: Mapping[str, Sequence[str]], threshold: float, id_column: str, text: str, phrases: Mapping[str, str]) -> DataFrame:
    """Per row its counts and base labels, and where a template may match: _held, _lines and _hits.

    _held are the template words of the text, _lines the lines with template words enough, and _hits
    the places of template words, each as place << 16 | number in the sorted vocabulary.
    """
    vocabulary = sorted({w for ws in sets.values() for w in ws})
    known, need = _strings(vocabulary), {label: _need(ws, threshold) for label, ws in sets.items()}
    least = min(need.values(), default=1)
    rows = docs.select(F.col(id_column).alias("_id"), lowered(F.col(text)).alias("_body")).select("_id", "_body", words(F.col("_body")).alias("_w"))
    rows = rows.select("_id", "_body", "_w", F.array_intersect(known, "_w").alias("_held"), _base(phrases).alias("_p"))
    maybe = F.lit(False)
    for label, ws in sets.items():
        maybe = maybe | (F.size(F.array_intersect("_held", _strings(ws))) >= need[label])
    rows = rows.select("*", ((F.size("_held") >= least) & maybe).alias("_maybe"))
    line = lambda body, k: F.struct(k.alias("line"), F.array_intersect(known, words(body)).alias("b"))
    lines = F.filter(F.transform(F.split("_body", "\n"), line), lambda x: F.size(x["b"]) >= least)
    placed = F.filter(F.transform("_w", lambda w, k: F.struct(k.alias("at"), w.alias("w"))), lambda x: x["w"].isin(vocabulary))
    hits = F.transform(placed, lambda x: F.shiftleft(x["at"].cast("long"), 16).bitwiseOR(F.array_position(known, x["w"]) - 1))
    at = F.transform("_p", lambda p: p["at"])
    return rows.select(
        "_id", F.size("_w").cast("long").alias("n_words"), F.coalesce(F.size("_p"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("_p", lambda p: p["label"]))), F.array().cast("array<string>")).alias("_base"),
        F.when(F.col("_maybe"), F.col("_held")).alias("_held"), F.when(F.col("_maybe"), lines).alias("_lines"), F.when(F.col("_maybe"), hits).alias("_hits"),
    )


def word_order(looked: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """The vocabulary by how many of the texts kept hold each word, rarest first."""
    held = looked.select(F.explode("_held").alias("w"))
    n = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}  # a row a vocabulary word
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def _runs(looked: DataFrame, longest: int) -> DataFrame:
    """_row and _run: the hits from each hit on, within `longest` words."""
    segments = F.transform(F.sequence(F.lit(1), F.size("_hits"), F.lit(PLACES)), lambda s: F.slice("_hits", s, PLACES + longest))
    parts = looked.where(F.size("_hits") > 0).select("_row", F.explode(segments).alias("_part"))
    place = lambda x: F.shiftright(x, 16)
    near = lambda k: F.filter(F.slice("_part", k, longest), lambda x: place(x) < place(F.get("_part", k - 1)) + longest)
    starts = F.sequence(F.lit(1), F.least(F.size("_part"), F.lit(PLACES)))
    return parts.select("_row", F.explode(F.transform(starts, near)).alias("_run"))


def matching_blocks(looked: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of blocks and templates that meet the threshold: _row, label and containment."""
    sets = {label: ws for label, ws in template_words(templates).items() if ws}
    vocabulary = sorted({w for ws in sets.values() for w in ws})
    order = word_order(looked, vocabulary)
    place = {w: k for k, w in enumerate(order)}
    index = []
    for label, ws in sets.items():
        ranked = sorted(ws, key=place.__getitem__)
        need = _need(ws, threshold)
        index += [(w, label, k, len(ranked), need, ranked, run_words(templates[label])) for k, w in enumerate(ranked[: len(ranked) - need + 1])]
    prefixes = looked.sparkSession.createDataFrame(index, "_token string, label string, _at int, _size int, _need int, _template array<string>, _longest int")
    least = min((i[4] for i in index), default=1)
    known, numbered = _strings(order), _strings(vocabulary)
    none = F.lit(None).cast("array<bigint>")
    lines = looked.select("_row", F.explode("_lines").alias("_line")).select("_row", F.col("_line.b").alias("_b"), none.alias("_run"))
    named = lambda x: F.get(numbered, x.bitwiseAND(F.lit(0xFFFF)).cast("int"))
    runs = _runs(looked, max(map(run_words, templates.values()), default=1)).select("_row", F.transform("_run", named).alias("_b"), "_run")
    # in the global order (array_intersect keeps the order of its first side)
    blocks = lines.unionByName(runs).select("_row", F.array_intersect(known, "_b").alias("_b"), "_run").where(F.size("_b") >= least)
    tokens = blocks.select("*", F.posexplode("_b").alias("_bat", "_btoken"))
    met = tokens.join(F.broadcast(prefixes), F.col("_btoken") == F.col("_token")).where(
        (F.size("_b") >= F.col("_need")) & (F.least(F.col("_size") - F.col("_at"), F.size("_b") - F.col("_bat")) >= F.col("_need"))
    )
    met = met.withColumn("_both", F.array_intersect("_b", "_template")).where((F.get("_both", F.lit(0)) == F.col("_token")) & (F.size("_both") >= F.col("_need")))
    # of a run only what lies within the template's own length
    start = F.shiftright(F.get("_run", F.lit(0)), 16)
    short = F.transform(F.filter("_run", lambda x: F.shiftright(x, 16) < start + F.col("_longest")), named)
    met = met.withColumn("_n", F.when(F.col("_run").isNull(), F.size("_both")).otherwise(F.size(F.array_intersect(F.col("_template"), short))))
    return met.where(F.col("_n") >= F.col("_need")).select("_row", "label", (F.col("_n") / F.col("_size")).alias("containment"))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """One row per document: word and phrase counts, base labels, all labels, and the best containment as score."""
    sets = {label: ws for label, ws in template_words(templates).items() if ws}
    looked = cut(look(docs, sets, threshold, id_column, text, phrases).withColumn("_row", F.monotonically_increasing_id()))
    found = matching_blocks(looked, templates, threshold).groupBy("_row").agg(F.collect_set("label").alias("_found"), F.max("containment").alias("_best"))
    joined = looked.drop("_held", "_lines", "_hits").join(found, "_row", "left")
    every = F.array_sort(F.array_union("_base", F.coalesce("_found", F.array().cast("array<string>"))))
    return joined.select(
        F.col("_id").alias(id_column), "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
